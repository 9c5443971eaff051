import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from vigil.config import Settings
from vigil.functions.codec import decode_messages, to_readings
from vigil.operators.scoring import score
from vigil.operators.training import fit_models
from vigil.schemas import READING
from vigil.sources.messages import read_messages, replay_messages
from vigil.sources.sinks import append_sink, keyed_sink, line_sink
from vigil.sources.tables import KeyedTable
from vigil.streaming import jobs
from vigil.streaming.counter import count_triggers

T0 = 1_700_000_000_000


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def live(root):
    inbox = f"{root}/inbox"
    os.mkdir(inbox)
    return Settings(source_path=inbox, trigger_limit=5, cooldown_ms=60_000, history_limit=4, chunk_rows=2, table_buckets=4)


def line(device, t, variation=0, isanomaly=1):
    return json.dumps({"source": {"id": device, "base": 120}, "eventtime": t, "variation": variation, "isanomaly": isanomaly})


def drop(settings, name, lines):
    with open(f"{settings.source_path}/{name}.json", "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def no_idle_batches(spark):
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def readings(store, spark):
    rows = store.readings.read(spark).collect()
    return {(r.device_id, r.eventtime): (r.value, r.distance) for r in rows}


def test_persist_restart_and_replay(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)

    def run():
        jobs.start_persisting(read_messages(spark, live), store, f"{root}/c", live, once=True).awaitTermination()

    drop(live, "a", [line(1, T0, -1), "broken", line(1, T0 + 1, 3), line(2, T0, 1)])
    run()
    drop(live, "b", [line(1, T0, 5), line(1, T0 - 10, 0)])
    run()
    run()
    expected = {(1, T0): (125, None), (1, T0 + 1): (123, None), (2, T0): (121, None), (1, T0 - 10): (120, None)}
    assert readings(store, spark) == expected
    batch = to_readings(decode_messages(replay_messages(spark, live)))
    assert {(r.device_id, r.eventtime) for r in batch.collect()} == set(expected)
    # A batch that is written again after a failure replaces itself.
    before = store.readings.read_log(spark).count()
    again = store.readings.read_log(spark).filter("batch_id = 1").select("device_id", "eventtime", "value").collect()
    store.readings.append(spark.createDataFrame(again, "device_id int, eventtime long, value int"), "values", 1)
    assert store.readings.read_log(spark).count() == before
    assert readings(store, spark) == expected
    whole = store.readings.compact_into(spark, f"{root}/compact")
    assert {(r.device_id, r.eventtime): (r.value, r.distance) for r in whole.read(spark).collect()} == expected


def test_distance_may_come_before_value(spark, root):
    table = KeyedTable(f"{root}/t", READING, ("device_id", "eventtime"), 4)
    assert table.read(spark).count() == 0
    keyed_sink(table, "distances")(spark.createDataFrame([(1, 1, 2.5)], "device_id int, eventtime long, distance float"), 0)
    assert [tuple(r) for r in table.read(spark).collect()] == [(1, 1, None, 2.5)]
    keyed_sink(table, "values")(spark.createDataFrame([(1, 1, 9), (2, 1, 3)], "device_id int, eventtime long, value int"), 0)
    rows = {r.device_id: (r.value, r.distance) for r in table.read(spark).collect()}
    assert rows == {1: (9, 2.5), 2: (3, None)}
    only = table.read_keys(spark, spark.createDataFrame([(2,)], "device_id int"))
    assert [r.device_id for r in only.collect()] == [2]
    plan = only._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "bucket#" in plan.split("PartitionFilters")[1][:200]


def test_counter_fires_once_per_pause(spark, root, live, no_idle_batches):
    def run():
        triggers = count_triggers(decode_messages(read_messages(spark, live)), 5, live.cooldown_ms)
        triggers.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/c"
        ).trigger(availableNow=True).start().awaitTermination()
        return sorted((r.id, r.eventtime) for r in spark.read.schema("id int, eventtime long").parquet(f"{root}/out").collect())

    drop(live, "a", [line(1, T0 + i) for i in range(3)] + [line(2, T0 + i) for i in range(12)])
    assert run() == [(2, T0 + 4)]
    # Out of order: the fifth event is the fifth by time of what this batch adds.
    drop(live, "b", [line(1, T0 + i) for i in (8, 3, 7, 4, 6, 5)] + [line(2, T0 + 50)])
    assert run() == [(1, T0 + 4), (2, T0 + 4)]


def test_packing_loses_no_event():
    import random

    import pandas as pd

    from vigil.streaming.counter import _packed

    rng = random.Random(2)
    batches = [pd.DataFrame({"id": [rng.randrange(3) for _ in range(n)], "eventtime": range(n)}) for n in (0, 30, 7)]
    packed = pd.concat(list(_packed(iter(batches))))
    for device in range(3):
        whole = [t for b in batches for t in b[b.id == device].eventtime.tolist()]
        assert [t for times in packed[packed.id == device].times for t in times] == whole
    assert len(packed) <= 6


def test_counter_restarts_after_the_pause(spark, root, live, no_idle_batches):
    def run():
        triggers = count_triggers(decode_messages(read_messages(spark, live)), 5, 500)
        triggers.writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/c"
        ).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.eventtime for r in spark.read.schema("id int, eventtime long").parquet(f"{root}/out").collect())

    drop(live, "a", [line(1, T0 + i) for i in range(7)])
    assert run() == [T0 + 4]
    time.sleep(1)
    # The pause is over, so the first event after it counts, and the timer forgets nothing of the new count.
    drop(live, "b", [line(1, T0 + 100)])
    run()
    drop(live, "c", [line(1, T0 + 200 + i) for i in range(5)])
    assert run() == [T0 + 4, T0 + 203]


def test_windows_drop_what_is_too_late(spark, root, live):
    def run():
        jobs.start_window_batches(
            jobs.timed(read_messages(spark, live)), f"{root}/w", f"{root}/c", "2 seconds", "2 seconds", None
        ).awaitTermination()
        rows = spark.read.parquet(f"{root}/w").collect()
        return sorted((int(r.window_start.timestamp() * 1000) - T0, r.batch_rows) for r in rows)

    drop(live, "a", [line(1, T0), line(1, T0 + 2_500)])
    run()
    # In time for the second window although out of order; then far ahead, then too late.
    drop(live, "b", [line(1, T0 + 2_100), line(1, T0 + 20_000)])
    run()
    drop(live, "c", [line(1, T0 + 100), line(1, T0 + 40_000)])
    assert run() == [(0, 1), (2_000, 2), (20_000, 1)]


def test_train_then_score(spark, root, live, no_idle_batches):
    store = jobs.Store.under(f"{root}/store", live)
    values = [-2, 2, -2, 2, -2, 2]
    drop(live, "a", [line(1, T0 + i, v) for i, v in enumerate(values)] + [line(2, T0, 0)])
    messages = read_messages(spark, live)
    jobs.start_persisting(messages, store, f"{root}/c1", live, once=True).awaitTermination()
    jobs.start_training(messages, store, f"{root}/c2", live, once=True).awaitTermination()
    model = store.models.read(spark).first()
    assert (model.id, model.n, model.centroid, model.radius) == (1, 4, 120.0, 2.0)
    assert model.model.startswith("model_1_")
    loaded = store.training.read(spark).collect()
    assert sorted((r.eventtime - T0, r.chunk) for r in loaded) == [(2, 2), (3, 1), (4, 1), (5, 0)]

    drop(live, "b", [line(1, T0 + 100, 7), line(1, T0 + 101, 6), line(3, T0, 50)])
    jobs.start_scoring(messages, store, f"{root}/c3", live, once=True).awaitTermination()
    jobs.start_persisting(messages, store, f"{root}/c1", live, once=True).awaitTermination()
    stored = readings(store, spark)
    assert stored[(1, T0 + 100)] == (127, 3.5) and stored[(1, T0 + 101)] == (126, 3.0)
    assert stored[(3, T0)] == (170, 0.0)
    assert [(r.id, r.eventtime, r.distance) for r in store.alerts.read(spark).collect()] == [(1, T0 + 100, 3.5)]
    # Stored stream distances equal the batch operator.
    batch = score(decode_messages(replay_messages(spark, live)), store.models.read(spark)).collect()
    assert {(r.id, r.eventtime): r.distance for r in batch} == {k: v[1] for k, v in stored.items()}


def test_catalog_is_read_again_only_at_a_tick(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    clock = [0]
    snapshot = jobs.CatalogSnapshot(store.models, 1_000, lambda: clock[0])

    def publish(batch, value):
        rows = spark.createDataFrame([(1, batch, value)], "device_id int, eventtime long, value int")
        keyed_sink(store.models, "trainer")(fit_models(rows), batch)

    publish(0, 10)
    assert [r.s for r in snapshot.current(spark).collect()] == [10]
    publish(1, 20)
    clock[0] = 999
    assert [r.s for r in snapshot.current(spark).collect()] == [10]
    clock[0] = 1_000
    assert [r.s for r in snapshot.current(spark).collect()] == [20]


def test_first_alert_stands(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    for batch, value in enumerate([1.0, 2.0]):
        rows = spark.createDataFrame([(1, 1, value)], "id int, eventtime long, value double").select(
            "*", F.current_timestamp().alias("notified_at"), F.lit(0.0).alias("base"), F.lit(4.0).alias("distance")
        )
        store.alerts.append(rows, "scorer", batch)
    assert [r.value for r in store.alerts.read(spark).collect()] == [1.0]


def test_of_two_versions_in_a_batch_the_last_trained_stays(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    rows = spark.createDataFrame(
        [(1, "model_1_59", 1, 5, 25, 5.0, 0.0, 1000), (1, "model_1_09", 1, 6, 36, 6.0, 0.0, 2000)],
        "id int, model string, n long, s long, ss long, centroid double, radius double, trained_at long")
    store.models.append(rows, "trainer", 0)
    assert [r.model for r in store.models.read(spark).collect()] == ["model_1_09"]
    store.models.append(rows.filter("trained_at = 1000"), "trainer", 1)
    assert [r.model for r in store.models.read(spark).collect()] == ["model_1_09"]


def test_unstorable_messages_become_rejects(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    bad = [line(1, T0 + 1).replace("120", "NaN"), line(1, T0 + 2).replace("120", "1e12"), "{", line(1, T0 + 3, 0, "null")]
    drop(live, "a", [line(1, T0), line(1, T0 + 4, 0, 1.0), line(1, T0 + 5, 0, 5.5), *bad])
    jobs.start_persisting(read_messages(spark, live), store, f"{root}/c", live, once=True).awaitTermination()
    assert {t - T0: v for (_, t), (v, _) in readings(store, spark).items()} == {0: 120, 4: 120, 5: 132}
    assert len(store.rejects.read(spark).collect()) == len(bad)


def test_training_runs_with_adaptive_execution(spark, root, live, no_idle_batches):
    store = jobs.Store.under(f"{root}/store", live)
    drop(live, "a", [line(1, T0 + i) for i in range(6)])
    messages = read_messages(spark, live)
    jobs.start_persisting(messages, store, f"{root}/c1", live, once=True).awaitTermination()
    seen = []

    def tap(triggers, batch_id):
        seen.append(triggers.sparkSession.conf.get("spark.sql.adaptive.enabled"))

    jobs.start_training(messages, store, f"{root}/c2", live, once=True, taps=[tap]).awaitTermination()
    assert seen == ["true"]


def test_training_does_not_read_the_log(spark, root, live, no_idle_batches, monkeypatch):
    """Batches go on, and what training reads stays at most the newest readings of a device and batch."""
    from vigil.operators.training import latest_history

    store = jobs.Store.under(f"{root}/store", live)
    messages = read_messages(spark, live)
    for n in range(3):
        drop(live, f"part{n}", [line(1, T0 + 100 * n + i, i % 3) for i in range(40)])
        jobs.start_persisting(messages, store, f"{root}/c1", live, once=True).awaitTermination()
    wanted = spark.createDataFrame([(1,)], "device_id int")
    kept = store.latest.read_keys(spark, wanted)
    assert all("/latest/" in f for f in kept.inputFiles())
    assert store.latest.read_log(spark).count() <= 3 * live.history_limit < store.readings.read(spark).count()
    newest = latest_history(store.readings.read(spark), live.history_limit, 2, 2)
    assert {(r.eventtime, r.value) for r in kept.collect()} == {(r.eventtime, r.value) for r in newest.collect()}
    monkeypatch.setattr(jobs.KeyedTable, "read", lambda *a: pytest.fail("the readings were read"))
    jobs.start_training(messages, store, f"{root}/c2", live, once=True).awaitTermination()
    assert [r.n for r in store.models.read_log(spark).collect()] == [live.history_limit]


def test_late_events_survive_a_restart(spark, root, live):
    """The watermark is read back from what the batches before have noted, folded or not."""
    store = jobs.Store.under(f"{root}/store", live)
    messages = read_messages(spark, live)

    def run():
        jobs.start_ingesting(messages, store, f"{root}/c", live, once=True).awaitTermination()

    for n, at in enumerate([0, 500_000, 600_000]):
        drop(live, f"a{n}", [line(1, T0 + at)])
        run()
    store.progress.fold(spark, grace_ms=0)
    drop(live, "b", [line(1, T0 + 599_000), line(1, T0 + 590_000), line(1, T0 + 400_000), "broken"])
    run()
    late = {(r.stage, r.eventtime - T0) for r in store.late.read(spark).collect()}
    assert late == {("persist", 590_000), ("persist", 400_000), ("score", 400_000)}
    stored = {t - T0: v for (_, t), v in readings(store, spark).items()}
    assert stored[599_000] == (120, 0.0) and stored[590_000] == (None, 0.0) and 400_000 not in stored
    noted = {r.batch: (r.messages, r.events, r.rejects, r.late) for r in store.progress.read(spark).collect()}
    assert noted == {0: (1, 1, 0, 0), 1: (1, 1, 0, 0), 2: (1, 1, 0, 0), 3: (4, 3, 1, 3)}
    assert [r.reason for r in store.rejects.read(spark).collect()] == ["no message"]


def test_two_queries_keep_rejects_once(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    messages = read_messages(spark, live)
    drop(live, "a", [line(1, T0), "broken", line(2, T0 + 1)])
    for start in (jobs.start_persisting, jobs.start_scoring):
        start(messages, store, f"{root}/{start.__name__}", live, once=True).awaitTermination()
    assert [bytes(r.data) for r in store.rejects.read(spark).collect()] == [b"broken"]
    assert {(r.query, r.messages, r.events, r.rejects) for r in store.progress.read(spark).collect()} == {
        ("persist", 3, 2, 1), ("scorer", 3, 2, 1)}
    assert set(readings(store, spark).values()) == {(120, 0.0)}


def test_append_and_line_sinks(spark, root, live):
    store = jobs.Store.under(f"{root}/store", live)
    rows = spark.createDataFrame([(1, 2, 3)], "device_id int, value int, eventtime long").select(
        "*", F.current_timestamp().alias("collected_at"), F.current_timestamp().alias("loaded_at"), F.lit(0).alias("chunk")
    )
    append_sink(store.training, "loads")(rows, 0)
    append_sink(store.training, "loads")(rows, 1)
    assert store.training.read(spark).count() == 2
    many = spark.range(100).selectExpr("cast(id as int) as id", "'Anomaly Detected: x' as text")
    line_sink(store.lines, "anomalies", lambda found: found.withColumnRenamed("text", "line"))(many, 0)
    assert store.lines.read(spark).count() == 100


def test_live_queries_meet_in_the_tables(spark, root, live):
    from dataclasses import replace

    from vigil.plans.live import start_all

    quick = replace(live, refresh_ms=200, persist_trigger="200 milliseconds", training_trigger="200 milliseconds")
    store = jobs.Store.under(f"{root}/tables", quick)

    def wait_for(table, rows):
        until = time.time() + 90
        while time.time() < until and table.read(spark).count() < rows:
            time.sleep(0.5)
        return table.read(spark).collect()

    queries = start_all(spark, quick, root)
    try:
        drop(live, "a", [line(1, T0 + i, v) for i, v in enumerate([-2, 2, -2, 2])])
        assert len(wait_for(store.readings, 4)) == 4
        drop(live, "b", [line(1, T0 + 10, 2)])
        assert [m.id for m in wait_for(store.models, 1)] == [1]
        drop(live, "c", [line(1, T0 + 20, 30)])
        assert [(r.id, r.eventtime) for r in wait_for(store.alerts, 1)] == [(1, T0 + 20)]
        lines = [r.line for r in wait_for(store.lines, 4)]
        for start in ("MODEL TRAINED: (1, model_1_", "MODEL SAVED: (1, model_1_", "Training Events Collected For: Event: (1, ",
                      f"Anomaly Detected: Event: (1, {T0 + 20}, 150)"):
            assert any(text.startswith(start) for text in lines), start
        assert all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.stop()


def test_command_line():
    from vigil.plans.live import parse

    settings, root = parse(["--root", "/x", "--source_format", "kafka", "--source_option", "subscribe=a=b", "--model_load_timer", "90"])
    assert (root, settings.refresh_ms, settings.source_options) == ("/x", 90_000, {"subscribe": "a=b"})


def test_jdbc_sink_sends_only_unknown_alerts(spark, monkeypatch):
    """The hand-over to the JDBC writer; no database is started."""
    from pyspark.sql.readwriter import DataFrameWriter

    from vigil.operators.scoring import to_alerts
    from vigil.sources.sinks import jdbc_alert_sink

    sent = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda writer: sent.append(writer._df))
    found = spark.createDataFrame(
        [(1, T0, 130.5, 120.0), (1, T0, 130.5, 120.0), (2, T0, 99.5, 120.0)], "id int, eventtime long, value double, base double"
    )
    alerts = to_alerts(found)
    known = alerts.filter("id = 2").select("id", "eventtime")
    jdbc_alert_sink("jdbc:none", "alerts", lambda: known)(alerts, 0)
    assert sent[0].columns == ["id", "eventtime", "value", "base"]
    assert [(r.id, r.value) for r in sent[0].collect()] == [(1, 130.5)]
