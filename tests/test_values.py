import json
import math

import pytest
from pyspark.sql import functions as F

from vigil.config import Settings
from vigil.functions.codec import decode_messages, encode_events, message_triples, rejected_messages, to_readings
from vigil.operators.catalog import latest_models, model_snapshots, with_model_as_of
from vigil.operators.scoring import anomalies, score, to_alerts
from vigil.operators.training import fit_models, latest_history, load_barrier, load_counts
from vigil.operators.upsert import merge_log, merge_upsert
from vigil.operators.windows import window_batches


def message(device, t, variation=0.0, isanomaly=1, base=120):
    return json.dumps({"source": {"id": device, "base": base}, "eventtime": t, "variation": variation, "isanomaly": isanomaly})


def messages(spark, texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "data binary")


def test_marker_one_is_the_normal_case(spark):
    raw = messages(spark, [message(1, 1, -3), message(2, 1, -3, 5), message(3, 1, 2.5, 0)])
    got = {r.id: (r.value, r.base) for r in decode_messages(raw).collect()}
    assert got == {1: (117.0, 120.0), 2: (120.0 * 1.1 - 3, 120.0), 3: (120.0 * 1.1 + 2.5, 120.0)}


def test_bad_messages_are_set_aside(spark):
    bad = ["{", "", "null", "[]", '{"source":{"id":1}}', message(1, 1).replace('"eventtime": 1', '"eventtime": "x"'),
           '{"source":{"id":"a","base":1},"eventtime":1,"variation":1,"isanomaly":1}']
    raw = messages(spark, [message(1, 5), *bad])
    assert [r.id for r in decode_messages(raw).collect()] == [1]
    assert sorted(bytes(r.data).decode() for r in rejected_messages(raw).collect()) == sorted(bad)


def test_values_are_cut_toward_zero(spark):
    events = spark.createDataFrame([(1, 1, -3.7, 1.0), (1, 2, 3.7, 1.0), (1, 3, 0.99, 1.0)], "id int, eventtime long, value double, base double")
    assert [r.value for r in to_readings(events).orderBy("eventtime").collect()] == [-3, 3, 0]
    assert sorted(r.value for r in message_triples(encode_events(events)).collect()) == [-3, 0, 3]


def test_chunks_of_a_full_history(spark):
    readings = spark.range(400).select(F.lit(7).alias("device_id"), F.col("id").alias("eventtime"), F.lit(1).alias("value"))
    history = latest_history(readings, 300, 100, 8)
    assert history.agg(F.min("eventtime")).first()[0] == 100
    counts = {r.chunk: r.n for r in load_counts(history).collect()}
    assert counts == {0: 99, 1: 100, 2: 100, 3: 1}
    done = load_barrier(load_counts(history)).first()
    assert (done.chunk_sizes, done.n_rows) == ([1, 99, 100, 100], 300)


def test_unwritten_values_are_not_history(spark):
    readings = spark.createDataFrame([(1, 1, 5), (1, 2, None), (1, 3, 6)], "device_id int, eventtime long, value int")
    assert sorted(r.eventtime for r in latest_history(readings, 2, 100, 4).collect()) == [1, 3]


def models_of(spark, values, device=1):
    rows = [(device, i, v) for i, v in enumerate(values)]
    return fit_models(spark.createDataFrame(rows, "device_id int, eventtime long, value int"))


def distances(spark, values, models, device=1):
    events = spark.createDataFrame([(device, i, float(v), 0.0) for i, v in enumerate(values)], "id int, eventtime long, value double, base double")
    return [r.distance for r in score(events, models).orderBy("eventtime").collect()]


def test_distance(spark):
    models = models_of(spark, [8, 12, 8, 12])
    row = models.first()
    assert (row.n, row.s, row.ss, row.centroid, row.radius) == (4, 40, 416, 10.0, 2.0)
    assert distances(spark, [10, 16, 4, 16.9], models) == [0.0, 3.0, 3.0, 3.0]
    assert distances(spark, [10, 16], models, device=2) == [0.0, 0.0]


def test_distance_of_a_point_cluster(spark):
    assert distances(spark, [5, 6], models_of(spark, [5, 5, 5])) == [0.0, math.inf]


def test_distance_ignores_shift_and_scale(spark):
    values, probes = [3, 9, 4, 4, 7, 12], [3, 30, -5]
    expected = distances(spark, probes, models_of(spark, values))
    moved = distances(spark, [v * 4 + 1000 for v in probes], models_of(spark, [v * 4 + 1000 for v in values]))
    assert moved == pytest.approx(expected, rel=1e-12)


def test_long_history_does_not_overflow(spark):
    wide = spark.range(1).select(F.lit(1).alias("id"), F.lit("m").alias("model"), F.lit(10**12).alias("n"),
                                 F.lit(12 * 10**13).alias("s"), F.lit(145 * 10**14).alias("ss"), F.lit(0).cast("long").alias("trained_at"))
    assert distances(spark, [150], wide) == [pytest.approx(30 / 10)]


def test_threshold_is_strict_and_alerts_are_unique(spark):
    scores = spark.createDataFrame(
        [(1, 1, 130.5, 120.0, 3.0), (1, 2, 131.5, 120.0, 3.0000001), (1, 2, 131.5, 120.0, 3.0000001)],
        "id int, eventtime long, value double, base double, distance double",
    )
    rows = to_alerts(anomalies(scores, 3.0)).collect()
    assert [(r.id, r.value, r.base) for r in rows] == [(1, 131.5, 120.0)]


def test_model_is_seen_from_the_next_tick(spark):
    versions = spark.createDataFrame([(1, "a", 10), (1, "b", 130), (1, "c", 140)], "id int, model string, trained_at long")
    events = spark.createDataFrame([(1, t) for t in (119, 120, 239, 240, 500)] + [(2, 500)], "id int, eventtime long")
    got = {(r.id, r.eventtime): r.model for r in with_model_as_of(events, versions, 120, 240).collect()}
    assert got == {(1, 119): None, (1, 120): "a", (1, 239): "a", (1, 240): "c", (1, 500): "c", (2, 500): None}
    snapshots = {(r.model, r.effective_from, r.effective_until) for r in model_snapshots(versions, 120).collect()}
    assert snapshots == {("a", 120, 240), ("c", 240, None)}
    assert latest_models(versions).first().model == "c"


def test_upsert_keeps_what_is_not_written(spark):
    base = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "device_id int, eventtime long, value int")
    late = spark.createDataFrame([(1, 2, 0.5), (2, 9, 1.5)], "device_id int, eventtime long, distance float")
    again = spark.createDataFrame([(1, 1, 7), (2, 9, 8)], "device_id int, eventtime long, value int")
    rows = merge_upsert(base, [late, again], ["device_id", "eventtime"]).collect()
    assert {(r.device_id, r.eventtime): (r.value, r.distance) for r in rows} == {
        (1, 1): (7, None), (1, 2): (6, 0.5), (2, 9): (8, 1.5),
    }


def test_repeated_key_in_one_batch_is_settled(spark):
    base = spark.createDataFrame([], "k int, v int")
    rows = [(1, 4), (1, 9), (1, 2)]
    for order in (rows, rows[::-1]):
        assert merge_upsert(base, [spark.createDataFrame(order, "k int, v int")], ["k"]).collect() == [(1, 9)]


def test_log_merge_skips_nulls(spark):
    log = spark.createDataFrame([(1, 5, None, 0), (1, None, 2.0, 1), (1, 6, None, 2)], "k int, v int, d double, o long")
    assert [tuple(r) for r in merge_log(log, ["k"], "o").collect()] == [(1, 6, 2.0)]


def test_windows_start_at_even_seconds(spark):
    events = spark.createDataFrame([(1, t) for t in (0, 1_999, 2_000, 5_500)], "id int, eventtime long")
    got = window_batches(events.withColumn("event_ts", F.timestamp_millis("eventtime")), "2 seconds")
    rows = got.select(F.unix_millis("window_start").alias("s"), "batch_rows").collect()
    assert sorted((r.s, r.batch_rows) for r in rows) == [(0, 2), (2_000, 1), (4_000, 1)]


def test_settings_are_typed():
    assert Settings(refresh_ms="90000").refresh_ms == 90_000
    with pytest.raises(ValueError):
        Settings(trigger_limit=0)


def test_radius_of_very_many_wide_readings(spark):
    from pyspark.sql import functions as F

    from vigil.functions.numeric import radius

    n, top = 2_000_000_000, 2**31 - 1
    row = spark.sql(f"SELECT {n}L n, {n * top}L s, cast('{n * top * top}' as decimal(28, 0)) ss")
    assert row.select(radius(F.col("n"), F.col("s"), F.col("ss"))).first()[0] == 0.0
