"""Every operator as a query over the given tables: name -> function of (session, folder)."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import DAY_MS, HOUR_MS, Settings, duration_ms
from vigil.functions.codec import (
    decode_messages,
    encode_events,
    message_triples,
    rejected_messages,
    to_readings,
    with_event_time,
)
from vigil.operators import catalog, scoring, training, trigger, windows
from vigil.plans import stages
from vigil.plans.inputs import (
    as_damaged_messages,
    as_device_events,
    as_messages,
    read_events,
    stream_events,
)
from vigil.session import ROCKSDB, new_folder
from vigil.sources.sinks import keyed_sink, line_sink
from vigil.sources.ticks import read_ticks
from vigil.streaming import jobs
from vigil.streaming.counter import count_panes, count_triggers

# The given tables hold under 100 events per device, so the live settings would never trigger.
REPLAY = Settings(
    trigger_limit=20, cooldown_ms=3 * DAY_MS, history_limit=30, chunk_rows=10, slice_ms=DAY_MS
)
LOADED_AT = "2024-02-01 00:00:00"
TRAINED_AT = 1_706_745_600_000

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark, sf_dir):
    return as_device_events(read_events(spark, sf_dir))


def _messages(spark, sf_dir):
    return as_messages(read_events(spark, sf_dir))


def _decoded(spark, sf_dir):
    return decode_messages(_messages(spark, sf_dir))


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as other engines print them."""
    times = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def _plain_models(models: DataFrame) -> DataFrame:
    """The exact sum of squares as other engines print it; it fits here."""
    return models.withColumn("ss", F.col("ss").cast("bigint"))


def _loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


# --- decode -----------------------------------------------------------------------------------


@query
def decode_events(spark, sf_dir):
    return _decoded(spark, sf_dir)


@query
def reject_messages(spark, sf_dir):
    rejected = rejected_messages(as_damaged_messages(read_events(spark, sf_dir)))
    return rejected.select(F.col("data").cast("string").alias("data"))


@query
def reject_reasons(spark, sf_dir):
    """Why messages of a damaged table cannot be stored."""
    rejected = rejected_messages(as_damaged_messages(read_events(spark, sf_dir)))
    return rejected.groupBy("reason").agg(F.count("*").alias("n_messages"))


@query
def decode_damaged(spark, sf_dir):
    return decode_messages(as_damaged_messages(read_events(spark, sf_dir)))


@query
def key_triples(spark, sf_dir):
    return message_triples(encode_events(_decoded(spark, sf_dir)))


@query
def event_time(spark, sf_dir):
    return _plain_times(stages.save_and_timestamp_events(_messages(spark, sf_dir)).select("id", "eventtime", "event_ts"))


@query
def stored_readings(spark, sf_dir):
    return stages.stored_readings(_decoded(spark, sf_dir)).filter(F.col("value").isNotNull())


# --- windows ----------------------------------------------------------------------------------


def _batches(spark, sf_dir, length):
    return _plain_times(windows.window_batches(with_event_time(_events(spark, sf_dir)), length))


@query
def window_batches(spark, sf_dir):
    return _batches(spark, sf_dir, "1 hour")


@query
def window_batches_2s(spark, sf_dir):
    return _batches(spark, sf_dir, REPLAY.persist_window)


@query
def training_windows_15s(spark, sf_dir):
    triggers = with_event_time(_triggers(spark, sf_dir))
    return _plain_times(windows.assign_window(triggers, REPLAY.training_window).drop("event_ts"))


@query
def count_per_device(spark, sf_dir):
    return windows.count_per_key(_events(spark, sf_dir))


@query
def snapshot_windows(spark, sf_dir):
    return catalog.snapshot_windows(_events(spark, sf_dir), REPLAY.refresh_ms)


# --- triggers and training sets ---------------------------------------------------------------


def _triggers(spark, sf_dir, settings=REPLAY, **options):
    return trigger.collection_triggers(
        _events(spark, sf_dir), settings.trigger_limit, settings.cooldown_ms, settings.slice_ms, **options
    )


@query
def collection_triggers(spark, sf_dir):
    return _triggers(spark, sf_dir)


@query
def collection_triggers_sliced(spark, sf_dir):
    """Slices much shorter than the pause, each a leaf, so that pauses pass through many of them."""
    return _triggers(spark, sf_dir, replace(REPLAY, slice_ms=6 * HOUR_MS), leaf_times=1)


def _history(spark, sf_dir):
    return training.latest_history(
        to_readings(_events(spark, sf_dir)), REPLAY.history_limit, REPLAY.chunk_rows, REPLAY.salts
    )


@query
def training_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def history_at_triggers(spark, sf_dir):
    return stages.count_and_collect_events(_events(spark, sf_dir), REPLAY)


@query
def load_chunk_counts(spark, sf_dir):
    return training.load_counts(_history(spark, sf_dir))


@query
def load_batches(spark, sf_dir):
    return training.rekey_counts(training.load_counts(_history(spark, sf_dir)))


@query
def load_barrier(spark, sf_dir):
    done = training.load_barrier(training.load_counts(_history(spark, sf_dir)))
    return done.withColumn("chunk_sizes", F.array_join("chunk_sizes", ","))


@query
def typed_training_rows(spark, sf_dir):
    rows = training.to_training_json(_history(spark, sf_dir), F.col("eventtime"))
    return _plain_times(training.typed_training_rows(rows, _loaded_at()))


@query
def training_set(spark, sf_dir):
    """Loads of successive triggers overlap; the set to train from does not."""
    loaded = stages.count_and_collect_events(_events(spark, sf_dir), REPLAY)
    return training.training_set(loaded, REPLAY.history_limit, REPLAY.salts).select(
        "device_id", "rn", "eventtime", "value"
    )


@query
def collection_log(spark, sf_dir):
    triggers = with_event_time(_triggers(spark, sf_dir))
    return scoring.collection_lines(triggers, REPLAY.training_window, _loaded_at())


@query
def train_models(spark, sf_dir):
    return _plain_models(training.fit_models(_history(spark, sf_dir)))


@query
def trained_lines(spark, sf_dir):
    return training.trained_lines(training.fit_models(_history(spark, sf_dir)))


@query
def saved_lines(spark, sf_dir):
    saved = catalog.latest_models(_versions(spark, sf_dir))
    return training.trained_lines(saved, "MODEL SAVED")


# --- catalog ----------------------------------------------------------------------------------


def _versions(spark, sf_dir):
    return stages.train_models(stages.count_and_collect_events(_events(spark, sf_dir), REPLAY))


@query
def model_versions(spark, sf_dir):
    return _plain_models(_versions(spark, sf_dir))


@query
def model_snapshots(spark, sf_dir):
    return stages.load_models(_versions(spark, sf_dir), REPLAY)


@query
def model_catalog(spark, sf_dir):
    return _plain_models(catalog.latest_models(_versions(spark, sf_dir)))


# --- scores and alerts ------------------------------------------------------------------------


def _scores(spark, sf_dir):
    """Messages against models of each device's whole history."""
    events = _decoded(spark, sf_dir)
    return scoring.score(events, training.fit_models(to_readings(events)))


@query
def score_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    return scoring.score(events, training.fit_models(to_readings(events))).drop("model")


@query
def score_latest_history(spark, sf_dir):
    return scoring.score(_events(spark, sf_dir), training.fit_models(_history(spark, sf_dir)))


@query
def score_events_asof(spark, sf_dir):
    return stages.calculate_distances(_events(spark, sf_dir), _versions(spark, sf_dir), REPLAY)


@query
def score_batches_2s(spark, sf_dir):
    scores = with_event_time(_scores(spark, sf_dir))
    return _plain_times(windows.score_batches(scores, REPLAY.score_window, REPLAY.threshold))


@query
def anomalies(spark, sf_dir):
    return scoring.anomalies(_scores(spark, sf_dir), REPLAY.threshold).drop("model")


@query
def anomaly_log(spark, sf_dir):
    found = with_event_time(scoring.anomalies(_scores(spark, sf_dir), REPLAY.threshold))
    return scoring.anomaly_lines(found, REPLAY.score_window, _loaded_at())


@query
def alerts(spark, sf_dir):
    found = scoring.anomalies(_scores(spark, sf_dir), REPLAY.threshold)
    return _plain_times(scoring.to_alerts(found, _loaded_at()))


@query
def merge_distance(spark, sf_dir):
    """Distances of all errors meet stored values of all readings but the clicks."""
    events = read_events(spark, sf_dir)
    stored = stages.stored_readings(as_device_events(events.filter("event_type <> 'click'")))
    models = training.fit_models(to_readings(as_device_events(events)))
    late = scoring.score(as_device_events(events.filter("event_type IN ('error', 'click')")), models)
    return stages.save_distances(stored, late)


@query
def alerts_end_to_end(spark, sf_dir):
    return _plain_times(stages.alerts_from_messages(_messages(spark, sf_dir), REPLAY, _loaded_at()))


# --- live queries, run until the given input is used up ----------------------------------------


@contextmanager
def _conf(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@query
def window_counts_stream(spark, sf_dir):
    events = with_event_time(as_device_events(stream_events(spark, sf_dir)))
    out = new_folder(spark, "windows")
    jobs.start_window_batches(
        events, f"{out}/rows", f"{out}/checkpoint", "1 hour", REPLAY.persist_lateness, None
    ).awaitTermination()
    return _plain_times(spark.read.parquet(f"{out}/rows"))


@query
def persist_stream(spark, sf_dir):
    root = new_folder(spark, "persist")
    store = jobs.Store.under(root, replace(REPLAY, table_buckets=4))
    messages = as_messages(stream_events(spark, sf_dir))
    jobs.start_persisting(messages, store, f"{root}/checkpoint", REPLAY, once=True).awaitTermination()
    return store.readings.read(spark).select("device_id", "eventtime", "value")


def _steps(spark, sf_dir, name, *parts) -> tuple[str, Callable[[int], None], DataFrame]:
    """A folder of its own, a function that drops the n-th part of the events into its inbox, and the stream
    of that inbox. `parts` are conditions; together they hold for every event once."""
    folder = new_folder(spark, name)
    events = read_events(spark, sf_dir)
    inbox = f"{folder}/inbox"

    def drop(n: int) -> None:
        events.filter(parts[n]).write.mode("append").parquet(inbox)

    drop(0)
    return folder, drop, spark.readStream.schema(events.schema).parquet(inbox)


def _middle(spark, sf_dir) -> int:
    """Half-way between the first and the last event."""
    first, last = _events(spark, sf_dir).agg(F.min("eventtime"), F.max("eventtime")).first()
    return (first + last) // 2


def _fired(spark, events, folder, cooldown_ms):
    with _waiting_for_data(spark):
        triggers = count_triggers(events, REPLAY.trigger_limit, cooldown_ms)
        triggers.writeStream.format("parquet").option("path", f"{folder}/rows").option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id int, eventtime bigint").parquet(f"{folder}/rows")


@query
def counter_stream(spark, sf_dir):
    """The event that completes each device's first count, all within one pause of processing time."""
    events = as_device_events(stream_events(spark, sf_dir))
    return _fired(spark, events, new_folder(spark, "counter"), REPLAY.cooldown_ms)


@query
def counter_restart_stream(spark, sf_dir):
    """The table in two halves, with a pause that is over when the second arrives."""
    middle = _middle(spark, sf_dir)
    early = F.unix_millis(F.col("ts").cast("timestamp")) < middle
    folder, drop, stream = _steps(spark, sf_dir, "counter", early, ~early)
    _fired(spark, as_device_events(stream), folder, 1)
    drop(1)
    return _fired(spark, as_device_events(stream), folder, 1)


@query
def late_rows_stream(spark, sf_dir):
    """Every seventh event of the first half comes with the second half: what the watermark has passed is
    dropped, by the length and lateness of each stage's windows."""
    middle = _middle(spark, sf_dir)
    first = (F.unix_millis(F.col("ts").cast("timestamp")) < middle) & (F.col("event_id") % 7 != 0)
    folder, drop, stream = _steps(spark, sf_dir, "late", first, ~first)
    stages_ = {
        "persist": (REPLAY.persist_window, REPLAY.persist_lateness),
        "training": (REPLAY.training_window, REPLAY.training_lateness),
        "score": (REPLAY.score_window, REPLAY.score_lateness),
    }
    events = with_event_time(as_device_events(stream))

    def run():
        for stage, (length, lateness) in stages_.items():
            jobs.start_window_batches(
                events, f"{folder}/{stage}", f"{folder}/{stage}-checkpoint", length, lateness, None
            ).awaitTermination()

    run()
    drop(1)
    run()
    rows = [spark.read.parquet(f"{folder}/{s}").select(F.lit(s).alias("stage"), "*") for s in stages_]
    return _plain_times(rows[0].unionByName(rows[1]).unionByName(rows[2]))


def _waiting_for_data(spark):
    """Settings under which a run-once query ends with its input: a processing-time timer would keep it alive
    through batches without data."""
    return _conf(
        spark,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__streaming__noDataMicroBatches__enabled="false",
    )


@query
def ticks_stream(spark, sf_dir):
    """Each refresh tick of the table's time with the events of its window, from a query that is started twice."""
    events = _events(spark, sf_dir)
    first, last = events.agg(F.min("eventtime"), F.max("eventtime")).first()
    folder = new_folder(spark, "ticks")
    for until in ((first + last) // 2, last):
        read_ticks(spark, REPLAY.refresh_ms, first, until).writeStream.format("parquet").option(
            "path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    return catalog.windows_of_ticks(spark.read.schema("tick bigint").parquet(f"{folder}/rows"), events, REPLAY.refresh_ms)


# Panes of windows that rows reach in three steps: as they come, and held back by a long delay.
PANE_LENGTH, PANE_LATENESS = "1 hour", "2 days"


@query
def pane_counts_stream(spark, sf_dir):
    """The panes of hour windows when rows come in order, late, and too late: once with panes that fire in the batch
    of their rows, and once with panes that wait for the watermark."""
    first, last = _events(spark, sf_dir).agg(F.min("eventtime"), F.max("eventtime")).first()
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    third = F.when(at < first + (last - first) // 3, 1).when(at < first + 2 * (last - first) // 3, 2).otherwise(3)
    step = third + F.when(F.col("event_id") % 7 == 0, 1 + F.col("event_id") % 2).otherwise(0)
    folder, drop, stream = _steps(spark, sf_dir, "panes", step == 1, step == 2, step >= 3)
    events = with_event_time(as_device_events(stream))
    delays = {"none": "0 seconds", "long": "1 day"}

    def run():
        for name, delay in delays.items():
            with _waiting_for_data(spark):
                jobs.start_panes(
                    events, f"{folder}/{name}", f"{folder}/{name}-checkpoint", PANE_LENGTH, PANE_LATENESS, delay, None
                ).awaitTermination()

    run()
    drop(1)
    run()
    drop(2)
    run()
    panes = [spark.read.parquet(f"{folder}/{name}").select(F.lit(name).alias("delay"), "*") for name in delays]
    return panes[0].unionByName(panes[1])


@query
def training_panes_stream(spark, sf_dir):
    """Triggers as they come, and the pane of their window one second of processing time later."""
    folder = new_folder(spark, "training-panes")
    events = with_event_time(as_device_events(stream_events(spark, sf_dir)))
    found = count_panes(
        events, REPLAY.trigger_limit, REPLAY.cooldown_ms, duration_ms(REPLAY.training_window),
        duration_ms(REPLAY.training_lateness), 1000)
    with _conf(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        running = found.writeStream.format("parquet").option("path", f"{folder}/rows").option(
            "checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="500 milliseconds").start()
        try:
            # With timers there is always a next batch. One that began after the delay, counted from the first without
            # rows, has fired all panes.
            _wait_for(running, lambda p: p["numInputRows"] == 0)
            enough = time.time() + 1.5
            _wait_for(running, lambda p: datetime.fromisoformat(p["timestamp"]).timestamp() > enough)
        finally:
            running.stop()
    return spark.read.parquet(f"{folder}/rows").select("id", "eventtime", "firing", "window_start", "n")


def _wait_for(running, holds) -> None:
    """Until the last batch of a live query is as asked, however long its batches take; an error if the query ends."""
    while not (running.lastProgress and holds(running.lastProgress)):
        if not running.isActive:
            raise RuntimeError(f"the query did not come so far: {running.exception()}")
        time.sleep(0.2)


def _late_parts(spark, sf_dir):
    """Conditions of two steps: every seventh event of the first half comes with the second."""
    early = F.unix_millis(F.col("ts").cast("timestamp")) < _middle(spark, sf_dir)
    first = early & (F.col("event_id") % 7 != 0)
    return first, ~first


def _in_steps(spark, sf_dir, name, settings, parts, messages=as_messages, start=jobs.start_ingesting):
    """The store after a run for each step of the events."""
    folder, drop, stream = _steps(spark, sf_dir, name, *parts)
    store = jobs.Store.under(folder, settings)
    for n in range(len(parts)):
        if n:
            drop(n)
        start(messages(stream), store, f"{folder}/checkpoint", settings, once=True).awaitTermination()
    return store


@query
def late_events_stream(spark, sf_dir):
    """What each stage of live ingest has stored and what it has kept as late: together every event once a stage."""
    settings = replace(REPLAY, table_buckets=4, persist_lateness="1 day", score_lateness="3 days")
    store = _in_steps(spark, sf_dir, "late-events", settings, _late_parts(spark, sf_dir))
    stored = store.readings.read(spark).withColumnRenamed("device_id", "id")
    kept = [stored.filter(F.col(c).isNotNull()).select(F.lit(s).alias("stage"), "id", "eventtime", F.lit(True).alias("stored"))
            for s, c in (("persist", "value"), ("score", "distance"))]
    late = store.late.read(spark).select("stage", "id", "eventtime", F.lit(False).alias("stored"))
    return kept[0].unionByName(kept[1]).unionByName(late)


@query
def batch_counts_stream(spark, sf_dir):
    """What each batch of a damaged stream held, as noted while it was worked on."""
    store = _in_steps(
        spark, sf_dir, "counts", replace(REPLAY, table_buckets=4), _late_parts(spark, sf_dir), as_damaged_messages)
    return store.progress.read(spark)


@query
def folded_tables_stream(spark, sf_dir):
    """Readings, and the newest of each device, after six batches of which every second one folds the tables."""
    settings = replace(REPLAY, table_buckets=2, fold_batches=2, persist_lateness="60 days")
    parts = [F.col("event_id") % 6 == n for n in range(6)]
    store = _in_steps(spark, sf_dir, "folds", settings, parts, start=jobs.start_persisting)
    tables = {"readings": store.readings, "latest": store.latest}
    rows = [t.read(spark).select(F.lit(n).alias("kind"), "device_id", "eventtime", "value") for n, t in tables.items()]
    return rows[0].unionByName(rows[1])


@query
def score_event_time_stream(spark, sf_dir):
    """Live distances from the model versions of the batch replay, in two steps, each event by the snapshot of its own time."""
    settings = replace(REPLAY, table_buckets=4, score_by="event time", score_lateness="60 days")
    messages = _messages(spark, sf_dir)
    versions = stages.train_models(stages.count_and_collect_events(decode_messages(messages), REPLAY))
    folder, drop, stream = _steps(spark, sf_dir, "event-time", F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1)
    store = jobs.Store.under(folder, settings)
    keyed_sink(store.versions, "trainer")(versions, 0)
    for n in range(2):
        if n:
            drop(n)
        jobs.start_scoring(
            as_messages(stream), store, f"{folder}/checkpoint", settings, once=True).awaitTermination()
    return store.readings.read(spark).select("device_id", "eventtime", "distance")


def _scored_store(spark, sf_dir, sinks=(), start=jobs.start_scoring):
    root = new_folder(spark, "score")
    store = jobs.Store.under(root, replace(REPLAY, table_buckets=4))
    models = training.fit_models(to_readings(_decoded(spark, sf_dir)))
    keyed_sink(store.models, "trainer")(models, 0)
    messages = as_messages(stream_events(spark, sf_dir))
    start(
        messages, store, f"{root}/checkpoint", REPLAY, once=True, sinks=[make(store) for make in sinks]
    ).awaitTermination()
    return store


@query
def score_stream(spark, sf_dir):
    return _scored_store(spark, sf_dir).alerts.read(spark).select("id", "eventtime", "value", "base", "distance")


@query
def score_distances_stream(spark, sf_dir):
    """The distances that the scoring query leaves in the readings table."""
    return _scored_store(spark, sf_dir).readings.read(spark).select("device_id", "eventtime", "distance")


@query
def ingest_stream(spark, sf_dir):
    """Values and distances written together, from one decode."""
    return _scored_store(spark, sf_dir, start=jobs.start_ingesting).readings.read(spark)


@query
def anomaly_lines_stream(spark, sf_dir):
    def sink(store):
        return line_sink(store.lines, "anomalies", lambda rows: scoring.anomaly_lines(
            with_event_time(rows), REPLAY.score_window, _loaded_at()))

    return _scored_store(spark, sf_dir, [sink]).lines.read(spark)


def _trained_store(spark, sf_dir):
    root = new_folder(spark, "train")
    store = jobs.Store.under(root, replace(REPLAY, table_buckets=4))
    messages = as_messages(stream_events(spark, sf_dir))
    jobs.start_persisting(messages, store, f"{root}/persist", REPLAY, once=True).awaitTermination()
    with _waiting_for_data(spark):
        jobs.start_training(
            messages, store, f"{root}/train", REPLAY, once=True, clock=lambda: TRAINED_AT
        ).awaitTermination()
    return store


@query
def train_stream(spark, sf_dir):
    """The catalog after persisting the table and training every device that reaches the count."""
    return _plain_models(_trained_store(spark, sf_dir).models.read(spark))


@query
def training_rows_stream(spark, sf_dir):
    """The training table that live training loads."""
    return _trained_store(spark, sf_dir).training.read(spark).select("device_id", "eventtime", "value", "chunk")


@query
def reject_stream(spark, sf_dir):
    """Readings and rejects of a damaged stream add up: what cannot be stored is kept as it came."""
    root = new_folder(spark, "rejects")
    store = jobs.Store.under(root, replace(REPLAY, table_buckets=4))
    messages = as_damaged_messages(stream_events(spark, sf_dir))
    jobs.start_persisting(messages, store, f"{root}/checkpoint", REPLAY, once=True).awaitTermination()
    return store.rejects.read(spark).select(F.col("data").cast("string").alias("data"))
