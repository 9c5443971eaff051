"""The live queries: ingest (persist, score and alert) and train on triggers.

They meet only in tables: what one persists, the next reads, so each restarts from its own
checkpoint. Persisting and scoring also exist as queries of their own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.config import Settings, duration_ms
from vigil.functions.codec import (
    decode_messages,
    parsed_messages,
    rejects,
    to_distances,
    to_readings,
    to_scored_readings,
    usable_events,
    with_event_time,
)
from vigil.functions.numeric import slice_start
from vigil.operators.scoring import anomalies, score_with, score_with_versions, scoring_table, version_table
from vigil.operators.training import fit_models, latest_history
from vigil.operators.windows import window_batches
from vigil.schemas import (
    ALERT_RECORD,
    LATE_ROW,
    LATEST_READING,
    LINE,
    LOADED_ROW,
    MODEL,
    PANE_ROW,
    PROGRESS,
    READING,
    REJECT,
    TRIGGER,
)
from vigil.session import new_folder
from vigil.sources.sinks import BatchSink, append_sink, keyed_sink
from vigil.sources.tables import BatchLog, KeyedTable, LatestTable
from vigil.streaming.counter import PANE_FIRED, TOO_LATE, TRIGGERED, count_panes
from vigil.streaming.panes import pane_counts


def now_ms() -> int:
    return time.time_ns() // 1_000_000


@dataclass(frozen=True)
class Store:
    """The tables of one deployment."""

    readings: KeyedTable
    latest: LatestTable
    training: BatchLog
    models: KeyedTable
    versions: KeyedTable
    alerts: KeyedTable
    triggers: BatchLog
    panes: BatchLog
    rejects: BatchLog
    lines: BatchLog
    late: BatchLog
    progress: BatchLog

    @staticmethod
    def under(root: str, settings: Settings) -> Store:
        root, buckets = root.rstrip("/"), settings.table_buckets
        return Store(
            KeyedTable(f"{root}/readings", READING, ("device_id", "eventtime"), buckets),
            LatestTable(
                f"{root}/latest", LATEST_READING, ("device_id", "eventtime"), buckets,
                limit=settings.history_limit, salts=settings.salts),
            BatchLog(f"{root}/training", LOADED_ROW),
            KeyedTable(f"{root}/models", MODEL, ("id",), 1, order="trained_at"),
            KeyedTable(f"{root}/versions", MODEL, ("id", "trained_at"), 1),
            KeyedTable(f"{root}/alerts", ALERT_RECORD, ("id", "eventtime"), buckets, first_wins=True, order="notified_at"),
            BatchLog(f"{root}/triggers", TRIGGER),
            BatchLog(f"{root}/panes", PANE_ROW),
            BatchLog(f"{root}/rejects", REJECT),
            BatchLog(f"{root}/lines", LINE),
            BatchLog(f"{root}/late", LATE_ROW),
            BatchLog(f"{root}/progress", PROGRESS),
        )


class CatalogSnapshot:
    """The catalog as of the last refresh tick, merged once per tick and not once per batch.

    Snapshots alternate between two folders, so the one in use is never overwritten and old ones
    do not pile up. `make` turns what the table holds into the snapshot.
    """

    def __init__(
        self, models: KeyedTable, refresh_ms: int, clock: Callable[[], int] = now_ms,
        make: Callable[[DataFrame, str], DataFrame] = scoring_table,
    ):
        self.models, self.refresh_ms, self.clock, self.make = models, refresh_ms, clock, make
        self.tick: int | None = None
        self.rows: DataFrame | None = None
        self.folder: str | None = None
        self.taken = 0

    def current(self, spark: SparkSession) -> DataFrame:
        tick = self.clock() // self.refresh_ms
        if tick != self.tick:
            self.folder = self.folder or new_folder(spark, "snapshot")
            self.rows = self.make(self.models.read(spark), f"{self.folder}/{self.taken % 2}")
            self.tick, self.taken = tick, self.taken + 1
        return self.rows


class Scorer:
    """Scores micro-batches against the snapshot that `score_by` asks for."""

    def __init__(self, store: Store, settings: Settings, clock: Callable[[], int], progress: Progress):
        self.by_time, self.progress = settings.score_by == "event time", progress
        self.reach = duration_ms(settings.score_lateness) + duration_ms(settings.score_window)
        self.refresh_ms, self.mark = settings.refresh_ms, None
        self.catalog = CatalogSnapshot(
            store.versions if self.by_time else store.models, settings.refresh_ms, clock,
            self._versions if self.by_time else scoring_table)

    def _versions(self, versions: DataFrame, folder: str) -> DataFrame:
        # No event that is still scored is further behind the watermark.
        since = None if self.mark is None else self.mark - self.reach
        return version_table(versions, self.refresh_ms, since, folder)

    def snapshot(self, spark: SparkSession, batch_id: int) -> DataFrame:
        self.mark = self.progress.watermark(spark, batch_id)
        return self.catalog.current(spark)

    def score(self, events: DataFrame, snapshot: DataFrame) -> DataFrame:
        return (score_with_versions if self.by_time else score_with)(events, snapshot)


def _start(stream: DataFrame, handle, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


class Progress:
    """What each batch of a query held, noted while the batch is worked on, and the watermark that follows from it:
    the greatest event time of the batches before. A restart reads it back."""

    def __init__(self, table: BatchLog, writer: str):
        self.table, self.writer = table, writer
        self.known: tuple[int, int | None] | None = None  # a batch, and the watermark in it

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Of several queries that share the table, each goes by its own rows."""
        if self.known is None or self.known[0] != batch_id:
            own = self.table.read(spark).filter((F.col("query") == self.writer) & (F.col("batch") < batch_id))
            self.known = batch_id, own.agg(F.max("last_eventtime")).first()[0]
        return self.known[1]

    def note(self, spark: SparkSession, batch_id: int, counts: dict) -> None:
        mark = self.watermark(spark, batch_id)
        noted = {"query": self.writer, "batch": batch_id, **counts}
        rows = spark.createDataFrame([[noted[name] for name in PROGRESS.names]], PROGRESS)
        self.table.append(rows.coalesce(1), self.writer, batch_id)
        times = [t for t in (mark, counts["last_eventtime"]) if t is not None]
        self.known = batch_id + 1, max(times, default=None)


def _late(watermark: int | None, length: str, lateness: str):
    """Whether the window of an event is further behind the watermark than its lateness."""
    if watermark is None:
        return F.lit(False)
    size = duration_ms(length)
    return slice_start(F.col("eventtime"), size) + F.lit(size + duration_ms(lateness)) <= F.lit(watermark)


class Intake:
    """The start of a micro-batch: every message is parsed once, counted on the way, and told apart as event, late
    event of a stage, or reject. Where persisting and scoring are two queries, the first keeps the rejects and folds
    what both write."""

    def __init__(self, store: Store, settings: Settings, writer: str, stages: Sequence[str]):
        self.store, self.writer, self.settings = store, writer, settings
        self.windows = {"persist": (settings.persist_window, settings.persist_lateness),
                        "score": (settings.score_window, settings.score_lateness)}
        self.stages = stages
        self.first = "persist" in stages
        self.progress = Progress(store.progress, writer)

    def take(self, batch: DataFrame, batch_id: int, handle: Callable[[DataFrame], None]) -> None:
        """Hand the events, with a column `late_<stage>` for each stage, to `handle`; keep what is late or rejected."""
        spark = batch.sparkSession
        mark = self.progress.watermark(spark, batch_id)
        marked = parsed_messages(batch).withColumns({f"late_{s}": _late(mark, *self.windows[s]) for s in self.stages})
        late = [F.col("reason").isNull() & F.col(f"late_{s}") for s in self.stages]
        seen = Observation(f"{self.writer}-{batch_id}")
        parsed = marked.observe(
            seen, F.count(F.lit(1)).alias("messages"), F.count_if(F.col("reason").isNull()).alias("events"),
            F.count_if(F.col("reason").isNotNull()).alias("rejects"),
            sum((F.count_if(c) for c in late[1:]), F.count_if(late[0])).alias("late"),
            F.max(F.when(F.col("reason").isNull(), F.col("eventtime"))).alias("last_eventtime"),
        ).persist()
        try:
            if self.first:
                self.store.rejects.append(rejects(parsed), "decoder", batch_id)
            handle(parsed.filter(F.col("reason").isNull()).drop("data", "reason"))
            found = [
                parsed.filter(c).select(
                    F.lit(s).alias("stage"), "id", "eventtime", "value",
                    slice_start(F.col("eventtime"), duration_ms(self.windows[s][0])).alias("window_start"),
                    F.lit(mark).cast("bigint").alias("watermark"))
                for s, c in zip(self.stages, late)]
            counts = seen.get
            if counts["late"]:
                self.store.late.append(reduce(DataFrame.unionByName, found), self.writer, batch_id)
        finally:
            parsed.unpersist()
        # Last, so that a batch that is worked on again goes by the same watermark.
        self.progress.note(spark, batch_id, counts)

    def fold(self, spark: SparkSession, batch_id: int, *tables: BatchLog) -> None:
        if batch_id % self.settings.fold_batches == self.settings.fold_batches - 1:
            shared = (self.store.rejects, self.store.late, self.store.progress) if self.first else ()
            for table in (*shared, *tables):
                table.fold(spark)


def start_persisting(
    messages: DataFrame, store: Store, checkpoint: str, settings: Settings, once: bool = False
) -> StreamingQuery:
    """Store the readings of every micro-batch, what cannot be stored as rejects, and what is too late as late rows."""
    write, keep = keyed_sink(store.readings, "values", to_readings), keyed_sink(store.latest, "values", to_readings)
    intake = Intake(store, settings, "persist", ["persist"])

    def handle(batch: DataFrame, batch_id: int) -> None:
        def store_values(events: DataFrame) -> None:
            in_time = events.filter(~F.col("late_persist"))
            write(in_time, batch_id)
            keep(in_time, batch_id)

        intake.take(batch, batch_id, store_values)
        intake.fold(batch.sparkSession, batch_id, store.readings, store.latest)

    return _start(messages, handle, checkpoint, None if once else settings.persist_trigger)


def train_batch(
    triggers: DataFrame, batch_id: int, store: Store, settings: Settings, clock: Callable[[], int] = now_ms,
    sinks: Sequence[BatchSink] = (), taps: Sequence[BatchSink] = (),
) -> None:
    """Collect, load, wait and train for the devices of one batch of triggers.

    `taps` get the triggers whose readings were collected, `sinks` the new models."""
    spark = triggers.sparkSession
    collected = triggers.groupBy(F.col("id").alias("device_id")).agg(F.max("eventtime").alias("_at")).persist()
    try:
        if collected.isEmpty():
            return
        # The newest readings of each device are kept beside the readings, so that these are not read.
        stored = store.latest.read_keys(spark, collected)
        history = latest_history(stored, settings.history_limit, settings.chunk_rows, settings.salts)
        rows = history.join(collected, "device_id").select(
            "device_id", "value", "eventtime", F.timestamp_millis("_at").alias("collected_at"),
            F.current_timestamp().alias("loaded_at"), "chunk",
        )
        store.training.append(rows, "loads", batch_id)
        for tap in taps:
            tap(triggers, batch_id)
        # The write above is complete before the next statement reads it back: the barrier.
        loaded = store.training.read_batch(spark, "loads", batch_id)
        by_event = settings.score_by == "event time"
        trained_at = F.unix_millis("collected_at") if by_event else F.lit(clock()).cast("bigint")
        dated = loaded.withColumn("trained_at", trained_at)
        store.models.append(fit_models(dated, "trained_at"), "trainer", batch_id)
        if by_event:
            store.versions.append(store.models.read_batch(spark, "trainer", batch_id), "trainer", batch_id)
        for sink in sinks:
            sink(store.models.read_batch(spark, "trainer", batch_id), batch_id)
    finally:
        collected.unpersist()


def start_training(
    messages: DataFrame, store: Store, checkpoint: str, settings: Settings, once: bool = False,
    clock: Callable[[], int] = now_ms, sinks: Sequence[BatchSink] = (), taps: Sequence[BatchSink] = (),
) -> StreamingQuery:
    """Count events, gather the triggers in windows, and train when a window's pane fires; triggers that come too
    late for their pane are kept as late rows. Run once, a pane fires with its first trigger.

    A stateful stream runs its batches without adaptive execution. So the few rows are written, and the work on the
    tables is done by the session that started the query, where it is on."""
    delay = 0 if once else duration_ms(settings.training_delay)
    found = count_panes(
        with_event_time(decode_messages(messages)), settings.trigger_limit, settings.cooldown_ms,
        duration_ms(settings.training_window), duration_ms(settings.training_lateness), delay)
    spark = messages.sparkSession
    note_late = append_sink(store.late, "training", lambda rows: rows.select(
        F.lit("training").alias("stage"), "id", "eventtime", F.lit(None).cast("double").alias("value"), "window_start",
        "watermark"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        store.panes.append(batch, "counter", batch_id)
        rows = store.panes.read_batch(spark, "counter", batch_id).persist()
        try:
            kinds = {r["firing"] for r in rows.select("firing").distinct().collect()}  # three at most
            triggers = rows.filter(F.col("firing") == TRIGGERED).select("id", "eventtime")
            if TRIGGERED in kinds:
                store.triggers.append(triggers, "counter", batch_id)
                for tap in taps:
                    tap(triggers, batch_id)
            if TOO_LATE in kinds:
                note_late(rows.filter(F.col("firing") == TOO_LATE), batch_id)
            if PANE_FIRED in kinds:
                train_batch(rows.filter(F.col("firing") == PANE_FIRED), batch_id, store, settings, clock, sinks)
        finally:
            rows.unpersist()
        if batch_id % settings.fold_batches == settings.fold_batches - 1:
            for table in (store.panes, store.triggers, store.training, store.models, store.versions, store.lines):
                table.fold(spark)

    return _start(found, handle, checkpoint, None if once else settings.training_trigger)


def _store_scores(scores, batch_id, store, settings, projection, writer, sinks) -> None:
    """Store the distances of a batch, and record what is beyond the threshold; `sinks` get that too."""
    scores = scores.persist()
    try:
        store.readings.append(projection(scores), writer, batch_id)
        found = anomalies(scores, settings.threshold)
        records = found.select(
            "id", "eventtime", F.current_timestamp().alias("notified_at"), "value", "base", "distance"
        )
        store.alerts.append(records, "scorer", batch_id)
        for sink in sinks:
            sink(found, batch_id)
    finally:
        scores.unpersist()


def start_scoring(
    messages: DataFrame, store: Store, checkpoint: str, settings: Settings, once: bool = False,
    clock: Callable[[], int] = now_ms, sinks: Sequence[BatchSink] = (),
) -> StreamingQuery:
    """Score every micro-batch; events that are too late for their window are kept as late rows."""
    intake = Intake(store, settings, "scorer", ["score"])
    scorer = Scorer(store, settings, clock, intake.progress)

    def handle(batch: DataFrame, batch_id: int) -> None:
        snapshot = scorer.snapshot(batch.sparkSession, batch_id)

        def score_and_store(events: DataFrame) -> None:
            in_time = events.filter(~F.col("late_score")).drop("late_score")
            _store_scores(scorer.score(in_time, snapshot), batch_id, store, settings, to_distances, "distances", sinks)

        intake.take(batch, batch_id, score_and_store)
        intake.fold(batch.sparkSession, batch_id, store.alerts)

    return _start(messages, handle, checkpoint, None if once else settings.persist_trigger)


def start_ingesting(
    messages: DataFrame, store: Store, checkpoint: str, settings: Settings, once: bool = False,
    clock: Callable[[], int] = now_ms, sinks: Sequence[BatchSink] = (),
) -> StreamingQuery:
    """`start_persisting` and `start_scoring` as one query: each message is parsed once, and each batch writes one
    row per reading with value and distance. An event that is too late to be stored but not to be scored leaves its
    distance alone."""
    keep = keyed_sink(store.latest, "readings", to_readings)
    intake = Intake(store, settings, "ingest", ["persist", "score"])
    scorer = Scorer(store, settings, clock, intake.progress)

    def stored(scores: DataFrame) -> DataFrame:
        late = F.col("late_persist")
        rows = to_scored_readings(scores.filter(~late)).unionByName(
            to_distances(scores.filter(late)), allowMissingColumns=True)
        return rows.select("device_id", "eventtime", "value", "distance")

    def handle(batch: DataFrame, batch_id: int) -> None:
        snapshot = scorer.snapshot(batch.sparkSession, batch_id)

        def score_and_store(events: DataFrame) -> None:
            in_time = events.filter(~F.col("late_score")).drop("late_score")
            _store_scores(scorer.score(in_time, snapshot), batch_id, store, settings, stored, "readings", sinks)
            keep(events.filter(~F.col("late_persist")), batch_id)

        intake.take(batch, batch_id, score_and_store)
        intake.fold(batch.sparkSession, batch_id, store.readings, store.latest, store.alerts)

    return _start(messages, handle, checkpoint, None if once else settings.persist_trigger)


def timed(messages: DataFrame) -> DataFrame:
    """Decoded events with event time, ready for windows."""
    return with_event_time(decode_messages(messages))


def start_window_batches(
    events: DataFrame, path: str, checkpoint: str, length: str, lateness: str, every: str | None
) -> StreamingQuery:
    """Append each window's batch once the watermark has passed its end; later events are dropped."""
    batches = window_batches(events, length, lateness)
    writer = batches.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def start_panes(
    events: DataFrame, path: str, checkpoint: str, length: str, lateness: str, delay: str, every: str | None
) -> StreamingQuery:
    """Append every pane of the windows of `events` as it fires."""
    panes = pane_counts(events, duration_ms(length), duration_ms(lateness), duration_ms(delay))
    writer = panes.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
