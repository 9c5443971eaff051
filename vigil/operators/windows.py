"""Fixed event-time windows, per-key counts and diagnostic lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the shape of a diagnostic line.
LINE_FORMAT = "%s: Event: %s, Timestamp: %s, Window: [%s, %s), Current Time %s"


def assign_window(events: DataFrame, length: str) -> DataFrame:
    """Each event with the start and end of its fixed window."""
    w = F.window("event_ts", length)
    return events.withColumn("_w", w).select(
        *events.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )


def window_batches(events: DataFrame, length: str, lateness: str | None = None) -> DataFrame:
    """One row per window with its batch size and time range.

    The rows of a batch are written by the tasks that hold them, so no window is ever gathered.
    With `lateness` the same operator runs on a stream, and later events are dropped.
    """
    if lateness is not None:
        events = events.withWatermark("event_ts", lateness)
    return events.groupBy(F.window("event_ts", length).alias("w")).agg(
        F.count("*").alias("batch_rows"),
        F.min("eventtime").alias("first_eventtime"),
        F.max("eventtime").alias("last_eventtime"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "batch_rows", "first_eventtime", "last_eventtime",
    )


def score_batches(scores: DataFrame, length: str, threshold: float, lateness: str | None = None) -> DataFrame:
    """One row per window of scored events: size, events beyond the threshold, greatest distance."""
    if lateness is not None:
        scores = scores.withWatermark("event_ts", lateness)
    return scores.groupBy(F.window("event_ts", length).alias("w")).agg(
        F.count("*").alias("batch_rows"),
        F.count_if(F.col("distance") > F.lit(float(threshold))).alias("anomalies"),
        F.max("distance").alias("greatest_distance"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "batch_rows", "anomalies", "greatest_distance",
    )


def count_per_key(events: DataFrame, key: str = "id") -> DataFrame:
    return events.groupBy(key).agg(F.count("*").alias("n_events"))


def tap(rows: DataFrame, prefix: str, element: Column, length: str, now: Column | None = None) -> DataFrame:
    """A log line per row: element, its timestamp, its window and the current time."""
    now = F.current_timestamp() if now is None else now
    framed = assign_window(rows.withColumn("_element", element).withColumn("_now", now), length)

    def text(ts):
        return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")

    line = F.format_string(
        LINE_FORMAT,
        F.lit(prefix), F.col("_element"), text(F.col("event_ts")),
        text(F.col("window_start")), text(F.col("window_end")), text(F.col("_now")),
    )
    return framed.select("id", "eventtime", line.alias("line"))
