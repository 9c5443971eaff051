"""Distances, anomalies and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.numeric import event_timestamp, normalized_distance, spread, whole
from vigil.operators.catalog import version_arrays, visible_version, with_model_as_of
from vigil.operators.windows import tap
from vigil.session import materialize


def _score_columns(models: DataFrame) -> DataFrame:
    # The square root is taken once per model, below the join.
    return models.select(
        "id", "model", "n", "s", spread(F.col("n"), F.col("s"), F.col("ss")).alias("spread"), "trained_at"
    )


def _with_distance(joined: DataFrame, columns: list[str]) -> DataFrame:
    distance = normalized_distance(whole(F.col("value")), F.col("n"), F.col("s"), F.col("spread"))
    return joined.select(*columns, "model", distance.alias("distance"))


def scoring_table(models: DataFrame, folder: str | None = None) -> DataFrame:
    """What a scorer needs of the models, as a written table.

    The join then knows the table's true size and broadcasts it only if it is small. Otherwise both
    sides are plain shuffles, and only then does adaptive execution split a device that holds a large
    part of the events: it does not where one side comes straight from an aggregate by the join key.
    """
    return materialize(_score_columns(models), "models", folder)


def score_with(events: DataFrame, table: DataFrame) -> DataFrame:
    """Each event with its distance from the model of its device in a `scoring_table`, 0 if it has none."""
    return _with_distance(events.join(table, "id", "left"), events.columns)


def version_table(versions: DataFrame, refresh_ms: int, since: int | None = None, folder: str | None = None) -> DataFrame:
    """As `scoring_table`, with all versions of a device that events from `since` on may meet."""
    return materialize(version_arrays(_score_columns(versions), refresh_ms, since), "versions", folder)


def score_with_versions(events: DataFrame, table: DataFrame) -> DataFrame:
    """Each event with its distance from the version in a `version_table` that was visible at its time."""
    found = events.join(table, "id", "left").withColumn("_v", visible_version("versions", "eventtime"))
    return _with_distance(found.select(*events.columns, "_v.*"), events.columns)


def score(events: DataFrame, models: DataFrame) -> DataFrame:
    return score_with(events, scoring_table(models))


def score_as_of(events: DataFrame, versions: DataFrame, refresh_ms: int, slice_ms: int) -> DataFrame:
    """`score` against the catalog snapshot each event would have met."""
    joined = with_model_as_of(events, _score_columns(versions), refresh_ms, slice_ms)
    return _with_distance(joined, events.columns)


def anomalies(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.filter(F.col("distance") > F.lit(float(threshold)))


def to_alerts(found: DataFrame, notified_at: Column | None = None) -> DataFrame:
    """Alert rows, one per device and time; of several the smallest value stands, whatever the order."""
    notified_at = F.current_timestamp() if notified_at is None else notified_at
    first = found.groupBy("id", "eventtime").agg(F.min(F.struct("value", "base")).alias("_a"))
    return first.select(
        "id", event_timestamp(F.col("eventtime")).alias("eventtime"), notified_at.alias("notified_at"),
        F.col("_a.value").alias("value"), F.col("_a.base").alias("base"),
    )


def collection_lines(triggers: DataFrame, length: str, now: Column | None = None) -> DataFrame:
    element = F.format_string("(%d, %d)", F.col("id"), F.col("eventtime"))
    return tap(triggers, "Training Events Collected For", element, length, now)


def anomaly_lines(found: DataFrame, length: str, now: Column | None = None) -> DataFrame:
    element = F.format_string("(%d, %d, %d)", F.col("id"), F.col("eventtime"), whole(F.col("value")))
    return tap(found, "Anomaly Detected", element, length, now)
