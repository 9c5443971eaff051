"""Model versions, the refresh clock, and what a scorer sees of the catalog at a given time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.numeric import slice_start
from vigil.operators.ordered import as_of


def refresh_tick(time_ms: Column, refresh_ms: int) -> Column:
    return slice_start(time_ms, refresh_ms)


def refresh_ticks(spark: SparkSession, first_ms: int, last_ms: int, refresh_ms: int) -> DataFrame:
    """Every tick from that of `first_ms` to that of `last_ms`."""
    first = first_ms // refresh_ms * refresh_ms
    return spark.range(first, last_ms + 1, refresh_ms).withColumnRenamed("id", "tick")


def snapshot_windows(events: DataFrame, refresh_ms: int) -> DataFrame:
    """Each tick with the events that are scored from its snapshot; idle ticks have none.

    The first and last time are looked up when this is called."""
    first, last = events.agg(F.min("eventtime"), F.max("eventtime")).first()
    span = (0, -1) if first is None else (first, last)
    return windows_of_ticks(refresh_ticks(events.sparkSession, *span, refresh_ms), events, refresh_ms)


def windows_of_ticks(ticks: DataFrame, events: DataFrame, refresh_ms: int) -> DataFrame:
    """Each of the `ticks` with the events that are scored from its snapshot."""
    used = events.groupBy(refresh_tick(F.col("eventtime"), refresh_ms).alias("tick")).agg(
        F.count("*").alias("n_events")
    )
    return ticks.join(used, "tick", "left").select("tick", F.coalesce("n_events", F.lit(0)).alias("n_events"))


def with_effective_time(versions: DataFrame, refresh_ms: int) -> DataFrame:
    """A model is seen from the first tick after its training on."""
    tick = refresh_tick(F.col("trained_at"), refresh_ms) + F.lit(refresh_ms)
    return versions.withColumn("effective_from", tick)


def newest_per_tick(versions: DataFrame) -> DataFrame:
    """Of several versions that become visible at one tick, the last trained."""
    columns = [c for c in versions.columns if c not in ("id", "effective_from")]
    ordered = F.struct("trained_at", *[c for c in columns if c != "trained_at"])
    newest = versions.groupBy("id", "effective_from").agg(F.max(ordered).alias("_v"))
    return newest.select("id", *[F.col(f"_v.{c}").alias(c) for c in columns], "effective_from")


def model_snapshots(versions: DataFrame, refresh_ms: int) -> DataFrame:
    """All catalog snapshots in interval form.

    The snapshot of tick k holds the rows with effective_from <= k and (effective_until null or > k).
    A device has at most one version per cooldown, so the window runs over few rows.
    """
    visible = newest_per_tick(with_effective_time(versions, refresh_ms))
    later = Window.partitionBy("id").orderBy("effective_from")
    return visible.withColumn("effective_until", F.lead("effective_from").over(later)).select(
        "id", "model", "trained_at", "effective_from", "effective_until"
    )


def version_arrays(versions: DataFrame, refresh_ms: int, since: int | None = None) -> DataFrame:
    """(id, versions): per device its versions in the order in which they become visible, as one sorted array.

    With `since`, of the versions that are visible by then only the newest is kept: no event from then on needs the
    others, so that the array stays as short as the versions of that time. A device has at most one version a tick."""
    visible = newest_per_tick(with_effective_time(versions, refresh_ms))
    columns = [c for c in visible.columns if c not in ("id", "effective_from")]
    sorted_ = visible.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("effective_from", *columns))).alias("versions"))
    if since is None:
        return sorted_
    passed = F.size(F.filter("versions", lambda v: v["effective_from"] <= since))
    first = F.greatest(passed, F.lit(1))
    return sorted_.withColumn("versions", F.slice("versions", first, F.size("versions")))


def visible_version(versions: str, time: str) -> Column:
    """The last of a sorted array of versions that is visible at `time`, or null."""
    return F.try_element_at(F.filter(versions, lambda v: v["effective_from"] <= F.col(time)), F.lit(-1))


def latest_models(versions: DataFrame) -> DataFrame:
    """The catalog proper: one row per device, the last trained."""
    columns = [c for c in versions.columns if c != "id"]
    ordered = F.struct("trained_at", *[c for c in columns if c != "trained_at"])
    newest = versions.groupBy("id").agg(F.max(ordered).alias("_v"))
    return newest.select("id", *[F.col(f"_v.{c}").alias(c) for c in columns])


def with_model_as_of(events: DataFrame, versions: DataFrame, refresh_ms: int, slice_ms: int) -> DataFrame:
    """Each event with the version of its device that was visible at its time."""
    visible = newest_per_tick(with_effective_time(versions, refresh_ms))
    return as_of(events, visible, "id", "eventtime", "effective_from", slice_ms)
