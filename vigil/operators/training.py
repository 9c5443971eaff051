"""Training sets, their load in chunks, and the one-cluster model of each device."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.numeric import centroid, chunk_number, event_timestamp, model_name, own_slice, radius
from vigil.operators.ordered import history_before, latest_rows
from vigil.schemas import TRAINING_ROW


def latest_history(readings: DataFrame, limit: int, chunk_rows: int, salts: int) -> DataFrame:
    """The newest stored readings of every device, ranked and numbered in chunks."""
    present = readings.filter(F.col("value").isNotNull()).select("device_id", "eventtime", "value")
    return (
        latest_rows(present, "device_id", "eventtime", limit, salts)
        .withColumn("chunk", chunk_number(F.col("rn"), chunk_rows))
        .select("device_id", "rn", "chunk", "eventtime", "value")
    )


def history_at_triggers(
    readings: DataFrame, triggers: DataFrame, limit: int, chunk_rows: int, slice_ms: int
) -> DataFrame:
    """What `latest_history` would have read at the moment of each trigger."""
    present = readings.filter(F.col("value").isNotNull()).select("device_id", "eventtime", "value", *own_slice(readings))
    cuts = triggers.select(F.col("id").alias("device_id"), F.col("eventtime").alias("trained_at"))
    return history_before(
        present, cuts, "device_id", "eventtime", "trained_at", limit, slice_ms
    ).withColumn("chunk", chunk_number(F.col("rn"), chunk_rows))


def to_training_json(history: DataFrame, collected_at_ms: Column) -> DataFrame:
    """Readings as the JSON rows that travel to the training table, keyed by device and chunk."""
    seconds = collected_at_ms.cast("double") / F.lit(1000.0)
    row = F.struct("device_id", "value", "eventtime", seconds.alias("timestamp"))
    return history.select("device_id", "chunk", F.to_json(row).alias("row"))


def typed_training_rows(rows: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """JSON rows back to training-table columns, with the time they were collected and loaded."""
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    parsed = rows.select(F.inline(F.array(F.from_json("row", TRAINING_ROW))))
    return parsed.select(
        "device_id", "value", "eventtime",
        event_timestamp((F.col("timestamp") * 1000).cast("bigint")).alias("collected_at"),
        loaded_at.alias("loaded_at"),
    )


def training_set(loaded: DataFrame, limit: int, salts: int) -> DataFrame:
    """The newest readings of every device in the training table, each once however often it was loaded."""
    readings = loaded.groupBy("device_id", "eventtime").agg(F.max("value").alias("value"))
    return latest_rows(readings, "device_id", "eventtime", limit, salts)


def load_counts(history: DataFrame, *extra: str) -> DataFrame:
    """Rows loaded per device and chunk."""
    return history.groupBy("device_id", *extra, "chunk").agg(F.count("*").alias("n")).withColumnRenamed(
        "device_id", "id"
    )


def rekey_counts(counts: DataFrame) -> DataFrame:
    return counts.select("id", "n")


def load_barrier(counts: DataFrame) -> DataFrame:
    """All chunk counts of a device, once every chunk is in. A device has at most history/chunk + 1."""
    return counts.groupBy("id").agg(
        F.sort_array(F.collect_list("n")).alias("chunk_sizes"), F.sum("n").alias("n_rows")
    )


def fit_models(history: DataFrame, *version: str) -> DataFrame:
    """k-means with one cluster in closed form: count, sum and sum of squares per device.

    `history` has (device_id, value, ...) and, per version, `trained_at`; without version columns
    the newest reading dates the model.
    """
    bp = F.col("value").cast("bigint")
    trained_at = [] if "trained_at" in version else [F.max("eventtime").alias("trained_at")]
    stats = history.groupBy("device_id", *version).agg(
        F.count(bp).alias("n"), F.sum(bp).alias("s"), F.sum((bp * bp).cast("decimal(19,0)")).cast("decimal(28,0)").alias("ss"), *trained_at
    )
    return stats.filter(F.col("n") > 0).select(
        F.col("device_id").alias("id"),
        model_name(F.col("device_id"), F.col("trained_at")).alias("model"),
        "n", "s", "ss",
        centroid(F.col("n"), F.col("s")).alias("centroid"),
        radius(F.col("n"), F.col("s"), F.col("ss")).alias("radius"),
        "trained_at",
    )


def trained_lines(models: DataFrame, label: str = "MODEL TRAINED") -> DataFrame:
    return models.select("id", F.format_string("%s: (%d, %s)", F.lit(label), "id", "model").alias("line"))
