"""Message sources: any Spark source that yields one text or binary column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import Settings


def _as_messages(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).cast("binary").alias("data"))


def read_messages(spark: SparkSession, settings: Settings) -> DataFrame:
    """Unbounded messages: lines of files as they arrive, or a queue connector's `value` column."""
    reader = spark.readStream.format(settings.source_format).options(**settings.source_options)
    if settings.source_format in ("parquet", "json", "orc"):
        reader = reader.schema(f"{settings.source_column} STRING")
    df = reader.load(settings.source_path) if settings.source_path else reader.load()
    return _as_messages(df, settings.source_column)


def replay_messages(spark: SparkSession, settings: Settings) -> DataFrame:
    """The same messages as a bounded table."""
    reader = spark.read.format(settings.source_format).options(**settings.source_options)
    df = reader.load(settings.source_path) if settings.source_path else reader.load()
    return _as_messages(df, settings.source_column)
