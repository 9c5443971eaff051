"""The given `events` table in the shapes the engine takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read_events(spark, sf_dir).schema
    # A stream takes a folder or a pattern; the table may be a folder or a single file.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _time_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def as_device_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").cast("int").alias("id"), _time_ms().alias("eventtime"), "value")


def _message_text() -> Column:
    k = F.get_json_object("props", "$.k").cast("int")
    normal = F.when((F.col("event_type") == "error") & (k % 10 == 0), 5).otherwise(1)
    return F.concat(
        F.lit('{"source":{"id":'), F.col("user_id") + 1000, F.lit(',"base":'), 110 + F.col("user_id") % 26,
        F.lit('},"eventtime":'), _time_ms(), F.lit(',"variation":'), k % 15 - 7,
        F.lit(',"isanomaly":'), normal, F.lit("}"),
    )


def as_messages(events: DataFrame) -> DataFrame:
    """One JSON document per event, as a sensor would send it."""
    return events.select(_message_text().cast("binary").alias("data"))


def as_damaged_messages(events: DataFrame) -> DataFrame:
    """The same, but `error` messages are cut short, `view` messages have no time, and some `click` messages
    have a base that is no number or too large, or a marker with a fraction."""
    click = F.col("event_type") == "click"
    last = F.get_json_object("props", "$.k").cast("int") % 10
    text = _message_text()
    damaged = (
        F.when(F.col("event_type") == "error", F.substring(text, 1, 30))
        .when(F.col("event_type") == "view", F.regexp_replace(text, '"eventtime":[0-9]+,', ""))
        .when(click & (last == 1), F.regexp_replace(text, '"base":[0-9]+', '"base":NaN'))
        .when(click & (last == 2), F.regexp_replace(text, '"base":[0-9]+', '"base":1e12'))
        .when(click & (last == 3), F.replace(text, F.lit('"isanomaly":1}'), F.lit('"isanomaly":1.0}')))
        .when(click & (last == 4), F.replace(text, F.lit('"isanomaly":1}'), F.lit('"isanomaly":5.5}')))
        .otherwise(text)
    )
    return events.select(damaged.cast("binary").alias("data"))
