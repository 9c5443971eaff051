"""JSON messages to typed columns and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.numeric import derived_value, event_timestamp, own_slice, whole
from vigil.schemas import DEVICE_EVENT, RAW_MESSAGE


def _parsed(raw: DataFrame, data: str, schema) -> DataFrame:
    # A generator keeps the parse in one place. As a plain column it would be folded into the filter
    # and the projection above and parse each message once per field: 2.4 times slower.
    parsed = F.from_json(F.col(data).cast("string"), schema)
    return raw.select(data, F.explode(F.array(parsed)).alias("m"))


def _value():
    return derived_value(F.col("m.source.base"), F.col("m.variation"), F.col("m.isanomaly"))


# The fields that a message has to have, in the order in which their lack is told.
FIELDS = ("source.id", "source.base", "eventtime", "variation", "isanomaly")


def _storable() -> Column:
    """With a value that the readings table can hold; NaN and infinity cannot pass."""
    within = (_value() > F.lit(-(2.0**31) - 1)) & (_value() < F.lit(2.0**31))
    return F.coalesce(within, F.lit(False))


def _reason() -> Column:
    """Why a message cannot be stored; null for one that can."""
    missing = [F.col(f"m.{name}").isNull() for name in FIELDS]
    reason = F.when(reduce(lambda a, b: a & b, missing), "no message")
    for name, lacks in zip(FIELDS, missing):
        reason = reason.when(lacks, f"no {name}")
    return reason.when(~_storable(), "value out of range")


def parsed_messages(raw: DataFrame, data: str = "data") -> DataFrame:
    """Raw sensor messages with their fields and, where they cannot be stored, the `reason`: one parse for
    `usable_events` and `rejects`."""
    return _parsed(raw, data, RAW_MESSAGE).select(
        F.col(data).alias("data"),
        F.col("m.source.id").alias("id"),
        F.col("m.eventtime").alias("eventtime"),
        _value().alias("value"),
        F.col("m.source.base").alias("base"),
        _reason().alias("reason"),
    )


def usable_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).select("id", "eventtime", "value", "base")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("data", "reason")


def decode_messages(raw: DataFrame, data: str = "data") -> DataFrame:
    """Raw sensor messages to device events. What lacks a field or has no storable value is left to
    `rejected_messages`."""
    return usable_events(parsed_messages(raw, data))


def rejected_messages(raw: DataFrame, data: str = "data") -> DataFrame:
    """Messages that cannot be stored, as they came, and why."""
    return rejects(parsed_messages(raw, data))


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_ts", event_timestamp(F.col("eventtime")))


def encode_events(events: DataFrame) -> DataFrame:
    """Device events as one JSON document each."""
    return events.select(
        F.to_json(F.struct("id", "eventtime", "value", "base")).cast("binary").alias("data")
    )


def message_triples(encoded: DataFrame, data: str = "data") -> DataFrame:
    """Encoded device events to (id, eventtime, whole value)."""
    return _parsed(encoded, data, DEVICE_EVENT).select(
        F.col("m.id").alias("id"),
        F.col("m.eventtime").alias("eventtime"),
        whole(F.col("m.value")).alias("value"),
    )


def to_readings(events: DataFrame) -> DataFrame:
    """The value write: (device_id, eventtime, whole value), and the slice of events that have one."""
    return events.select(
        F.col("id").alias("device_id"),
        "eventtime",
        whole(F.col("value")).cast("int").alias("value"),
        *own_slice(events),
    )


def to_scored_readings(scores: DataFrame) -> DataFrame:
    """Both writes in one row: (device_id, eventtime, whole value, distance)."""
    return scores.select(
        F.col("id").alias("device_id"), "eventtime", whole(F.col("value")).cast("int").alias("value"),
        F.col("distance").cast("float").alias("distance"),
    )


def to_distances(scores: DataFrame) -> DataFrame:
    """The distance write: (device_id, eventtime, distance)."""
    return scores.select(
        F.col("id").alias("device_id"), "eventtime", F.col("distance").cast("float").alias("distance")
    )
