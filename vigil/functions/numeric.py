"""Column expressions for values, models and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The off-normal factor, and the marker that keeps the plain base.
OFF_NORMAL_FACTOR = 1.1
PLAIN_MARKER = 1


def derived_value(base: Column, variation: Column, isanomaly: Column) -> Column:
    level = F.when(isanomaly == PLAIN_MARKER, base).otherwise(base * F.lit(OFF_NORMAL_FACTOR))
    return level + variation


def whole(value: Column) -> Column:
    """Integer part, toward zero."""
    return value.cast("bigint")


def slice_start(time_ms: Column, width_ms: int) -> Column:
    return time_ms - F.pmod(time_ms, F.lit(width_ms))


#: A column of this name, where a table has it, is the start of each row's time slice.
SLICE = "_slice"


def with_slice(rows: DataFrame, time: str, width_ms: int) -> DataFrame:
    """`rows` with the start of their slice, unless they have it. Never null, so that joins add no null test of their
    own to one of two equal scans; a shuffle can then serve both."""
    if SLICE in rows.columns:
        return rows
    return rows.withColumn(SLICE, F.coalesce(slice_start(F.col(time), width_ms), F.lit(0).cast("bigint")))


def own_slice(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == SLICE]


def event_timestamp(time_ms: Column) -> Column:
    return F.timestamp_millis(time_ms)


def chunk_number(rank: Column, chunk_rows: int) -> Column:
    """Chunk of a 1-based rank; the first chunk is one row short."""
    return F.floor(rank / F.lit(chunk_rows)).cast("int")


def model_name(device_id: Column, trained_at_ms: Column) -> Column:
    minute = F.date_format(F.timestamp_millis(trained_at_ms), "mm")
    return F.format_string("model_%d_%s", device_id, minute)


def spread(n: Column, s: Column, ss: Column) -> Column:
    """n times the cluster radius. Products are exact decimals of up to 38 digits, enough for the widest readings of
    two thousand million rows."""
    squares = n.cast("decimal(19,0)") * ss.cast("decimal(28,0)") - s.cast("decimal(19,0)") * s.cast("decimal(19,0)")
    return F.sqrt(squares.cast("double"))


def centroid(n: Column, s: Column) -> Column:
    return s.cast("double") / n.cast("double")


def radius(n: Column, s: Column, ss: Column) -> Column:
    return spread(n, s, ss) / n.cast("double")


def normalized_distance(bp: Column, n: Column, s: Column, spread_: Column) -> Column:
    """Distance to the centroid in units of the radius; 0 without a model, infinite off a point cluster."""
    # A 32-bit value times a longer count may pass 64 bits; both ways are exact.
    exact = F.when(n < 2**31, F.abs(bp * n - s).cast("double")).otherwise(
        F.abs(bp.cast("decimal(10,0)") * n.cast("decimal(19,0)") - s).cast("double"))
    deviation = exact
    return (
        F.when(n.isNull(), F.lit(0.0))
        .when(spread_ > 0, deviation / spread_)
        .when(deviation == 0, F.lit(0.0))
        .otherwise(F.lit(float("inf")))
    )
