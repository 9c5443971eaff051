"""Keyed upsert where each write sets some columns and leaves the others as they are.

A null stands for "not written" and never hides an earlier value. Both forms take one shuffle with
hash aggregation on either side of it; nothing is joined.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_upsert(base: DataFrame | None, updates: list[DataFrame], keys: list[str]) -> DataFrame:
    """`base`, or an empty table, after the updates in turn; an update may carry any subset of the other columns.

    A key that an update writes twice takes the greater value, whatever the row order.
    """
    layers = [df.withColumn("_layer", F.lit(i)) for i, df in enumerate(([] if base is None else [base]) + updates)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)

    def newest(name):
        in_layer = [F.max(F.when(F.col("_layer") == i, F.col(name))) for i in reversed(range(len(layers)))]
        return F.coalesce(*in_layer).alias(name)

    columns = [c for c in stacked.columns if c not in (*keys, "_layer")]
    return stacked.groupBy(*keys).agg(*[newest(c) for c in columns])


def merge_log(writes: DataFrame, keys: list[str], order: str, first: bool = False) -> DataFrame:
    """Per key and column the value with the highest, or lowest, `order`, which must not repeat within a key."""

    def newest(name):
        chosen = F.min_by if first else F.max_by
        return chosen(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name)

    columns = [c for c in writes.columns if c not in (*keys, order)]
    return writes.groupBy(*keys).agg(*[newest(c) for c in columns])
