"""Work that needs a device's rows in time order, without ever gathering a device.

A device may own a third of all rows, so nothing here sorts or windows a whole device. Rows are
ordered within a (device, time slice), which is bounded because rows are keyed by millisecond;
only per-slice summaries are ordered across a device.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.numeric import SLICE, with_slice


def latest_rows(rows: DataFrame, key: str, time: str, limit: int, salts: int) -> DataFrame:
    """The newest `limit` rows per key with their 1-based rank `rn`.

    Ranked per (key, salt) first: the limit is applied before each shuffle, and the final step
    sees at most `salts * limit` rows of a key.
    """
    order = F.col(time).desc()
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(time), F.lit(salts)))
    near = salted.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(order))
    ).filter(F.col("_rn") <= limit)
    return (
        near.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(order)))
        .filter(F.col("rn") <= limit)
        .drop("_salt", "_rn")
    )


def history_before(
    rows: DataFrame, cuts: DataFrame, key: str, time: str, cut: str, limit: int, slice_ms: int
) -> DataFrame:
    """For each (key, cut) the newest `limit` rows at or before the cut, with rank `rn` (1 = newest).

    Rows and cuts are numbered together within a (key, slice), newest first; slice totals give each
    its position in the whole history. A cut at position R then wants the positions R-limit+1..R,
    which lie in at most two blocks of `limit` positions, so rows and cuts meet per (key, block),
    a group of at most `limit` rows.
    """
    columns = [c for c in rows.columns if c not in (key, time, SLICE)]
    wanted = with_slice(cuts.select(key, F.col(cut).alias(time)).distinct(), time, slice_ms)
    if SLICE in rows.columns:  # rows that are laid out by slice stay where they are; the few cuts come to them
        wanted = wanted.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, SLICE)
    marked = with_slice(rows, time, slice_ms).select(key, time, *columns, SLICE, F.lit(1).alias("_w")).unionByName(
        wanted.withColumn("_w", F.lit(0)), allowMissingColumns=True)

    # Newest first, a cut before the row of its own millisecond: the running weight is then the
    # number of rows after the cut, or the row's own place counted from the end of the slice.
    newest_first = Window.partitionBy(key, "_slice").orderBy(F.col(time).desc(), "_w")
    running = newest_first.rowsBetween(Window.unboundedPreceding, 0)
    is_cut = F.col("_w") == 0
    after = F.col("_after")
    # A row is out of reach if the next cut of its slice is too far and enough rows follow it in
    # the slice to hide it from cuts of later slices.
    reachable = (after - F.col("_cut_after") <= limit) | (after <= limit)
    near = (
        marked.withColumn("_after", F.sum("_w").over(running))
        .withColumn("_cut_after", F.last(F.when(is_cut, after), ignorenulls=True).over(running))
        .filter(is_cut | reachable)
    )

    totals = marked.groupBy(key, "_slice").agg(F.sum("_w").alias("_size"))
    upto = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.select(key, "_slice", F.sum("_size").over(upto).alias("_upto"))

    position = F.col("_upto") - after + F.col("_w")
    block = F.ceil(F.col("_pos") / F.lit(limit))
    met = (
        near.join(totals, [key, "_slice"])
        .withColumn("_pos", position)
        .filter(F.col("_pos") > 0)
        .withColumn("_block", F.explode(F.when(is_cut, F.array(block, block - 1)).otherwise(F.array(block))))
        .withColumn(
            "_cuts",
            F.collect_list(F.when(is_cut, F.struct(F.col(time).alias(cut), "_pos"))).over(
                Window.partitionBy(key, "_block")
            ),
        )
        .filter(~is_cut)
    )
    wanting = F.filter("_cuts", lambda c: (c["_pos"] - F.col("_pos")).between(0, limit - 1))
    return met.withColumn("_c", F.explode(wanting)).select(
        key, f"_c.{cut}", (F.col("_c._pos") - F.col("_pos") + 1).cast("int").alias("rn"), time, *columns
    )


def as_of(
    left: DataFrame, right: DataFrame, key: str, time: str, since: str, slice_ms: int
) -> DataFrame:
    """Each left row with the newest right row whose `since` is at or before `time` (or nulls).

    Every (key, slice) gets the few right rows that matter to it: those inside, and the newest one
    from before. The left side meets them by an equi-join on (key, slice) and is never sorted whole.
    """
    columns = [c for c in right.columns if c not in (key, since)]
    versions = with_slice(right, since, slice_ms).select(key, SLICE, F.struct(since, *columns).alias("_v")).groupBy(key, "_slice").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
    rows = with_slice(left, time, slice_ms)
    grid = (
        rows.select(key, "_slice").distinct()
        .join(versions, [key, "_slice"], "full_outer")
    )
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(F.try_element_at("_vs", F.lit(-1)), ignorenulls=True).over(earlier)
    choices = grid.select(
        key, "_slice",
        F.array_compact(F.concat(F.array(carried), F.coalesce("_vs", F.array()))).alias("_vs"),
    ).filter(F.size("_vs") > 0)
    pick = F.try_element_at(F.filter("_vs", lambda v: v[since] <= F.col(time)), F.lit(-1))
    joined = rows.join(choices, [key, "_slice"], "left").withColumn("_v", pick)
    return joined.select(
        *left.columns, F.col(f"_v.{since}").alias(since), *[F.col(f"_v.{c}").alias(c) for c in columns]
    )
