"""Connected components of a large graph by alternating star steps (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigil.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number and checksum of the edges: two numbers for the driver, whatever their size."""
    row = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]


def _pointed(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (u, v) but the roots: the least node of its component.

    In a large-star step each node links its greater neighbours to the least it sees; in a small-star step
    its smaller ones and itself. No neighbourhood is gathered: the least neighbour is an aggregate, and links
    are remade by a join whose sides are written tables, so that a node with very many links is split.
    Loops and repeated edges are harmless; rows with a null end are left out.
    """
    edges = materialize(_pointed(edges.where("u is not null and v is not null").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("least")), "large-star")
        edges = materialize(_pointed(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))), "edges")
        least = materialize(edges.groupBy("u").agg(F.min("v").alias("least")), "small-star")
        joined = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = materialize(_pointed(joined.unionByName(least.select("u", F.col("least").alias("v")))), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
