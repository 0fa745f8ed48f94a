"""Connected components by alternating large stars and small stars, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import attach_groups, store


def least_neighbour(edges: DataFrame) -> DataFrame:
    """``edges`` (``u, v``, stored) with ``m``, the least of ``u`` and its neighbours; hubs are joined by broadcast."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    return attach_groups(edges, store(least, "star-least"), "u", "n")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``); the root is the least node of the component.

    A large star hangs a node's larger neighbours on its least neighbour, a
    small star the smaller ones.  Components stay connected, and the rounds end
    with one star each, after about the square of the logarithm of the size.
    Every round is a stored table, so a lost executor repeats one round at most.
    """
    now = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "star-edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = store(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "star-both")
        large = store(
            least_neighbour(both).filter("v > u AND v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "star-large",
        )
        starred = least_neighbour(large)
        now = store(
            starred.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(starred.select("u", F.col("m").alias("v"))).distinct(),
            "star-edges",
        )
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
