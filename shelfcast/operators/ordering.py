"""Positions in a total order, computed without sending everything to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.session import cut_lineage


def ranged_index(df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "index") -> DataFrame:
    """Zero-based position of each row in ``order``, counted separately inside each ``within`` group.

    Spark's range partitioner spreads the sorted rows over tasks; each task
    numbers its own rows and adds the number of rows in earlier ranges.  A
    global ``row_number`` would need one task for all rows (or for a hot
    group).  The range boundaries are sampled, so the ranged rows are
    materialised once and both reads see the same boundaries.
    """
    within = list(within)
    ranged = cut_lineage(
        df.repartitionByRange(*[F.col(c) for c in within], *order).withColumn("_range", F.spark_partition_id())
    )
    local = Window.partitionBy("_range", *within).orderBy(*order)
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range", *within)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", *within, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ranged.withColumn("_local", F.row_number().over(local))
        .join(offsets, ["_range", *within])
        .withColumn(name, F.col("_offset") + F.col("_local") - 1)
        .drop("_range", "_local", "_offset")
    )


def order_like(df: DataFrame, sample: DataFrame, key: str = "id", order: str = "order") -> DataFrame:
    """Rows of ``df`` in the row order recorded in ``sample``."""
    return df.join(sample.select(key, order), key).orderBy(order)
