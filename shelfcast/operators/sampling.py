"""Reproducible samples.

Draws are hashes of row keys, so a sample does not depend on partitioning,
task retries or executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.numeric import hashed_poisson, hashed_uniform
from shelfcast.operators.ordering import ranged_index
from shelfcast.session import measured


# Bins of a rank per factor of two: the bin of the last row drawn holds about 1% of the rows before it.
BINS_PER_OCTAVE = 64
# Ranks below this (0 too) share a bin; hashed draws are multiples of 2**-33.
LEAST_RANK = 2.0**-64


def rank_bin(rank: Column) -> Column:
    """Logarithmic bin of a rank that is not negative: some thousands of bins at most, whatever the number of rows."""
    return F.floor(F.log2(F.greatest(rank, F.lit(LEAST_RANK))) * BINS_PER_OCTAVE).cast("int")


def last_bin(ranked: DataFrame, n: int) -> int | None:
    """The first bin up to which there are ``n`` rows; None where all rows together are fewer.

    The counts per bin are a sketch that map tasks build and merge exactly.
    """
    sizes = ranked.groupBy(rank_bin(F.col("_rank")).alias("bin")).agg(F.count(F.lit(1)).alias("rows")).orderBy("bin").collect()
    before = 0
    for size in sizes:
        before += size["rows"]
        if before >= n:
            return size["bin"]
    return None


def smallest(df: DataFrame, rank: Column, ties: Sequence[str], n: int) -> DataFrame:
    """Exactly the ``n`` rows with the smallest ``rank`` (none of which is negative); all rows where there are fewer.

    One pass counts ranks by bin, a second one keeps the rows up to the bin of the
    last row drawn, ``n`` and about 1% more (rows whose ranks are equal share a bin),
    and only those are written and sorted, by range.  ``limit`` after a sort would send all ``n`` rows through one task.
    """
    if n <= 0:
        return df.limit(0)
    ranked = df.withColumn("_rank", rank)
    last = last_bin(ranked, n)
    if last is None:
        return df
    near = measured(ranked.filter(rank_bin(F.col("_rank")) <= last))
    indexed = ranged_index(near, [F.col("_rank"), *[F.col(t) for t in ties]])
    return indexed.filter(F.col("index") < n).drop("index", "_rank")


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows, uniformly and without replacement."""
    return smallest(df, hashed_uniform(*keys, seed=seed), keys, n)


def sample_weighted(df: DataFrame, n: int, weight: Column, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, drawn in proportion to ``weight``.

    Exponential keys (Efraimidis and Spirakis): the smallest ``-ln(u) / w`` win.
    Rows of weight 0 are never drawn.
    """
    u = hashed_uniform(*keys, seed=seed) + F.lit(2.0**-33)
    drawable = df.withColumn("_w", weight).filter(F.col("_w") > 0)
    return smallest(drawable, -F.ln(u) / F.col("_w"), keys, n).drop("_w")


def sample_stratified(df: DataFrame, stratum: str, per_stratum: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """About ``per_stratum`` rows of every distinct value of ``stratum``.

    A Bernoulli draw at the rate ``per_stratum / rows`` of the stratum, so a hot
    stratum is thinned where it lies.
    """
    sizes = measured(df.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n")))
    joined = df.join(sizes, stratum)
    return joined.filter(hashed_uniform(*keys, seed=seed) < F.lit(float(per_stratum)) / F.col("_n")).drop("_n")


def sample_with_replacement(df: DataFrame, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """As many rows as ``df`` has on average, drawn with replacement.

    Each row is repeated a Poisson(1) number of times, drawn from its key: the
    limit of drawing as many rows as there are, without counting or moving any.
    """
    draw = F.array(hashed_uniform(*keys, seed=seed))
    # the draw is bound by the lambda: Spark would put the digest into each of the comparisons
    times = F.get(F.transform(draw, lambda u: hashed_poisson(u)), F.lit(0))
    return df.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")
