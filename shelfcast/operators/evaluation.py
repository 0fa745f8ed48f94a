"""Scaled errors, revenue weights and the weighted score over the hierarchy.

Sales are long and may be sparse: a day without a row counts as zero sales.
Nothing here fills those days in, since the scale of a series follows from its
non-zero days alone.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.numeric import MODULUS, drawn_poisson, hashed_poisson, hashed_uniform, mixed_draw, ratio
from shelfcast.operators.hierarchy import rollup_parts


def naive_scale(
    sales: DataFrame, keys: Sequence[str], train_last: int | Column, trim: bool = True, first_day: int | None = None
) -> DataFrame:
    """Mean squared day-to-day change of each series up to ``train_last``.

    With ``trim`` the series starts at its first non-zero day, else at
    ``first_day``.  Between two non-zero days that are not adjacent the series
    falls to zero and rises again, which adds both squares; after the last one
    it falls to zero.  A series of at most one day, or without change, has no
    scale (NULL).
    """
    end = train_last if isinstance(train_last, Column) else F.lit(train_last)
    w = Window.partitionBy(*keys).orderBy("d")
    day, value = F.col("d"), F.col("sales")
    before, last = F.lag("sales").over(w), F.lead("d").over(w).isNull()
    rise = F.when(before.isNull(), F.lit(0.0) if trim else F.when(day > first_day, value * value).otherwise(0.0))
    rise = rise.when(F.lag("d").over(w) == day - 1, (value - before) * (value - before))
    rise = rise.otherwise(value * value + before * before)
    fall = F.when(last & (day < end), value * value).otherwise(0.0)
    steps = sales.filter((day <= end) & (value != 0)).select(*keys, "d", (rise + fall).alias("_sq"))
    start = F.min("d") if trim else F.lit(first_day)
    # a constant series has scale 0, which can score nothing
    return steps.groupBy(*keys).agg(
        F.nullif(ratio(F.sum("_sq"), (end - start).cast("double")), F.lit(0.0)).alias("scale")
    )


def rmsse(errors: DataFrame, scale: DataFrame, keys: Sequence[str], by: Sequence[str] = (), steps: int = 28) -> DataFrame:
    """Root mean squared scaled error per series; NULL without a scale.

    ``errors`` has an ``error`` per day of the horizon; absent days had none.
    """
    mse = errors.groupBy(*keys, *by).agg((F.sum(F.col("error") * F.col("error")) / F.lit(steps)).alias("mse"))
    joined = mse.join(scale, list(keys), "left")
    return joined.select(*keys, *by, "mse", "scale", F.sqrt(ratio(F.col("mse"), F.col("scale"))).alias("rmsse"))


def revenue(sales: DataFrame, prices: DataFrame, train_last: int, days: int = 28) -> DataFrame:
    """Revenue of each item and store over the last ``days`` training days.

    ``sales`` carries ``wm_yr_wk``; days without a price earn nothing.
    """
    recent = sales.filter(F.col("d").between(train_last - days + 1, train_last))
    priced = recent.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")
    keys = ["item_id", "store_id", "dept_id", "cat_id", "state_id"]
    return priced.groupBy(*keys).agg(F.sum(F.col("sales") * F.col("sell_price")).alias("revenue"))


def revenue_weights(revenues: DataFrame) -> DataFrame:
    """Share of revenue of each series within its level."""
    return reduce(DataFrame.unionByName, [part.select("level", "key", "weight") for part in _weight_parts(revenues)])


def _weight_parts(revenues: DataFrame) -> list[DataFrame]:
    # a level total equals the grand total, so one scalar normalises them all
    grand = revenues.agg(F.sum("revenue")).scalar()
    return [
        part.select(*keys, ratio(F.col("revenue"), grand).alias("weight"))
        for keys, part in rollup_parts(revenues, ["revenue"], [])
    ]


def _dealt(df: DataFrame, tasks: int | None) -> DataFrame:
    return df if tasks is None else df.repartition(tasks, "item_id")


def weighted_scores(
    train: DataFrame,
    errors: DataFrame,
    revenues: DataFrame,
    train_last: int,
    by: Sequence[str] = (),
    steps: int = 28,
    compat: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Score of each level (and each ``by`` value, such as a model).

    ``errors`` are item-level truth minus forecast per day ``h``; errors add up
    over the hierarchy, so one roll-up of them replaces one of the truth and
    one of every forecast.  ``tasks`` deals history and errors by item, over
    that many tasks: the sums, sorts and windows of the item levels stay there.  Series without a scale are left out; with
    ``compat`` they add their bare weight, as a product that skips missing
    factors would.
    """
    # most items miss by nothing on most days; the first day keeps every series in
    missed = errors.filter((F.col("error") != 0) | (F.col("h") == 1))
    train, missed = _dealt(train, tasks), _dealt(missed, tasks)
    level_errors = rollup_parts(missed, ["error"], [*by, "h"])
    scored = reduce(DataFrame.unionByName, [
        rmsse(missed, naive_scale(days, keys, train_last), keys, by, steps).join(weights, keys).select("level", *by, "weight", "rmsse")
        for (keys, days), (_, missed), weights in zip(rollup_parts(train), level_errors, _weight_parts(revenues))
    ])
    score = F.coalesce("rmsse", F.lit(1.0)) if compat else F.col("rmsse")
    return scored.groupBy(*by, "level").agg(F.sum(F.col("weight") * score).alias("score"))


def blended_scores(
    train: DataFrame,
    errors: DataFrame,
    models: Sequence[str],
    candidates: Mapping[str, Mapping[str, float]],
    revenues: DataFrame,
    train_last: int,
    steps: int = 28,
    tasks: int | None = None,
) -> DataFrame:
    """Score ``(model, level, score)`` of every candidate blend of ``models``, whose weights add up to 1.

    ``errors`` has one error column per model.  The error of a blend is the same
    blend of errors, so its mean square is a quadratic form in the sums of
    products of the models' level errors: one roll-up of the model columns
    serves any number of candidates, and item rows are never repeated.  ``tasks``
    is that of :func:`weighted_scores`.
    """
    missed = errors.filter(reduce(operator.or_, [F.col(m) != 0 for m in models], F.col("h") == 1))
    train, missed = _dealt(train, tasks), _dealt(missed, tasks)
    pairs = [(a, b) for i, a in enumerate(models) for b in models[i:]]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}*{b}") for a, b in pairs]
    weighted = reduce(DataFrame.unionByName, [
        rolled.groupBy(*keys).agg(*products).join(naive_scale(days, keys, train_last), keys).join(weights, keys)
        .select("level", "weight", "scale", *[f"`{a}*{b}`" for a, b in pairs])
        for (keys, days), (_, rolled), weights in zip(
            rollup_parts(train), rollup_parts(missed, list(models), ["h"]), _weight_parts(revenues))
    ])

    def score(weights: Mapping[str, float]) -> Column:
        terms = [
            F.col(f"`{a}*{b}`") * F.lit((1.0 if a == b else 2.0) * weights.get(a, 0.0) * weights.get(b, 0.0)) for a, b in pairs
        ]
        return F.sum(F.col("weight") * F.sqrt(F.greatest(reduce(operator.add, terms), F.lit(0.0)) / steps / F.col("scale")))

    # one column per candidate: what is aggregated stays one row per series
    names = list(candidates)
    wide = weighted.groupBy("level").agg(*[score(candidates[n]).alias(n) for n in names])
    return wide.unpivot(["level"], names, "model", "score")


def overall_score(level_scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return level_scores.groupBy(*by).agg(F.avg("score").alias("wrmsse"))


def rmse(df: DataFrame, actual: str, models: Sequence[str]) -> DataFrame:
    """Root mean squared error of each model, one row per model."""
    wide = df.agg(*[F.sqrt(F.avg(F.pow(F.col(actual) - F.col(m), F.lit(2.0)))).alias(m) for m in models])
    return wide.unpivot([], list(models), "model", "rmse")


def residual_histogram(residuals: DataFrame, low: float, high: float, bins: int, by: Sequence[str] = ("model",)) -> DataFrame:
    """Counts per equal-width bin; bin 0 and ``bins + 1`` hold the values outside the range."""
    binned = residuals.withColumn("bin", F.width_bucket("residual", F.lit(low), F.lit(high), F.lit(bins)))
    return binned.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("residual").alias("total"))


def bootstrap_means(
    residuals: DataFrame, row_key: Sequence[str], replicates: int, by: Sequence[str] = ("model",), seed: int = 0
) -> DataFrame:
    """Mean residual in each of ``replicates`` Poisson bootstrap samples.

    Each row draws its own multiplicity per replicate, so no sample is ever
    gathered; equal residuals are not merged because they draw separately.  The
    copies are summed map-side, and only one row per task and replicate is
    shuffled.
    """
    copies = residuals.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    n = hashed_poisson(hashed_uniform(*row_key, F.col("rep"), seed=seed))
    weighted = copies.select(*by, "rep", n.cast("double").alias("_n"), "residual")
    return weighted.groupBy(*by, "rep").agg(
        ratio(F.sum(F.col("_n") * F.col("residual")), F.sum("_n")).alias("mean_residual")
    )


# Blocks of a bootstrap: its spread is that of the rows' own draws within about 1 / sqrt(2 * BOOTSTRAP_BLOCKS).
BOOTSTRAP_BLOCKS = 4096


def bootstrap_block_means(
    residuals: DataFrame, row_key: Sequence[str], replicates: int, by: Sequence[str] = ("model",), seed: int = 0,
    blocks: int = BOOTSTRAP_BLOCKS,
) -> DataFrame:
    """Mean residual in each of ``replicates`` Poisson bootstrap samples of blocks of rows.

    The rows are dealt to blocks by a hash of their key, once, and only number
    and sum of each block are kept; a replicate draws how often it takes each
    block.  So the work is one pass over the rows, and blocks times replicates
    after it, whatever the number of rows; what a replicate takes is summed map-side.
    """
    by = list(by)
    cell = F.pmod(F.floor(hashed_uniform(*row_key, seed=seed) * 2.0**32).cast("long"), F.lit(blocks))
    sums = residuals.groupBy(*by, cell.alias("_block")).agg(F.count("residual").alias("_n"), F.sum("residual").alias("_s"))
    # a stated number of partitions: the few rows would otherwise be drawn for in one task
    spread = sums.repartition(max(2, residuals.sparkSession.sparkContext.defaultParallelism), *by, "_block")
    drawn = spread.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))).withColumn(
        "_draw", mixed_draw(F.col("_block"), F.col("rep"), seed))
    # what is taken zero times adds nothing
    taken = drawn.filter(F.col("_draw") >= F.lit(math.ceil(math.exp(-1.0) * MODULUS))).withColumn("_w", drawn_poisson(F.col("_draw")))
    return taken.groupBy(*by, "rep").agg(
        ratio(F.sum(F.col("_w") * F.col("_s")), F.sum(F.col("_w") * F.col("_n"))).alias("mean_residual"))


def bootstrap_summary(means: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return means.groupBy(*by).agg(
        F.avg("mean_residual").alias("mean"), F.stddev_pop("mean_residual").alias("std")
    )
