"""Group totals, profiles and shares of a total."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.numeric import ratio
from shelfcast.session import measured


def totals(df: DataFrame, keys: Sequence[str], values: Sequence[str] = ("sales",)) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


def store_dept_series(grid: DataFrame) -> DataFrame:
    """Daily totals and regressors of each store and department."""
    return grid.groupBy("store_id", "dept_id", "d").agg(
        F.max("date").alias("ds"),
        F.sum("sales").alias("y"),
        F.max("snap").alias("snap"),
        F.max("sell_price").alias("price"),
        F.max(F.dayofmonth("date")).cast("tinyint").alias("dom"),
    )


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, long.

    (column, value) pairs are made distinct first, so the count is spread over
    values; a many-column distinct count would expand every row per column and
    finish in one task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    return distinct.groupBy("feature").agg(F.count("value").alias("n_distinct"))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])


def share_of_total(
    df: DataFrame, group: Sequence[str], value: str = "sales", name: str = "share", scale: float = 1.0,
    store_totals: bool = False,
) -> DataFrame:
    """``value`` over the total of its group; NULL where the total is 0.

    The totals are aggregated map-side and joined back.  A window total would
    gather each group in one task, which fails when one group holds much of the
    data; here a hot group only meets its one total row.  For few large groups
    ``store_totals`` writes the totals first, and their known size lets the
    planner broadcast them instead of shuffling the rows on a hot key.
    """
    total = df.groupBy(*group).agg(F.sum(value).alias("_total"))
    total = measured(total) if store_totals else total
    joined = df.join(total, list(group), "left")
    return joined.withColumn(name, ratio(F.col(value), F.col("_total")) * F.lit(scale)).drop("_total")


def target_means(df: DataFrame, column: str, target: str, smoothing: float = 0.0) -> DataFrame:
    """Mean target per category, shrunk to the overall mean by ``smoothing`` pseudo-rows."""
    overall = df.agg(F.avg(target)).scalar()
    stats = df.groupBy(column).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    encoded = (F.col("_s") + F.lit(smoothing) * overall) / (F.col("_n") + F.lit(smoothing))
    return stats.select(column, encoded.alias(f"{column}_mean"))


def out_of_fold_means(df: DataFrame, column: str, target: str, fold: Column, smoothing: float = 0.0) -> DataFrame:
    """``df`` with ``<column>_mean``: the mean target of the row's category over all other folds.

    No row's own target takes part in its mean, so a target without any relation
    to the category gives a column without signal.  Means are shrunk by
    ``smoothing`` pseudo-rows to the mean of all other folds, which is also what a
    category takes that occurs in one fold only.  Sums are kept per category and
    fold, added up map-side; leaving a fold out is a subtraction.
    """
    rows = df.withColumn("_fold", fold)
    cells = measured(rows.groupBy(column, "_fold").agg(F.sum(target).alias("_s"), F.count(target).alias("_n")))
    by_fold = cells.groupBy("_fold").agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    total = cells.agg(F.struct(F.sum("_s").alias("s"), F.sum("_n").alias("n"))).scalar()
    prior = by_fold.select("_fold", ratio(total["s"] - F.coalesce("_fs", F.lit(0.0)), total["n"] - F.col("_fn")).alias("_prior"))
    category = cells.groupBy(column).agg(F.sum("_s").alias("_cs"), F.sum("_n").alias("_cn"))
    left_out = cells.join(category.withColumnRenamed(column, "_category"), F.col(column).eqNullSafe(F.col("_category"))).select(
        "_category", F.col("_fold").alias("_of"),
        (F.coalesce("_cs", F.lit(0.0)) - F.coalesce("_s", F.lit(0.0))).alias("_s"), (F.col("_cn") - F.col("_n")).alias("_n"),
    )
    means = left_out.join(prior, F.col("_of") == F.col("_fold")).select(
        "_category", "_of",
        F.coalesce(ratio(F.col("_s") + F.lit(smoothing) * F.col("_prior"), F.col("_n") + F.lit(smoothing)), F.col("_prior"))
        .alias(f"{column}_mean"),
    )
    matched = F.col(column).eqNullSafe(F.col("_category")) & (F.col("_fold") == F.col("_of"))
    return rows.join(measured(means), matched, "left").drop("_category", "_of", "_fold")


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit (population) deviation; all moments come from one aggregate."""
    moments = df.agg(
        F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    ).scalar()
    scaled: Mapping[str, Column] = {
        c: ratio(F.col(c) - moments[f"m_{c}"], moments[f"s_{c}"]) for c in columns
    }
    return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])
