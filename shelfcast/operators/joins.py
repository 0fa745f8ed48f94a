"""Joins of the sales grid.

All are equi-joins on explicit keys.  Nothing is broadcast by hint: Spark
broadcasts a side whose size is below its own threshold and shuffles otherwise,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.numeric import hashed_uniform
from shelfcast.session import measured


def with_calendar(grid: DataFrame, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Calendar columns by day; days beyond the calendar drop out of an inner join."""
    return grid.join(calendar, "d", how)


def with_prices(grid: DataFrame, prices: DataFrame) -> DataFrame:
    """Weekly prices; days in weeks without a price drop out."""
    return grid.join(prices, ["store_id", "item_id", "wm_yr_wk"])


def with_prices_left(grid: DataFrame, prices: DataFrame) -> DataFrame:
    """The same rows by a left join and a filter."""
    joined = grid.join(prices, ["store_id", "item_id", "wm_yr_wk"], "left")
    return joined.na.drop(subset=["sell_price"])


def with_price_history(grid: DataFrame, prices: DataFrame, key: str = "id") -> DataFrame:
    """The rows of :func:`with_prices`, for a grid that is partitioned by series.

    ``prices`` carries ``key``.  Each series' prices become one map from week to
    price (as many entries as weeks), joined once per series.  The daily rows
    stay where they are, so windows over the series need no further shuffle.
    """
    history = prices.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("wm_yr_wk", "sell_price"))).alias("_prices")
    )
    priced = grid.join(history, key).withColumn("sell_price", F.try_element_at("_prices", F.col("wm_yr_wk")))
    return priced.filter(F.col("sell_price").isNotNull()).drop("_prices")


def with_rate(grid: DataFrame, rates: DataFrame) -> DataFrame:
    """Growth rate of the row's department and store."""
    return grid.join(measured(rates), ["dept_id", "store_id"], "left")


def join_models(forecasts: dict[str, DataFrame], keys: Sequence[str] = ("id", "h")) -> DataFrame:
    """Outputs ``(keys, yhat)`` of several models side by side, where all of them have a row.

    One union and one aggregate: a single shuffle for any number of models,
    instead of one per join.
    """
    names = list(forecasts)
    tagged = [df.select(*keys, F.lit(name).alias("_model"), "yhat") for name, df in forecasts.items()]
    wide = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(
        *[F.max(F.when(F.col("_model") == name, F.col("yhat"))).alias(name) for name in names],
        F.bit_or(_bit(names)).alias("_models"),
    )
    return wide.filter(F.col("_models") == 2 ** len(names) - 1).drop("_models")


def _bit(names: Sequence[str]):
    bit = F.lit(0)
    for i, name in enumerate(names):
        bit = F.when(F.col("_model") == name, F.lit(1 << i)).otherwise(bit)
    return bit


def update_join(base: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Take ``new`` where it has a value and keep ``base`` elsewhere."""
    fresh = new.select(*keys, F.col(value).alias("_new"))
    merged = base.join(fresh, list(keys), "left")
    return merged.withColumn(value, F.coalesce("_new", value)).drop("_new")


def hashed_holdout(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    return df.filter(hashed_uniform(*keys, seed=seed) < fraction)


def without(df: DataFrame, holdout: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``holdout``."""
    return df.join(holdout.select(*keys), list(keys), "left_anti")
