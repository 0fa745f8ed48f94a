"""Sums over the twelve levels of the product and location hierarchy."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The levels, by name, with the attributes that key them.
LEVELS = {
    "all": [],
    "cat": ["cat_id"],
    "state": ["state_id"],
    "dept": ["dept_id"],
    "store": ["store_id"],
    "item": ["item_id"],
    "state_cat": ["state_id", "cat_id"],
    "state_dept": ["state_id", "dept_id"],
    "store_cat": ["store_id", "cat_id"],
    "store_dept": ["store_id", "dept_id"],
    "item_state": ["item_id", "state_id"],
    "item_store": ["item_id", "store_id"],
}
COARSE = ["all", "cat", "state", "dept", "store", "state_cat", "state_dept", "store_cat", "store_dept"]
COARSE_COLUMNS = ["state_id", "store_id", "cat_id", "dept_id"]
ITEM_LEVELS = ["item_store", "item_state", "item"]


def level_key(level: str) -> Column:
    """One text key per level, such as ``<store>/<dept>``."""
    columns = LEVELS[level]
    return F.concat_ws("/", *columns) if columns else F.lit("")


def _grouping_sets(
    df: DataFrame, levels: Sequence[str], columns: Sequence[str], extra: Sequence[str], values: Sequence[str]
) -> DataFrame:
    sets = [[F.col(c) for c in [*LEVELS[level], *extra]] for level in levels]
    # grouping_id has one bit per grouping column, set where the column is summed over
    bits = {
        level: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in LEVELS[level])
        for level in levels
    }
    summed = df.groupingSets(sets, *[F.col(c) for c in columns], *[F.col(c) for c in extra]).agg(
        F.grouping_id().alias("_gid"), *[F.sum(v).alias(v) for v in values]
    )
    gid = F.shiftright(F.col("_gid"), len(extra))
    level = reduce(lambda acc, n: acc.when(gid == bits[n], F.lit(n)), levels[1:], F.when(gid == bits[levels[0]], F.lit(levels[0])))
    return summed.select(level.alias("level"), F.concat_ws("/", *_key_parts(columns)).alias("key"), *extra, *values)


def _key_parts(columns: Sequence[str]) -> list[Column]:
    # attributes summed over are NULL and left out by concat_ws
    return [F.col(c) for c in columns]


def rollup_parts(
    df: DataFrame, values: Sequence[str] = ("sales",), extra: Sequence[str] = ("d",)
) -> list[tuple[list[str], DataFrame]]:
    """The twelve levels as ``(keys, rows)``: a part for each of the three item levels, and one for all others.

    The rows of an item level have ``item_id`` among their keys and are sums by
    item: where ``df`` is dealt by item, its sums, windows and joins need no
    exchange.  The other part is keyed by ``level, key``: nine levels as grouping
    sets over store x department totals, which are tiny next to the item rows,
    and the rows without an item.
    """
    extra, values = list(extra), list(values)
    sums = [F.sum(v).alias(v) for v in values]
    finest = df.groupBy("item_id", "store_id", "dept_id", "cat_id", "state_id", *extra).agg(*sums)
    parts, rest = [], [_grouping_sets(finest.groupBy(*COARSE_COLUMNS, *extra).agg(*sums), COARSE, COARSE_COLUMNS, extra, values)]
    for level in ITEM_LEVELS:
        summed = finest if level == "item_store" else finest.groupBy(*LEVELS[level], *extra).agg(*sums)
        rows = summed.select(F.lit(level).alias("level"), "item_id", level_key(level).alias("key"), *extra, *values)
        parts.append((["level", "item_id", "key"], rows.filter(F.col("item_id").isNotNull())))
        rest.append(rows.filter(F.col("item_id").isNull()).drop("item_id"))
    return [*parts, (["level", "key"], reduce(DataFrame.unionByName, rest))]


def rollup_levels(
    df: DataFrame, values: Sequence[str] = ("sales",), extra: Sequence[str] = ("d",)
) -> DataFrame:
    """``(level, key, extra, values)`` for all twelve levels, the parts above in one table."""
    parts = [rows.select("level", "key", *extra, *values) for _, rows in rollup_parts(df, values, extra)]
    return reduce(DataFrame.unionByName, parts)
