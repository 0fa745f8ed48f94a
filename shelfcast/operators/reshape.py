"""Wide and long layouts, gap filling and future rows.

Everything inside the library is long; wide layouts exist at file edges only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def melt_days(wide: DataFrame, keys: Sequence[str], prefix: str = "d_", value: str = "sales") -> DataFrame:
    """One row per key and day column; the day becomes an integer.

    The day columns become one array that is exploded by position.  With
    thousands of columns this is ten times faster than ``unpivot``, which plans
    one projection per column.
    """
    days = [c for c in wide.columns if c.startswith(prefix)]
    numbers = F.expr(f"array({', '.join(str(int(c[len(prefix):])) for c in days)})")
    cells = F.expr(f"array({', '.join(days)})")  # one call for all columns
    long = wide.select(*keys, F.posexplode(cells).alias("_pos", value))
    return long.select(*keys, numbers[F.col("_pos")].alias("d"), value)


def spread_days(long: DataFrame, keys: Sequence[str], first: int, last: int, value: str = "sales") -> DataFrame:
    """One ``d_<k>`` column per day; days without a row are 0."""
    days = range(first, last + 1)
    wide = long.groupBy(*keys).pivot("d", list(days)).agg(F.sum(value))
    # two calls for all columns: building thousands of expressions one by one takes longer than the job
    return wide.na.fill(0.0, subset=[str(k) for k in days]).toDF(*keys, *[f"d_{k}" for k in days])


def wide_lines(sparse: DataFrame, keys: Sequence[str], last: int, value: str = "sales") -> DataFrame:
    """Lines of a file with one column per day, from sparse rows; days without a row are 0.

    One expression over an array of days, where thousands of pivoted columns
    would take longer to plan than to run.
    """
    rows = sparse.groupBy(*keys).agg(F.collect_list(F.struct("d", value)).alias("_days"))

    def at(day: Column) -> Column:
        return F.coalesce(F.get(F.filter("_days", lambda s: s["d"] == day), F.lit(0))[value], F.lit(0.0))

    cells = F.transform(F.sequence(F.lit(1), F.lit(last)), lambda day: at(day).cast("string"))
    return rows.select(F.concat_ws(",", *keys, F.array_join(cells, ",")).alias("value"))


def melt_steps(wide: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """A forecast file with ``F1..`` columns to rows ``(keys, h, value)``."""
    steps = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(list(keys), steps, "_step", value)
    return long.select(*keys, F.substring("_step", 2, 10).cast("int").alias("h"), value)


def pivot_steps(long: DataFrame, keys: Sequence[str], value: str, step: str = "h", steps: int = 28) -> DataFrame:
    """Rows ``(keys, h, value)`` to columns ``F1..``; repeated cells are averaged.

    One aggregate by ``keys`` with a mean per column: rows that are dealt by a key
    stay where they are, and what is kept of a key is one row, not its cells.
    """
    means = [F.avg(F.when(F.col(step) == i, F.col(value))).alias(f"F{i}") for i in range(1, steps + 1)]
    return long.groupBy(*keys).agg(*means)


def fill_days(
    sparse: DataFrame,
    key: str | Sequence[str],
    first: int | Column,
    last: int | Column,
    value: str = "sales",
    day: str = "d",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Every day from ``first`` to ``last`` of each key, 0 where there was no row.

    Only the sparse rows are shuffled.  Each row then emits the empty days
    before it (and after it, for the last row of a key), so no table of all
    keys and days is built, shuffled and joined, and windows over the same key
    reuse the partitioning.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first, last = (x if isinstance(x, Column) else F.lit(x) for x in (first, last))
    w = Window.partitionBy(*keys).orderBy(day)
    start = F.coalesce(F.lag(day).over(w) + 1, first)
    stop = F.when(F.lead(day).over(w).isNull(), F.greatest(last, F.col(day))).otherwise(F.col(day))
    spans = sparse.select(*keys, *carry, F.col(day).alias("_d"), value, start.alias("_from"), stop.alias("_to"))
    filled = spans.withColumn(day, F.explode(F.sequence("_from", "_to")))
    return filled.select(
        *keys, *carry, day, F.when(F.col(day) == F.col("_d"), F.col(value)).otherwise(F.lit(0.0)).alias(value)
    )


def future_rows(keys: DataFrame, train_last: int, days: int = 56, value: str = "sales") -> DataFrame:
    """The ``days`` days after the history of each key, with no value yet."""
    return keys.select(
        "*",
        F.explode(F.sequence(F.lit(train_last + 1), F.lit(train_last + days))).alias("d"),
        F.lit(None).cast("double").alias(value),
    )


def horizon_label(day: str, train_last: int) -> Column:
    """``F1`` for the first forecast day.  Counting days instead of rows needs no window."""
    return F.concat(F.lit("F"), F.col(day) - F.lit(train_last))


def dual_label(df: DataFrame, id_col: str, old: str, new: str) -> DataFrame:
    """Every row under its own label and again under the other one, in one pass over ``df``."""
    from shelfcast.functions.text import relabel

    both = F.explode(F.array(F.col(id_col), relabel(id_col, old, new)))
    return df.withColumn(id_col, both)


def item_matrix(
    df: DataFrame, row_keys: Sequence[str], column: str, columns: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """One row per ``row_keys`` and one column per value and item; missing cells are 0.

    For models that need all items of a day side by side.  The item list is
    given, and the pivot aggregates map-side, so no group is gathered whole.
    """
    wide = df.groupBy(*row_keys).pivot(column, list(columns)).agg(*[F.avg(v).alias(v) for v in values])
    cells = [
        F.coalesce(F.col(f"`{c}_{v}`" if len(values) > 1 else f"`{c}`"), F.lit(0.0)).alias(f"{v}_{i}")
        for v in values
        for i, c in enumerate(columns)
    ]
    return wide.select(*row_keys, *cells)


# Columns per block of a sparse row; bounds the list that one task gathers for one row.
BLOCK = 4096


def sparse_rows(
    df: DataFrame, row_keys: Sequence[str], column: str, dictionary: DataFrame, value: str, block: int = BLOCK
) -> DataFrame:
    """``row_keys, block, indices, values``: a matrix with one column per value of ``column``, as sparse rows.

    ``dictionary`` (``value, code``) gives the column numbers and is a table, so
    the columns are never listed in the plan or on the driver.  A row is cut into
    blocks of ``block`` columns, each with its non-zero cells in the order of the
    columns; blocks without any are absent.  Repeated cells are added up; cells whose
    column is not in the dictionary drop out.  With 0/1 values this is a one-hot row.
    """
    codes = dictionary.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    coded = df.join(codes, F.col(column).cast("string").eqNullSafe(F.col("_value")))
    cells = coded.groupBy(*row_keys, "_code").agg(F.sum(value).alias("_cell")).filter(F.col("_cell") != 0)
    listed = F.sort_array(F.collect_list(F.struct("_code", "_cell")))
    blocks = cells.groupBy(*row_keys, F.floor(F.col("_code") / block).cast("int").alias("block")).agg(listed.alias("_cells"))
    return blocks.select(
        *row_keys, "block", F.col("_cells._code").alias("indices"), F.col("_cells._cell").alias("values")
    )

