"""Per-series windows: lags, rolling means, ages, growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.numeric import ratio

# Lags and rolling windows of the feature table, and of the growth rate.
LAGS = (7, 28)
ROLLING = (7, 28)
GROWTH_LAG = 28
GROWTH_DAYS = 365


def lag_columns(keys: Sequence[str], order: str, value: str, lags: Sequence[int] = LAGS) -> dict[str, Column]:
    """Values ``k`` rows earlier in the series (rows, not calendar days)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return {f"lag_{k}": F.lag(value, k).over(w) for k in lags}


def rolling_columns(
    keys: Sequence[str], order: str, value: str, lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING
) -> dict[str, Column]:
    """Means of ``n`` lagged values, NULL unless all ``n`` are known.

    The frame is placed on the unlagged value, so lags and means of all sizes
    are frames over one sorted partitioning: one exchange, one sort, no second
    pass over the lag columns.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    out = {}
    for n in windows:
        for k in lags:
            frame = w.rowsBetween(-(k + n - 1), -k)
            full = F.count(value).over(frame) == n
            out[f"rmean_{k}_{n}"] = F.when(full, F.avg(value).over(frame))
    return out


def with_rolling_means(
    df: DataFrame, keys: Sequence[str], order: str, value: str, lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING
) -> DataFrame:
    """``df`` with the columns of :func:`rolling_columns`, by differences of one running sum.

    A frame of ``n`` rows is evaluated anew for every row; a running sum and a
    running count are carried from row to row, and the sum over any frame is the
    difference of two of their lags.  So the cost does not depend on the number
    or the length of the windows.  Both steps use the partitioning and the order
    of the first, without a second exchange or sort.

    Whole numbers (or decimals) add up exactly, so the means equal those of the
    frames to the last bit; for other numbers the difference is within the
    rounding of the series' running total.
    """
    taken = {c.lower() for c in df.columns}
    total, known = (next(n for n in (c, "_" + c, "__" + c) if n not in taken) for c in ("_total", "_known"))
    w = Window.partitionBy(*keys).orderBy(order)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = df.withColumns({
        total: F.coalesce(F.sum(value).over(so_far), F.lit(0)), known: F.count(value).over(so_far),
    })

    def between(column: str, k: int, n: int) -> Column:
        """What the column gained over the ``n`` rows that end ``k`` rows before."""
        return F.lag(column, k).over(w) - F.coalesce(F.lag(column, k + n).over(w), F.lit(0))

    means = {
        f"rmean_{k}_{n}": F.when(between(known, k, n) == n, between(total, k, n) / n) for n in windows for k in lags
    }
    return running.select("*", *[c.alias(name) for name, c in means.items()]).drop(total, known)


def series_features(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "d",
    value: str = "sales",
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING,
) -> DataFrame:
    """Lags and rolling means as further columns."""
    lagged = df.select("*", *[c.alias(name) for name, c in lag_columns(keys, order, value, lags).items()])
    return with_rolling_means(lagged, keys, order, value, lags, windows)


def look_back(lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING) -> int:
    """Rows of history that the features of one row depend on."""
    return max(lags) + max(windows) - 1


def growth_rates(
    dept_days: DataFrame, train_last: int, keys: Sequence[str] = ("dept_id", "store_id"),
    lag: int = GROWTH_LAG, days: int = GROWTH_DAYS,
) -> DataFrame:
    """1 + mean relative change over ``lag`` days, per group, from dense daily totals.

    Changes of -100 % and of +100 % or more are left out, as are those from 0.
    """
    w = Window.partitionBy(*keys).orderBy("d")
    earlier = F.lag("sales", lag).over(w)
    changes = dept_days.select(*keys, "d", ratio(F.col("sales") - earlier, earlier).alias("change"))
    recent = changes.filter((F.col("d") > train_last - days) & (F.abs("change") < 1))
    return recent.groupBy(*keys).agg((F.avg("change") + 1).alias("rate"))


def age(key: str, order: str) -> Column:
    """1 on the first row of a series, 2 on the next."""
    return F.row_number().over(Window.partitionBy(key).orderBy(order))


def last_days(df: DataFrame, n: int, day: str = "d") -> DataFrame:
    """Rows of the last ``n`` days; the last day is a scalar subquery, not a join."""
    return df.filter(F.col(day) > df.agg(F.max(day)).scalar() - n)


def recency_weight(df: DataFrame, day: str = "d", scale: str = "max") -> Column:
    """``d / max(d)`` or ``d / sum(d)``."""
    total = {"max": F.max(day), "sum": F.sum(day)}[scale]
    return F.col(day) / df.agg(total).scalar()


def amplitude_weight(df: DataFrame, value: str = "sales") -> Column:
    """Share of the grand total, as a sampling probability."""
    return F.col(value) / df.agg(F.sum(value)).scalar()
