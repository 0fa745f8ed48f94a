"""Recursive multi-step forecasts.

A model whose smallest lag is seven rows can forecast seven days at once: no
day of the block is an input of another.  Twenty-eight steps are therefore four
rounds, each over the last few dozen rows of every series only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfcast.operators.topdown import renormalise
from shelfcast.operators.windows import LAGS, ROLLING, lag_columns, look_back, rolling_columns
from shelfcast.session import cut_lineage

Predictor = Callable[[DataFrame], DataFrame]


def last_rows(df: DataFrame, keys: Sequence[str], n: int, order: str = "d") -> DataFrame:
    """The last ``n`` rows of each series; Spark drops the others before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def recursive_forecast(
    grid: DataFrame,
    predict: Predictor,
    train_last: int,
    steps: int = 28,
    keys: Sequence[str] = ("id",),
    multiplier: str | None = "rate",
    share: bool = False,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING,
) -> DataFrame:
    """Forecast the horizon rows of ``grid``; returns them with ``sales`` filled in.

    ``predict`` adds a ``prediction`` column to rows with lag and rolling
    features; it may be any fitted model's ``transform`` or a mix of several.
    The forecast is the prediction times ``multiplier``, or, for a ``share``
    model, the prediction scaled to add up to 1 per store, department and day.
    Each round is checkpointed, so a lost executor does not replay the earlier
    ones.
    """
    keys = list(keys)
    series = [*keys, "d", "sales"]
    history = last_rows(grid.filter(F.col("d") <= train_last).select(*series), keys, look_back(lags, windows))
    future = cut_lineage(grid.filter(F.col("d").between(train_last + 1, train_last + steps)).drop("sales"))
    known = cut_lineage(history)
    block = min(lags)
    # forecasts are not whole numbers, and the history is short: frames keep the last bit that running sums lose
    features = {**lag_columns(keys, "d", "sales", lags), **rolling_columns(keys, "d", "sales", lags, windows)}
    for first in range(train_last + 1, train_last + steps + 1, block):
        in_block = F.col("d").between(first, min(first + block - 1, train_last + steps))
        rows = known.unionByName(future.filter(in_block), allowMissingColumns=True)
        predicted = predict(rows.select("*", *[c.alias(name) for name, c in features.items()]).filter(in_block))
        if share:
            predicted = renormalise(predicted.drop("sales").withColumnRenamed("prediction", "sales"), "sales")
        else:
            # a department without a growth rate is forecast without growth
            factor = F.lit(1.0) if multiplier is None else F.coalesce(F.col(multiplier), F.lit(1.0))
            predicted = predicted.withColumn("sales", factor * F.col("prediction"))
        known = cut_lineage(known.unionByName(predicted.select(*series)))
    forecast = known.filter(F.col("d") > train_last)
    return future.join(forecast, [*keys, "d"])


def with_multipliers(grid: DataFrame, alphas: Sequence[float]) -> DataFrame:
    """The grid once per multiplier, as a further series key ``alpha``."""
    return grid.withColumn("alpha", F.explode(F.array(*[F.lit(float(a)) for a in alphas])))


def average_runs(forecast: DataFrame, keys: Sequence[str] = ("id", "d")) -> DataFrame:
    """Mean over the runs of each day, added up in the order of their size so that reruns agree to the last bit."""
    values = F.array_sort(F.collect_list("sales"))
    return forecast.groupBy(*keys).agg(
        (F.aggregate(values, F.lit(0.0), lambda total, x: total + x) / F.size(values)).alias("sales")
    )


def seasonal_forecast(recent: DataFrame, rates: DataFrame, train_last: int, steps: int = 28, season: int = 7) -> DataFrame:
    """Last week times the growth rate per week ahead.

    This is the recursion ``y(t) = rate * y(t - 7)`` in closed form: each of the
    last seven days emits all the horizon days that repeat it.
    """
    last_week = recent.filter(F.col("d").between(train_last - season + 1, train_last))
    rated = last_week.join(rates, ["dept_id", "store_id"])
    weeks = F.sequence(F.lit(1), F.lit(-(-steps // season)))
    rows = rated.withColumn("_week", F.explode(weeks)).withColumn("h", F.col("d") - train_last + season * F.col("_week"))
    return rows.filter(F.col("h") <= steps).select(
        "store_id", "dept_id", "h", (F.pow("rate", F.col("_week").cast("double")) * F.col("sales")).alias("yhat")
    )
