"""Recursive forecasts inside one partition, for models that are linear in their features.

A series needs its last few dozen rows only, and a step of a linear model is a
weighted sum, so all steps of many series are run in one task: one shuffle deals
the series, each becomes one row with its recent values and its horizon, and
numpy carries batches of them from step to step.  Nothing is stored between
steps.  A model that Spark has to apply (trees) needs the rounds of
:mod:`shelfcast.operators.recursion`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.operators.recursion import last_rows
from shelfcast.operators.windows import LAGS, ROLLING, look_back

# What a link's linear score stands for.
LINKS = {"identity": np.asarray, "log": np.exp}


@dataclass(frozen=True)
class LinearModel:
    """``link(intercept + sum of coefficient * feature)``.

    Features are ``lag_k``, ``rmean_k_n`` and columns of the horizon's rows; one
    that is not known counts as ``missing``.
    """

    coefficients: dict[str, float]
    intercept: float = 0.0
    link: str = "identity"
    missing: float = 0.0

    def __post_init__(self):
        if self.link not in LINKS:
            raise ValueError(f"unknown link {self.link!r}")

    def predict(self, feature) -> np.ndarray:
        """``feature`` gives the values of a name, NaN where they are not known."""
        total = self.intercept
        for name, weight in self.coefficients.items():
            values = feature(name)
            total = total + weight * np.where(np.isnan(values), self.missing, values)
        return LINKS[self.link](total)


def lagged(name: str) -> tuple[int, int] | None:
    """Lag and length of the window that a feature's name stands for; None for a column."""
    parts = name.split("_")
    if parts[0] == "lag" and len(parts) == 2:
        return int(parts[1]), 1
    if parts[0] == "rmean" and len(parts) == 3:
        return int(parts[1]), int(parts[2])
    return None


def run_steps(values: np.ndarray, steps: int, model: LinearModel, inputs: dict[str, np.ndarray], factor: np.ndarray) -> np.ndarray:
    """Fill the last ``steps`` columns of ``values`` (a row per series, NaN where nothing is known) and return them."""
    first = values.shape[1] - steps
    for step in range(steps):
        at = first + step

        def feature(name: str) -> np.ndarray:
            window = lagged(name)
            if window is None:
                return inputs[name][:, step]
            lag, n = window
            # added up in the order of the days, as a frame does; with an unknown value the mean is unknown
            return reduce(np.add, (values[:, k] for k in range(at - lag - n + 1, at - lag + 1))) / n

        values[:, at] = factor[:, step] * model.predict(feature)
    return values[:, first:]


def recursive_forecast_in_partition(
    grid: DataFrame,
    model: LinearModel,
    train_last: int,
    steps: int = 28,
    keys: Sequence[str] = ("id",),
    multiplier: str | None = "rate",
    multipliers: Sequence[float] | None = None,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING,
) -> DataFrame:
    """``keys, d, sales`` of the horizon rows: what :func:`recursive_forecast` gives with the model as its predictor.

    ``multipliers`` runs the recursion once for each of them instead of the
    ``multiplier`` column, and adds the one used as ``alpha``; the history is
    neither copied nor read again.
    """
    keys, depth = list(keys), look_back(lags, windows)
    used = [n for n in model.coefficients if lagged(n) is None]
    deepest = max([k + n - 1 for k, n in filter(None, map(lagged, model.coefficients))], default=0)
    if deepest > depth:
        raise ValueError(f"the model looks back {deepest} rows, the lags and windows {depth}")
    columns = [*used, *([multiplier] if multiplier and multipliers is None else [])]
    row = F.struct("d", F.col("sales").cast("double").alias("sales"), *[F.col(c).cast("double").alias(f"x{k}") for k, c in enumerate(columns)])
    recent = last_rows(grid.filter(F.col("d") <= train_last + steps).select(*keys, "d", "sales", *columns), keys, depth + steps)
    series = recent.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    fields = [f for f in grid.select(*keys).schema] + [T.StructField("d", grid.schema["d"].dataType), T.StructField("sales", T.DoubleType())]
    if multipliers is not None:
        fields.append(T.StructField("alpha", T.DoubleType()))
    schema = T.StructType(fields)

    def forecast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keys))
            ends, flat = lists.offsets.to_numpy(), lists.values
            flat_of = lambda name: flat.field(name).to_numpy(zero_copy_only=False).astype(float)
            days, sales = flat.field("d").to_numpy(zero_copy_only=False), flat_of("sales")
            own = np.repeat(np.arange(len(lists)), np.diff(ends))
            days, sales = days[ends[0]:ends[-1]], sales[ends[0]:ends[-1]]
            ahead = days > train_last
            history = np.bincount(own[~ahead], minlength=len(lists))
            # history ends, and the horizon begins, at one column for all series
            place = np.arange(len(days)) - (ends[:-1] - ends[0])[own] - history[own] + depth
            inside = place >= 0
            table = np.full((len(lists), depth + steps), np.nan)
            known = inside & ~ahead
            table[own[known], place[known]] = sales[known]
            inputs = {}
            for k, c in enumerate(columns):
                inputs[c] = np.full((len(lists), steps), np.nan)
                inputs[c][own[ahead], place[ahead] - depth] = flat_of(f"x{k}")[ends[0]:ends[-1]][ahead]
            for alpha in multipliers if multipliers is not None else [None]:
                factor = np.ones((len(lists), steps))
                if alpha is not None:
                    factor *= alpha
                elif multiplier:
                    # a series without a growth rate is forecast without growth
                    factor = np.where(np.isnan(inputs[multiplier]), 1.0, inputs[multiplier])
                filled = run_steps(table.copy(), steps, model, inputs, factor)
                out = [batch.column(k).take(pa.array(own[ahead])) for k in range(len(keys))]
                out += [flat.field("d").slice(ends[0], len(days)).filter(pa.array(ahead)), pa.array(filled[own[ahead], place[ahead] - depth])]
                if alpha is not None:
                    out.append(pa.array(np.full(ahead.sum(), alpha)))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return series.select(*keys, "rows").mapInArrow(forecast, schema)
