"""A regression per series whose trend changes at few days: sparse changes, holiday windows, intervals.

Of the possible trend changes most should be none at all.  Their prior is a
Laplace law, so the fit is a lasso in the changes and a ridge in all other
effects.  The other effects are eliminated from the Gram sums of the series
exactly, and the changes are found by coordinate descent on what remains (one
number per possible change), with the noise estimated in turn.  Level and slope
have no penalty: fitted and actual values have the same sum, and the same sum
weighted by day.

Spark deals the days of each series to one task (at most one row per day).
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from shelfcast.operators.seasonal import CHANGEPOINTS, DEFAULTS, design

# Level and slope, then the possible changes, come first among the columns of the regression.
FREE, CHANGES = slice(0, 2), slice(2, 2 + CHANGEPOINTS)
NOISE_ROUNDS = 4
DRAWS, COVERAGE = 400, 0.8


def holiday_windows(days: DataFrame, events: DataFrame, before: int = 1, after: int = 1) -> DataFrame:
    """``days`` with ``holidays``: the names of events (``d, event``) near the day, with the days since each.

    An event's day has ``name+0``; the day before it ``name-1``.
    """
    moved = events.filter(F.col("event").isNotNull()).withColumn("_off", F.explode(F.sequence(F.lit(-before), F.lit(after))))
    name = F.format_string("%s%+d", "event", "_off")
    near = moved.groupBy((F.col("d") + F.col("_off")).cast("int").alias("d")).agg(F.array_sort(F.collect_set(name)).alias("holidays"))
    return days.join(near, "d", "left")


def effects(days: pd.DataFrame, params: dict, trained: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the regression and their prior scales: level, slope, changes, seasons, regressors, holiday windows."""
    plain = days.assign(event=None)
    x, scales = design(plain, params, trained, target)
    near = [set(h) if h is not None else set() for h in days["holidays"]]
    # an effect that no trained day shows cannot be learned
    names = sorted(set().union(*(near[i] for i in np.flatnonzero(trained)))) if trained.any() else []
    held = np.array([[n in own for n in names] for own in near], dtype=float).reshape(len(days), len(names))
    return np.column_stack([x, held]), np.concatenate([scales, np.full(len(names), params["holidays_prior_scale"])])


def sparse_solution(gram: np.ndarray, moment: np.ndarray, penalty: float, sweeps: int = 4000) -> np.ndarray:
    """The least of ``d'Gd / 2 - m'd + penalty * sum |d|`` by coordinate descent.

    Every few sweeps the system of the changes that are not zero is solved at
    once; that is the answer as soon as signs and gradients agree with it.
    """
    d, slope = np.zeros(len(moment)), moment.copy()
    size = np.maximum(np.diag(gram), 1e-12)
    for sweep in range(sweeps):
        moved = 0.0
        for j in range(len(d)):
            if gram[j, j] <= 1e-12:
                continue
            pull = slope[j] + gram[j, j] * d[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / size[j]
            if new != d[j]:
                slope -= gram[:, j] * (new - d[j])
                moved = max(moved, abs(new - d[j]))
                d[j] = new
        if moved < 1e-12:
            break
        if sweep % 10 == 9:
            on = np.flatnonzero(d)
            sign = np.sign(d[on])
            try:
                exact = np.linalg.solve(gram[np.ix_(on, on)], moment[on] - penalty * sign)
            except np.linalg.LinAlgError:
                continue
            rest = moment - gram[:, on] @ exact
            if (np.sign(exact) == sign).all() and (np.abs(rest) <= penalty * (1 + 1e-9) + 1e-12).all():
                d[on] = exact
                break
    return d


def map_fit(x: np.ndarray, y: np.ndarray, scales: np.ndarray, change_scale: float, rounds: int = NOISE_ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and noise of the most probable regression; columns CHANGES have the Laplace prior, FREE ones none."""
    smooth = np.r_[np.arange(*FREE.indices(x.shape[1])), np.arange(CHANGES.stop, x.shape[1])]
    sparse = np.arange(*CHANGES.indices(x.shape[1]))
    gram, moment, total = x.T @ x, x.T @ y, float(y @ y)
    weights, noise = np.zeros(x.shape[1]), max(float(y.var()), 1e-12)
    for _ in range(rounds):
        ridge = noise / scales[smooth] ** 2
        ridge[:FREE.stop] = 0.0
        own = gram[np.ix_(smooth, smooth)] + np.diag(ridge)
        own[np.diag_indices_from(own)] += np.where(np.diag(own) <= 0, 1.0, 0.0)
        across = gram[np.ix_(smooth, sparse)]
        solved = np.linalg.lstsq(own, np.column_stack([across, moment[smooth]]), rcond=1e-13)[0]
        rest = gram[np.ix_(sparse, sparse)] - across.T @ solved[:, :-1]
        weights[sparse] = sparse_solution(rest, moment[sparse] - across.T @ solved[:, -1], noise / change_scale)
        weights[smooth] = solved[:, -1] - solved[:, :-1] @ weights[sparse]
        left = total - 2 * weights @ moment + weights @ gram @ weights
        noise = max(float(left) / len(y), 1e-12)
    return weights, float(np.sqrt(noise))


@dataclass
class TrendFit:
    """``fitted``, and bounds of the middle ``coverage`` of simulated futures, for all days; ``changes`` by day."""

    fitted: np.ndarray
    low: np.ndarray
    high: np.ndarray
    changes: list[tuple[float, float]]


def fit_trend(days: pd.DataFrame, params: dict, train_last: int, seed: int = 0, draws: int = DRAWS, coverage: float = COVERAGE) -> TrendFit:
    """Fit the days (sorted, one row each) up to ``train_last`` that have a target."""
    params = {**DEFAULTS, **params}
    every = days["y"].to_numpy(float)
    trained = ((days["d"] <= train_last) & days["y"].notna()).to_numpy()
    if not trained.any():
        none = np.full(len(days), np.nan)
        return TrendFit(none, none, none, [])
    unit = max(np.abs(every[trained]).max(), 1e-9)
    x, scales = effects(days, params, trained, np.where(trained, every, 0.0))
    weights, noise = map_fit(x[trained], every[trained] / unit, scales, params["changepoint_prior_scale"])
    fitted = x @ weights * unit
    t = days["d"].to_numpy(float)
    t0, t1 = t[trained].min(), t[trained].max()
    span = max(t1 - t0, 1.0)
    at = np.linspace(0, params["changepoint_range"], CHANGEPOINTS + 1)[1:]
    deltas = weights[CHANGES]
    low, high = bounds(fitted, (t - t1) / span, deltas, params["changepoint_range"], noise, unit, seed, draws, coverage)
    return TrendFit(fitted, low, high, [(t0 + a * span, d * unit / span) for a, d in zip(at, deltas) if d != 0])


def bounds(fitted, ahead, deltas, reach, noise, unit, seed, draws, coverage):
    """Quantiles of simulated futures: changes come as often, and are as large on average, as those that were found."""
    rng = np.random.default_rng(seed)
    future = ahead > 0
    paths = np.zeros((draws, len(fitted)))
    size = np.abs(deltas).mean()
    if future.any() and size > 0:
        length = ahead[future].max()
        for k, n in enumerate(rng.poisson(length * len(deltas) / reach, draws)):
            when, change = rng.uniform(0, length, n), rng.laplace(0, size, n)
            paths[k, future] = np.maximum(ahead[future][:, None] - when, 0.0) @ change
    paths += rng.normal(0, noise, paths.shape)
    tail = (1 - coverage) / 2
    spread = np.quantile(paths, [tail, 1 - tail], axis=0) * unit
    return fitted + np.minimum(spread[0], 0.0), fitted + np.maximum(spread[1], 0.0)


def trend_forecast(
    series: DataFrame, train_last: int, keys: Sequence[str] = ("store_id", "dept_id"), params: dict | None = None
) -> DataFrame:
    """``keys, d, y, yhat, low, high`` of every day of each series; the days after ``train_last`` are forecast.

    ``series`` has ``y``, the regressors and ``holidays``.  Draws are seeded by
    the series' keys, so a task that is run again gives the same bounds.
    """
    keys, chosen = list(keys), dict(params or {})

    def run(days: pd.DataFrame) -> pd.DataFrame:
        days = days.sort_values("d").reset_index(drop=True)
        seed = zlib.crc32("|".join(str(days[k].iloc[0]) for k in keys).encode())
        fit = fit_trend(days, chosen, train_last, seed)
        return days[[*keys, "d", "y"]].assign(yhat=fit.fitted, low=fit.low, high=fit.high)

    fields = [T.StructField(k, series.schema[k].dataType) for k in keys] + [T.StructField("d", T.IntegerType())]
    schema = T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in ("y", "yhat", "low", "high")])
    return series.groupBy(*keys).applyInPandas(run, schema)
