"""One seasonal regression per series: trend, Fourier seasons, holidays and regressors.

Spark groups the days of each series (at most one row per day, so a group is
small whatever the data volume) and fits them independently.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Season lengths in days, the regressors, and the number of possible trend changes.
PERIODS = {"yearly": 365.25, "monthly": 365.25 / 12, "weekly": 7.0}
REGRESSORS = ["snap", "price", "dom"]
CHANGEPOINTS = 25
DEFAULTS = {
    "changepoint_range": 0.8, "changepoint_prior_scale": 0.05, "holidays_prior_scale": 10.0,
    "seasonality_mode": "additive", "yearly_order": 6, "monthly_order": 3, "weekly_order": 3,
    "yearly_prior_scale": 10.0, "monthly_prior_scale": 10.0, "weekly_prior_scale": 10.0,
    "snap_mode": "additive", "price_mode": "additive", "dom_mode": "additive",
}
CHUNK = 10


def design(days: pd.DataFrame, params: dict, trained: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of the regression and the prior scale of each.

    ``trained`` marks the rows that the trend changes, scaling and level may look at.
    """
    t = days["d"].to_numpy(float)
    t0, t1 = t[trained].min(), t[trained].max()
    u = (t - t0) / max(t1 - t0, 1.0)
    line = np.polyval(np.polyfit(u[trained], target[trained], 1), u) if trained.sum() > 1 else np.ones_like(u)
    level = line / max(np.abs(line[trained]).mean(), 1e-9)
    columns, scales = [np.ones_like(u), u], [1e3, 1e3]
    for change in np.linspace(0, params["changepoint_range"], CHANGEPOINTS + 1)[1:]:
        columns.append(np.maximum(u - change, 0.0))
        scales.append(params["changepoint_prior_scale"])
    for season, period in PERIODS.items():
        for k in range(1, params[f"{season}_order"] + 1):
            angle = 2 * np.pi * k * t / period
            columns += [np.sin(angle), np.cos(angle)]
            scales += [params[f"{season}_prior_scale"]] * 2
    events = days["event"].fillna("")
    for name in sorted(set(events) - {""}):
        columns.append((events == name).to_numpy(float))
        scales.append(params["holidays_prior_scale"])
    for name in REGRESSORS:
        x = days[name].astype(float).ffill().fillna(0.0).to_numpy()
        spread = x[trained].std()
        x = (x - x[trained].mean()) / (spread if spread > 0 else 1.0)
        # a multiplicative regressor acts in proportion to the level of the series
        columns.append(x * level if params[f"{name}_mode"] == "multiplicative" else x)
        scales.append(10.0)
    return np.column_stack(columns), np.asarray(scales)


def fit_predict(days: pd.DataFrame, params: dict, train_last: int) -> np.ndarray:
    """Forecast of every row from the rows up to ``train_last`` with a target.

    Ridge regression with a penalty per column from its prior scale.  In the
    multiplicative mode effects act on the logarithm.
    """
    params = {**DEFAULTS, **params}
    trained = ((days["d"] <= train_last) & days["y"].notna()).to_numpy()
    multiplicative = params["seasonality_mode"] == "multiplicative"
    every = days["y"].to_numpy(float)
    every = np.log1p(every) if multiplicative else every
    target = every[trained]
    unit = max(np.abs(target).max(), 1e-9)
    x, scales = design(days, params, trained, every)
    a = x[trained]
    penalty = np.diag(0.1 / scales**2)
    weights = np.linalg.solve(a.T @ a + penalty, a.T @ (target / unit))
    predicted = x @ weights * unit
    # a logarithm above 700 has no double; nothing smaller is cut
    predicted = np.expm1(np.minimum(predicted, 700.0)) if multiplicative else predicted
    return np.maximum(np.rint(predicted), 0.0)


def forecast_series(
    series: DataFrame, train_last: int, keys: Sequence[str] = ("store_id", "dept_id"), params: str | None = None
) -> DataFrame:
    """Forecasts ``(keys, d, yhat)`` of the days after ``train_last`` of each series.

    ``params`` names a struct column with the series' tuned parameters.
    """
    keys = list(keys)

    def run(days: pd.DataFrame) -> pd.DataFrame:
        days = days.sort_values("d").reset_index(drop=True)
        chosen = {} if params is None else {k: v for k, v in days[params].iloc[0].items() if v is not None}
        out = days[[*keys, "d"]].assign(yhat=fit_predict(days, chosen, train_last))
        return out[out["d"] > train_last]

    return series.groupBy(*keys).applyInPandas(run, _schema(series, keys, [("d", T.IntegerType()), ("yhat", T.DoubleType())]))


def score_candidates(
    series: DataFrame, candidates: Sequence[dict], train_last: int, keys: Sequence[str] = ("store_id", "dept_id"), steps: int = 28
) -> DataFrame:
    """Scaled error of every candidate on the last ``steps`` days of history of each series.

    A series is copied once per CHUNK candidates (it has one row per day), so a
    long search spreads over more tasks than there are series.
    """
    keys, cutoff = list(keys), train_last - steps
    copied = series.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit((len(candidates) - 1) // CHUNK))))

    def run(days: pd.DataFrame) -> pd.DataFrame:
        days = days[days["d"] <= train_last].sort_values("d").reset_index(drop=True)
        if days.empty:
            return pd.DataFrame(columns=[*keys, "candidate", "rmsse"])
        held = (days["d"] > cutoff).to_numpy()
        before = days.loc[~held, "y"].to_numpy(float)
        scale = np.mean(np.diff(before) ** 2) if len(before) > 1 else 0.0
        first = int(days["_chunk"].iloc[0]) * CHUNK
        rows = []
        for i, candidate in enumerate(candidates[first:first + CHUNK], first):
            score = None
            if held.any() and scale > 0:
                error = days["y"].to_numpy(float)[held] - fit_predict(days, candidate, cutoff)[held]
                score = float(np.sqrt(np.mean(error**2) / scale))
            rows.append([*days.loc[0, keys], i, score])
        return pd.DataFrame(rows, columns=[*keys, "candidate", "rmsse"])

    schema = _schema(series, keys, [("candidate", T.IntegerType()), ("rmsse", T.DoubleType())])
    return copied.groupBy(*keys, "_chunk").applyInPandas(run, schema)


def random_candidates(n: int, seed: int = 0) -> list[dict]:
    """Parameter sets drawn from the tuning ranges."""
    rng = np.random.default_rng(seed)

    def log_uniform(low: float, high: float) -> float:
        return float(np.exp(rng.uniform(np.log(low), np.log(high))))

    # The tuning ranges.
    return [
        {
            "changepoint_range": float(rng.choice([0.7, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0])),
            "changepoint_prior_scale": log_uniform(0.001, 1),
            "holidays_prior_scale": log_uniform(0.1, 20),
            "seasonality_mode": str(rng.choice(["additive", "multiplicative"])),
            "yearly_order": int(rng.integers(1, 21)),
            "monthly_order": int(rng.integers(1, 21)),
            "weekly_order": int(rng.integers(1, 21)),
            "yearly_prior_scale": log_uniform(0.1, 20),
            "monthly_prior_scale": log_uniform(0.1, 20),
            "weekly_prior_scale": log_uniform(0.1, 20),
            **{f"{name}_mode": str(rng.choice(["additive", "multiplicative"])) for name in REGRESSORS},
        }
        for _ in range(n)
    ]


def _schema(df: DataFrame, keys: Sequence[str], more: Sequence[tuple[str, T.DataType]]) -> T.StructType:
    fields = [df.schema[k] for k in keys]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(n, t) for n, t in more])
