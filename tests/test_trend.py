"""The sparse trend regression: planted changes, brute force, intervals, holiday windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.seasonal import CHANGEPOINTS, DEFAULTS
from shelfcast.operators.trend import (
    CHANGES, FREE, bounds, effects, fit_trend, holiday_windows, map_fit, sparse_solution, trend_forecast,
)


def days_of(y, last=None, holidays=None):
    n = len(y)
    return pd.DataFrame({
        "d": np.arange(1, n + 1), "y": y, "snap": (np.arange(n) % 3 == 0).astype(int), "price": 1.0 + (np.arange(n) // 50) % 2,
        "dom": np.arange(n) % 30 + 1, "holidays": holidays if holidays is not None else [None] * n,
    })


def planted(changes, n=500, noise=0.5, seed=0):
    """A weekly pattern on a line with the given ``{day: change of slope}``."""
    r, t = np.random.default_rng(seed), np.arange(1, n + 1)
    trend = 50 + 0.02 * t + sum(c * np.maximum(t - day, 0) for day, c in changes.items())
    return trend + 4 * np.sin(2 * np.pi * t / 7) + r.normal(0, noise, n)


@pytest.mark.parametrize("changes", [{160: 0.4}, {120: 0.3, 300: -0.5}])
def test_planted_changes_are_found_and_few_others(changes):
    fit = fit_trend(days_of(planted(changes)), {"yearly_order": 1, "monthly_order": 1}, 500)
    step = 0.8 * 499 / CHANGEPOINTS
    for day, change in changes.items():
        near = sum(c for at, c in fit.changes if abs(at - day) <= 1.5 * step)
        assert abs(near - change) < 0.15 * abs(change)
    large = [c for at, c in fit.changes if min(abs(at - d) for d in changes) > 1.5 * step and abs(c) > 0.05]
    assert not large and len(fit.changes) < CHANGEPOINTS


def test_a_straight_line_has_no_changes():
    fit = fit_trend(days_of(planted({}, noise=0.3)), {"yearly_order": 1, "monthly_order": 1}, 500)
    assert len(fit.changes) <= CHANGEPOINTS // 4 and all(abs(c) < 0.01 for _, c in fit.changes)


def test_sparse_solution_by_brute_force():
    """Against all sign patterns of a small problem."""
    r = np.random.default_rng(1)
    for _ in range(20):
        a = r.normal(size=(30, 4)) @ r.normal(size=(4, 4))
        gram, moment, penalty = a.T @ a, a.T @ r.normal(size=30), 3.0
        value = lambda d: d @ gram @ d / 2 - moment @ d + penalty * np.abs(d).sum()
        best = np.zeros(4)
        for pattern in np.ndindex(3, 3, 3, 3):
            sign = np.array(pattern) - 1
            on = np.flatnonzero(sign)
            d = np.zeros(4)
            if len(on):
                d[on] = np.linalg.solve(gram[np.ix_(on, on)], moment[on] - penalty * sign[on])
            if (np.sign(d) == sign).all() and value(d) < value(best):
                best = d
        assert np.allclose(sparse_solution(gram, moment, penalty), best, atol=1e-8)


def test_fit_meets_the_conditions_of_the_least_value():
    """Gradients: none at level, slope and smooth effects, at the penalty's edge for changes."""
    days = days_of(planted({150: 0.3}, n=300))
    params = {**DEFAULTS, "yearly_order": 2}
    trained = np.ones(300, bool)
    x, scales = effects(days, params, trained, days["y"].to_numpy())
    y = days["y"].to_numpy() / days["y"].abs().max()
    weights, noise = map_fit(x, y, scales, 0.05, rounds=1)
    prior = float(y.var())  # the noise that the only round used
    slope = x.T @ (y - x @ weights)
    assert np.allclose(slope[FREE], 0, atol=1e-6)
    smooth = np.arange(CHANGES.stop, x.shape[1])
    assert np.allclose(slope[smooth], prior / scales[smooth] ** 2 * weights[smooth], atol=1e-6)
    d, g = weights[CHANGES], slope[CHANGES]
    edge = prior / 0.05
    assert (np.abs(g) <= edge * (1 + 1e-6)).all() and np.allclose(g[d != 0], edge * np.sign(d[d != 0]), rtol=1e-5)


def test_sums_are_those_of_the_actual_days():
    days = days_of(planted({200: 0.2}))
    fit = fit_trend(days, {}, 470)
    past = slice(0, 470)
    y, d = days["y"].to_numpy()[past], days["d"].to_numpy()[past]
    assert np.isclose(fit.fitted[past].sum(), y.sum()) and np.isclose(fit.fitted[past] @ d, y @ d)


def test_intervals_cover_and_widen():
    days = days_of(planted({100: 0.3, 250: -0.4}, noise=2.0))
    days.loc[days["d"] > 450, "y"] = np.nan
    fit = fit_trend(days, {"yearly_order": 1, "monthly_order": 1}, 450, seed=3)
    assert (fit.low <= fit.fitted).all() and (fit.fitted <= fit.high).all()
    width, truth = fit.high - fit.low, planted({100: 0.3, 250: -0.4}, noise=2.0)
    inside = ((truth >= fit.low) & (truth <= fit.high))[:450].mean()
    assert 0.7 < inside < 0.9
    assert width[-1] > 1.05 * width[:450].mean()
    again = fit_trend(days, {"yearly_order": 1, "monthly_order": 1}, 450, seed=3)
    assert np.array_equal(fit.low, again.low)
    low, high = bounds(np.zeros(3), np.array([-1.0, 0.1, 0.5]), np.zeros(CHANGEPOINTS), 0.8, 0.0, 1.0, 0, 50, 0.8)
    assert not low.any() and not high.any()  # no changes and no noise


def test_holiday_windows_are_learned(spark):
    n = 400
    events = spark.createDataFrame([(d, "Fair") for d in range(40, n, 60)] + [(5, None)], "d int, event string")
    days = spark.range(1, n + 1).select(F.col("id").cast("int").alias("d"))
    near = {r.d: r.holidays for r in holiday_windows(days, events, 2, 1).collect()}
    assert near[38] == ["Fair-2"] and near[40] == ["Fair+0"] and near[41] == ["Fair+1"] and near[42] is None and len(near) == n
    y = planted({}, n=n, noise=0.1)
    for d in range(40, n, 60):
        y[d - 2] += 20  # the day before
    with_windows = fit_trend(days_of(y, holidays=[near[d] for d in range(1, n + 1)]), {"yearly_order": 1, "monthly_order": 1}, 350)
    plain = fit_trend(days_of(y), {"yearly_order": 1, "monthly_order": 1}, 350)
    before = [d - 2 for d in range(360, n, 1) if (d - 40) % 60 == 0]
    assert all(abs(with_windows.fitted[k] - y[k]) < 3 for k in before) and all(abs(plain.fitted[k] - y[k]) > 10 for k in before)


def test_series_without_targets_and_constant_series(spark):
    empty = fit_trend(days_of(np.full(20, np.nan)), {}, 20)
    assert np.isnan(empty.fitted).all() and empty.changes == []
    flat = fit_trend(days_of(np.full(60, 7.0)), {}, 60)
    assert np.allclose(flat.fitted, 7.0)
    frame = pd.concat([days_of(planted({}, n=80)).assign(store_id="s", dept_id=k) for k in ("a", "b")]).assign(holidays=None)
    schema = "d int, y double, snap int, price double, dom int, holidays array<string>, store_id string, dept_id string"
    got = trend_forecast(spark.createDataFrame(frame, schema), 60).collect()
    assert len(got) == 160 and {r.dept_id for r in got} == {"a", "b"}
    alone = fit_trend(days_of(planted({}, n=80)), {}, 60)
    assert np.allclose(sorted(r.yhat for r in got if r.dept_id == "a"), sorted(alone.fitted))
