"""Successive halving against full search."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfcast.operators.halving import cost, rung_plan, series_scorer, successive_halving, winners
from shelfcast.operators.seasonal import random_candidates, score_candidates


def test_plan_costs_less_than_half():
    plan = rung_plan(100)
    assert plan == [(100, 1 / 9), (34, 1 / 3), (12, 1.0)] and cost(plan) < 50
    assert rung_plan(81) == [(81, 1 / 9), (27, 1 / 3), (9, 1.0)] and rung_plan(1, rungs=1) == [(1, 1.0)]


def test_rungs_by_hand(spark):
    """Scores that a budget blurs: survivors are the best third of each group at each rung."""
    groups = spark.createDataFrame([("a",), ("b",), ("b",)], "g string")
    value = lambda g, c, budget: (c * 7 + (3 if g == "a" else 11)) % 27 + (1 - budget) * (c % 2)
    calls = []

    def score(survivors, budget):
        rows = [(r.g, r.candidate, None if r.candidate == 5 else float(value(r.g, r.candidate, budget))) for r in survivors.collect()]
        calls.append(len(rows))
        return spark.createDataFrame(rows, "g string, candidate int, score double")

    table = successive_halving(groups, 27, score, ["g"]).collect()
    alive, expected = {"a": list(range(27)), "b": list(range(27))}, set()
    for rung, (n, budget) in enumerate(rung_plan(27)):
        left = [9, 3, 1][rung]
        for g in alive:
            order = sorted(alive[g], key=lambda c: (c == 5, value(g, c, budget), c))
            expected |= {(g, c, rung, k < left) for k, c in enumerate(order)}
            alive[g] = order[:left]
    assert {(r.g, r.candidate, r.rung, r.kept) for r in table} == expected and calls == [54, 18, 6]
    best = winners(successive_halving(groups, 27, score, ["g"]), ["g"]).collect()
    assert {r.g: r.candidate for r in best} == {g: c[0] for g, c in alive.items()}


def test_finds_the_winner_of_the_full_search(spark):
    rng, frames = np.random.default_rng(4), []
    for k in range(3):
        t = np.arange(1, 401)
        y = 60 + 20 * np.sin(2 * np.pi * t / 7 + k) + rng.normal(0, 1, 400)
        frames.append(pd.DataFrame({"store_id": "s", "dept_id": str(k), "d": t, "y": y, "snap": t % 2, "price": 1.0 + t % 3, "dom": t % 30, "event": None}))
    series = spark.createDataFrame(pd.concat(frames), "store_id string, dept_id string, d int, y double, snap int, price double, dom int, event string")
    keys = ["store_id", "dept_id"]
    # one candidate can follow the week; the others are all but flat
    flat = {"weekly_order": 1, "weekly_prior_scale": 1e-4, "yearly_order": 1, "monthly_order": 1}
    candidates = [dict(c, **flat) for c in random_candidates(12, seed=1)]
    candidates[7] = {**flat, "weekly_prior_scale": 10.0}
    full = score_candidates(series, candidates, 400).groupBy(*keys).agg(F.min(F.struct("rmsse", "candidate")).alias("b")).collect()
    best = winners(successive_halving(series, 12, series_scorer(series, candidates, 400, keys), keys), keys).collect()
    assert {r.dept_id: r.candidate for r in best} == {r.dept_id: r.b.candidate for r in full} == {str(k): 7 for k in range(3)}
    scores = {r.dept_id: r.b.rmsse for r in full}
    assert all(abs(r.score - scores[r.dept_id]) < 1e-9 for r in best)  # the last rung has the full budget
