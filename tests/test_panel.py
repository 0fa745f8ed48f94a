"""The grid: prices of the past only, a full horizon, and columns that follow the data."""

from datetime import datetime, time, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.evaluation import blended_scores, overall_score, weighted_scores
from shelfcast.operators.models import poisson_model, train, tree_model, tune, tune_rounds
from shelfcast.operators.projection import distinct_values, one_hot
from shelfcast.operators.reshape import item_matrix
from shelfcast.operators.seasonal import CHUNK, design, fit_predict, forecast_series, random_candidates, score_candidates
from shelfcast.plans.catalog import QUERIES
from shelfcast.plans.panel import EPOCH, KEYS, dept_days, panel_grid, panel_horizon, panel_sales, week_of
from shelfcast.plans.score_queries import BASELINES, score_history


@pytest.mark.parametrize("grain", ["brand", "part"])
def test_every_priced_series_has_the_whole_horizon(spark, small, grain):
    horizon = panel_horizon(spark, small)
    grid = panel_grid(spark, small, grain, rate=False)
    known = panel_sales(spark, small, grain).filter(F.col("d") <= horizon.train_last)
    ahead = grid.filter(F.col("d") > horizon.train_last)
    assert ahead.count() == 28 * known.select("id").distinct().count()
    assert ahead.filter("sales IS NOT NULL OR sell_price IS NULL").count() == 0
    weeks = known.select("id", week_of().alias("w")).distinct()
    assert grid.filter(F.col("d") <= horizon.train_last).select("id", week_of().alias("w")).distinct().count() == weeks.count()


def test_recursion_forecasts_every_series_on_every_day(spark, small):
    horizon = panel_horizon(spark, small)
    series = panel_sales(spark, small, "brand").filter(F.col("d") <= horizon.train_last).select("id").distinct().count()
    assert QUERIES["recursive_forecast"](spark, small).count() == 28 * series


def test_prices_do_not_know_the_future(spark, small, tmp_path):
    """Other sales in the horizon leave the masked grid as it is."""
    for name in ("part", "supplier", "nation", "region"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    horizon = panel_horizon(spark, small)
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    late = F.col("l_shipdate").cast("date") >= F.lit(horizon.first_day)
    lines.withColumn("l_extendedprice", F.when(late, F.col("l_extendedprice") * 7).otherwise(F.col("l_extendedprice"))).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    columns = ["id", "d", "sales", "sell_price"]
    a, b = (panel_grid(spark, folder, rate=False).select(*columns) for folder in (small, str(tmp_path)))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_columns_follow_the_data(spark):
    rows = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 2.0), ("b", "new", 3.0)], "day string, item string, v double")
    items = distinct_values(rows, "item")
    assert items == ["new", "x", "y"]
    matrix = item_matrix(rows, ["day"], "item", items, ["v"]).orderBy("day").collect()
    assert [tuple(r) for r in matrix] == [("a", 0.0, 1.0, 0.0), ("b", 3.0, 0.0, 2.0)]
    many = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    assert len(one_hot(many.limit(3), "c", distinct_values(many, "c")).columns) == 1500


def growing(n=400):
    d = np.arange(n)
    y = 5 * np.exp(0.01 * d)
    return pd.DataFrame({"d": d, "y": y, "event": None, "snap": d % 2, "price": 1.0, "dom": d % 28 + 1})


def test_growth_is_not_cut():
    days = growing()
    out = fit_predict(days, {"seasonality_mode": "multiplicative", "changepoint_range": 0.5}, 280)
    assert out[-1] > 2 * days["y"][:281].max()
    assert np.all(np.isfinite(out))


def test_regressor_modes_change_the_design():
    days = growing()
    trained = (days["d"] <= 300).to_numpy()
    params = random_candidates(1)[0]
    assert {"snap_mode", "price_mode", "dom_mode"} <= set(params) and len(params) == 13
    y = days["y"].to_numpy(float)
    a, b = (design(days, {**params, "snap_mode": m}, trained, y)[0] for m in ("additive", "multiplicative"))
    assert a.shape == b.shape and not np.allclose(a[:, -3], b[:, -3]) and np.allclose(a[:, -1], b[:, -1])


def test_candidates_are_scored_as_alone(spark):
    days = growing(200).assign(store_id="s", dept_id="t").astype({"event": "object"})
    days.loc[3, "event"] = "e"
    candidates = random_candidates(CHUNK + 3, seed=5)
    schema = "d int, y double, event string, snap int, price double, dom int, store_id string, dept_id string"
    series = spark.createDataFrame(days.where(days.notna(), None), schema)
    got = {r.candidate: r.rmsse for r in score_candidates(series, candidates, 199).collect()}
    assert sorted(got) == list(range(CHUNK + 3))
    for i in (0, CHUNK, CHUNK + 2):
        known = days[days["d"] <= 199]
        held = (known["d"] > 171).to_numpy()
        error = known["y"].to_numpy()[held] - fit_predict(known, candidates[i], 171)[held]
        scale = np.mean(np.diff(known["y"].to_numpy()[~held]) ** 2)
        assert np.isclose(got[i], np.sqrt(np.mean(error**2) / scale))
    forecast = {r.d: r.yhat for r in forecast_series(series, 171).collect()}
    assert np.allclose([forecast[d] for d in range(172, 200)], fit_predict(days, {}, 171)[172:])


def test_poisson_totals_agree_per_category(spark):
    rows = [(float(k % 7), ["a", "b", "c"][k % 3], float(k % 5)) for k in range(300)]
    df = spark.createDataFrame(rows, "x double, c string, sales double")
    estimator = poisson_model().setRegParam(0.0)
    scored = train(df, estimator, ["x"], ["c"]).transform(df)
    for r in scored.groupBy("c").agg(F.sum("sales").alias("a"), F.sum("prediction").alias("p")).collect():
        assert abs(r.a - r.p) < 1e-3 * r.a


def test_tuning_measures_the_held_rows(spark):
    rows = [(float(k), float(k % 4), k >= 80) for k in range(100)]
    df = spark.createDataFrame(rows, "x double, sales double, late boolean")
    best, results = tune(df, tree_model(), {"maxDepth": [1, 3], "maxIter": [2]}, ["x"], held=F.col("late"))
    assert len(results) == 2 and best is not None
    assert min(r for _, r in results) > 0


def test_errors_of_shorter_models_are_read_off_the_longest(spark):
    """One fit of four rounds gives the errors that fits of one to four rounds have."""
    rows = [(float(k % 17), float((k * k) % 11), float((k % 17) * (k % 5) + 1), k % 5 == 4) for k in range(300)]
    df = spark.createDataFrame(rows, "x double, z double, sales double, late boolean").repartition(1).cache()
    got = {(d, n): e for d, n, e in tune_rounds(df, [2, 3], 4, ["x", "z"], held=F.col("late"))}
    assert set(got) == {(d, n) for d in (2, 3) for n in (1, 2, 3, 4)}
    _, results = tune(df, tree_model(), {"maxDepth": [2, 3], "maxIter": [1, 2, 4]}, ["x", "z"], held=F.col("late"))
    for described, error in results:
        depth, rounds = (int(part.split("=")[1]) for part in described.split(", "))
        assert abs(got[depth, rounds] - error) < 1e-9


def test_blend_scores_equal_scores_of_blended_errors(spark, small):
    horizon, history, earned = score_history(spark, small)
    from shelfcast.plans.score_queries import _wide_errors

    errors = _wide_errors(spark, small)
    weights = {"snaive7": 0.25, "snaive28": 0.25, "mean28": 0.5}
    quick = overall_score(blended_scores(history, errors, BASELINES, {"b": weights}, earned, horizon.train_last), ["model"]).first()
    mixed = sum((F.col(m) * w for m, w in weights.items()), F.lit(0.0))
    slow = weighted_scores(history, errors.select(*KEYS, "h", mixed.alias("error")), earned, horizon.train_last)
    assert np.isclose(quick["wrmsse"], slow.agg(F.avg("score")).first()[0])


def test_rows_are_not_shuffled_on_few_groups(spark, small):
    """The side of group facts is stored, so its size is known when the join is planned."""
    plan = QUERIES["stack_apply"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert not any("hashpartitioning(store_id" in line and "dept_id" in line for line in plan.splitlines() if "Exchange" in line)


def test_totals_read_no_day_past_their_last(spark):
    sales = spark.createDataFrame([("A", "x", 1, 2.0), ("A", "x", 3, 5.0), ("A", "x", 9, 7.0)], "store_id string, dept_id string, d int, sales double")
    rows = dept_days(sales, 4).orderBy("d").collect()
    assert [(r.d, r.sales) for r in rows] == [(1, 2.0), (2, 0.0), (3, 5.0), (4, 0.0)]


# --- tables of their own -----------------------------------------------------

def write_tables(spark, folder, lines):
    """Tables of two items of one department in one store; ``lines`` are (part, day, quantity)."""
    dated = [(p, 1, float(q), float(q) * 2, datetime.combine(EPOCH, time()) + timedelta(days=d)) for p, d, q in lines]
    for name, rows, schema in [
        ("lineitem", dated, "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"),
        ("part", [(p, "Brand#1", "PROMO") for p in sorted({x[0] for x in lines})], "p_partkey long, p_brand string, p_type string"),
        ("supplier", [(1, 1)], "s_suppkey long, s_nationkey int"), ("nation", [(1, 1)], "n_nationkey int, n_regionkey int"),
        ("region", [(1, "ASIA")], "r_regionkey int, r_name string"),
    ]:
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_top_down_spreads_the_departments_own_forecast(spark, tmp_path):
    last, end = 128, 100
    own = {1: lambda d: 4.0 + (d > 60) * 2, 2: lambda d: 3.0 * (d % 7 == 0)}
    lines = [(p, d, q(d)) for p, q in own.items() for d in range(1, last + 1) if q(d)]
    lines.append((3, 5, 1.0))  # long silent: its share is 0
    folder = write_tables(spark, tmp_path, lines)
    total = {d: sum(q for _, x, q in lines if x == d) for d in range(1, end + 1)}
    changes = [total[d] / total[d - 28] - 1 for d in range(29, end + 1)]
    changes = [c for c in changes if abs(c) < 1]
    rate = 1 + sum(changes) / len(changes)
    weeks = {h: -(-h // 7) for h in range(1, 29)}
    volumes = {h: rate ** w * total[end + h - 7 * w] for h, w in weeks.items()}
    month = {p: sum(q for x, d, q in lines if x == p and end - 28 < d <= end) for p in (1, 2, 3)}
    shares = {f"PROMO_{p}_ASIA": month[p] / sum(month.values()) for p in month}
    got = {(r.id, r.h): r.yhat for r in QUERIES["top_down"](spark, folder).collect()}
    assert got == {(i, h): pytest.approx(volumes[h] * share, abs=1e-6) for i, share in shares.items() for h in volumes}
    # the forecast follows the department's week, which a sum of the items' means does not
    assert len({round(v, 6) for v in volumes.values()}) > 4
