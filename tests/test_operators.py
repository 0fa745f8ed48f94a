"""Hand-computed cases, brute force in numpy or pandas, and invariants."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.dates import date_parts
from shelfcast.functions.numeric import clip_zero, hashed_poisson, log_factorial, round_count
from shelfcast.functions.text import split_series_key
from shelfcast.horizon import Horizon
from shelfcast.operators.aggregates import share_of_total, standardised
from shelfcast.operators.ensemble import stack_apply, stack_weights
from shelfcast.operators.evaluation import naive_scale, overall_score, revenue_weights, rmsse, weighted_scores
from shelfcast.operators.hierarchy import LEVELS, rollup_levels
from shelfcast.operators.joins import join_models
from shelfcast.operators.ordering import ranged_index
from shelfcast.operators.projection import category_dictionary, encode_categories, tight_types
from shelfcast.operators.recursion import recursive_forecast
from shelfcast.operators.reshape import dual_label, fill_days, melt_days, spread_days
from shelfcast.operators.sampling import sample_rows, sample_weighted
from shelfcast.operators.seasonal import fit_predict
from shelfcast.operators.topdown import distribute_volume
from shelfcast.operators.windows import growth_rates, rolling_columns, series_features
from shelfcast.sources.files import read_csv
from shelfcast.sources.schemas import wide_sales


def column(df, name, order):
    return [r[name] for r in df.orderBy(order).collect()]


def test_category_codes_put_null_first(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "c")], "i int, x string")
    coded = encode_categories(df, category_dictionary(df, ["x"]), ["x"])
    assert column(coded, "x", "i") == [2, 0, 1, 3]


def test_ranged_index_counts_within_groups(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("v"))
    got = ranged_index(df, [F.col("v")], ["g"]).toPandas().sort_values(["g", "v"])
    assert (got["index"].to_numpy() == got.groupby("g").cumcount().to_numpy()).all()


def test_rolling_mean_needs_a_full_window(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0])], "d int, sales double")
    rolled = df.withColumn("s", F.lit(1)).select("d", rolling_columns(["s"], "d", "sales", [0], [2])["rmean_0_2"].alias("m"))
    assert column(rolled, "m", "d") == [None, 1.5, None, None, 4.5, 5.5]


def test_features_equal_pandas(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame([(s, d, float(rng.integers(0, 9))) for s in "ab" for d in range(80)], columns=["id", "d", "sales"])
    got = series_features(spark.createDataFrame(frame), ["id"]).toPandas().sort_values(["id", "d"]).reset_index(drop=True)
    for k in (7, 28):
        lagged = frame.groupby("id")["sales"].shift(k)
        pd.testing.assert_series_equal(got[f"lag_{k}"], lagged, check_names=False)
        for n in (7, 28):
            rolled = lagged.groupby(frame["id"]).transform(lambda x: x.rolling(n).mean())
            pd.testing.assert_series_equal(got[f"rmean_{k}_{n}"], rolled, check_names=False)


def test_date_parts(spark):
    df = spark.sql("SELECT DATE'2016-01-01' AS date UNION ALL SELECT DATE'2016-04-25'")
    parts = date_parts()
    assert column(df.select("date", parts["week"].alias("w")), "w", "date") == [53, 17]
    assert column(df.select("date", parts["wday"].alias("w")), "w", "date") == [4, 0]


def test_rounding_is_half_even_and_clipped(spark):
    df = spark.createDataFrame([(2.5,), (-0.7,)], "x double")
    assert sorted(column(df.select("x", round_count(F.col("x")).alias("y")), "y", "x")) == [0, 2]


def test_growth_rate_keeps_changes_below_one(spark):
    pairs = [(2, 3), (2, 4), (2, 0), (0, 1), (0, 0)]
    rows = [(i + 1, float(a)) for i, (a, _) in enumerate(pairs)] + [(i + 29, float(b)) for i, (_, b) in enumerate(pairs)]
    rows += [(d, 0.0) for d in range(6, 29)]
    df = spark.createDataFrame([("x", "y", d, v) for d, v in rows], "dept_id string, store_id string, d int, sales double")
    assert growth_rates(df, 33).first()["rate"] == 1.5


def test_share_of_a_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 1.0), ("b", 3, 0.0), ("b", 4, 0.0)], "g string, i int, sales double")
    assert column(share_of_total(df, ["g"]), "share", "i") == [0.75, 0.25, None, None]


def test_top_down_keeps_the_sample_for_unknown_ids(spark):
    volume = spark.createDataFrame([("s", "d", 1, "m", 100.0)], "store_id string, dept_id string, h int, forecast_model string, volume double")
    weights = spark.createDataFrame([("i", "s", "d", 1, "w", 0.25)], "id string, store_id string, dept_id string, h int, weight_model string, weight double")
    sample = spark.createDataFrame([("i", 1, 0.0), ("j", 1, 0.0)], "id string, h int, yhat double")
    assert column(distribute_volume(volume, weights, sample), "yhat", "id") == [25.0, 0.0]


def test_rmsse_by_hand(spark):
    train = spark.createDataFrame([("a", d + 1, float(v)) for d, v in enumerate([0, 0, 2, 4, 3])] + [("z", 3, 0.0)], "id string, d int, sales double")
    scale = naive_scale(train, ["id"], 5)
    assert scale.collect() == [("a", 2.5)]
    errors = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 0.0), ("z", 1, 1.0)], "id string, h int, error double")
    got = {r["id"]: r["rmsse"] for r in rmsse(errors, scale, ["id"], steps=2).collect()}
    assert got["a"] == pytest.approx(math.sqrt(0.2)) and got["z"] is None


@pytest.mark.parametrize("trim", [True, False])
def test_sparse_scale_equals_dense_scale(spark, trim):
    rng = np.random.default_rng(5)
    dense = rng.integers(0, 4, (40, 60)) * (rng.random((40, 60)) < 0.3)
    rows = [(i, d + 1, float(v)) for i, r in enumerate(dense) for d, v in enumerate(r) if v]
    df = spark.createDataFrame(rows, "id int, d int, sales double")
    got = {r["id"]: r["scale"] for r in naive_scale(df, ["id"], 60, trim, 1).collect()}
    for i, r in enumerate(dense):
        series = r[np.argmax(r != 0):] if trim else r
        if r.any() and len(series) > 1:
            assert got[i] == pytest.approx(np.mean(np.diff(series) ** 2.0))


def panel(spark, seed=3):
    rng = np.random.default_rng(seed)
    rows = [
        (f"i{i}", f"d{i % 2}", "c", f"s{s}", "A" if s < 2 else "B", d, float(rng.integers(0, 6)))
        for i in range(4) for s in range(3) for d in range(1, 61) if rng.random() < 0.4
    ]
    return spark.createDataFrame(rows, "item_id string, dept_id string, cat_id string, store_id string, state_id string, d int, sales double")


def test_levels_add_up_and_match_pandas(spark):
    sales = panel(spark)
    frame = sales.toPandas()
    got = rollup_levels(sales).toPandas()
    for level, keys in LEVELS.items():
        part = got[got.level == level]
        assert part.sales.sum() == frame.sales.sum()
        expected = frame.groupby([*keys, "d"]).sales.sum()
        assert sorted(part.sales) == sorted(expected)


def test_score_equals_brute_force(spark):
    sales, end, steps = panel(spark), 32, 28
    frame = sales.toPandas()
    keys = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    ahead = sales.filter(F.col("d") > end).withColumn("h", F.col("d") - end)
    errors = ahead.select(*keys, "h", (F.col("sales") - 1).alias("error"))
    revenue = sales.filter(F.col("d") <= end).groupBy(*keys).agg(F.sum("sales").alias("revenue"))
    got = {r["level"]: r["score"] for r in weighted_scores(sales.filter(F.col("d") <= end), errors, revenue, end).collect()}
    frame["error"] = frame.sales - 1
    for level, by in LEVELS.items():
        frame["key"] = frame[by].agg("/".join, axis=1) if by else ""
        total, score = frame[frame.d <= end].sales.sum(), 0.0
        for _, part in frame.groupby("key"):
            train = part[part.d <= end].groupby("d").sales.sum().reindex(range(1, end + 1), fill_value=0).to_numpy()
            train_all = train[np.argmax(train != 0):]
            scale = np.mean(np.diff(train_all) ** 2.0)
            error = part[part.d > end].groupby("d").error.sum().reindex(range(end + 1, end + steps + 1), fill_value=0)
            score += train.sum() / total * np.sqrt(np.mean(error**2.0) / scale)
        assert got[level] == pytest.approx(score), level


def test_perfect_forecast_scores_zero(spark):
    sales, end = panel(spark), 32
    keys = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    errors = sales.select(*keys).distinct().withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(28)))).withColumn("error", F.lit(0.0))
    revenue = sales.filter(F.col("d") <= end).groupBy(*keys).agg(F.sum("sales").alias("revenue"))
    scores = weighted_scores(sales.filter(F.col("d") <= end), errors, revenue, end)
    assert overall_score(scores).first()["wrmsse"] == 0.0
    assert all(r["w"] == pytest.approx(1.0) for r in revenue_weights(revenue).groupBy("level").agg(F.sum("weight").alias("w")).collect())


def test_fill_days_and_melt_agree(spark):
    sparse = spark.createDataFrame([("a", 3, 2.0), ("a", 5, 1.0), ("b", 1, 4.0)], "id string, d int, sales double")
    filled = {(r["id"], r["d"]): r["sales"] for r in fill_days(sparse, "id", 1, 6).collect()}
    assert len(filled) == 12 and filled["a", 3] == 2.0 and filled["b", 6] == 0.0
    melted = {(r["id"], r["d"]): r["sales"] for r in melt_days(spread_days(sparse, ["id"], 1, 6), ["id"]).collect()}
    assert melted == filled


def test_stacking_equals_ridge(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 300), "a": rng.random(300), "b": rng.random(300), "y": rng.random(300)})
    df = spark.createDataFrame(frame)
    weights = stack_weights(df, ["g"], ["a", "b"], "y")
    for row in weights.collect():
        part = frame[frame.g == row["g"]]
        x = part[["a", "b"]].to_numpy()
        expected = np.linalg.solve(x.T @ x + 1e-4 * len(x) * np.eye(2), x.T @ part.y.to_numpy())
        assert row["w"] == pytest.approx(list(expected))
    assert stack_apply(df, weights, ["g"], ["a", "b"]).filter("ensemble < 0").count() == 0


def test_recursion_repeats_the_last_week_with_growth(spark):
    rows = [("a", d, float((d - 1) % 7 + 1) if d <= 70 else None, 1.1) for d in range(1, 99)]
    grid = spark.createDataFrame(rows, "id string, d int, sales double, rate double")
    got = column(recursive_forecast(grid, lambda r: r.withColumn("prediction", F.col("lag_7")), 70), "sales", "d")
    assert got == pytest.approx([1.1 ** (h // 7 + 1) * (h % 7 + 1) for h in range(28)])


def test_samples_are_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("w", F.when(F.col("id") < 50, 1000.0).otherwise(1.0))
    first = {r["id"] for r in sample_rows(df, 777, ["id"], seed=1).collect()}
    again = {r["id"] for r in sample_rows(df.repartition(5), 777, ["id"], seed=1).collect()}
    assert len(first) == 777 and first == again
    heavy = sample_weighted(df, 100, F.col("w"), ["id"], seed=1).filter("id < 50").count()
    assert heavy > 40


def test_dual_label_and_split_key(spark):
    df = spark.createDataFrame([("X_Y_evaluation",)], "id string")
    assert sorted(column(dual_label(df, "id", "evaluation", "validation"), "id", "id")) == ["X_Y_evaluation", "X_Y_validation"]
    key = spark.createDataFrame([("CA_1_HOUSEHOLD_2",)], "key string")
    assert tuple(key.select(*split_series_key("key")).first()) == ("CA_1", "HOUSEHOLD_2")


def test_join_models_keeps_common_rows(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 1, 2.0)], "id string, h int, yhat double")
    b = spark.createDataFrame([("x", 1, 3.0)], "id string, h int, yhat double")
    assert join_models({"a": a, "b": b}).collect() == [("x", 1, 1.0, 3.0)]


def test_tight_types_use_open_ranges(spark):
    df = spark.createDataFrame([(126, 127, 1.0)], "a long, b long, c double")
    assert [t for _, t in tight_types(df).dtypes] == ["tinyint", "smallint", "float"]


def test_typed_csv_turns_missing_into_null(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,item_id,dept_id,store_id,cat_id,state_id,d_1,d_2\nx,i,d,s,c,t,NaN,3\n")
    row = read_csv(spark, str(tmp_path / "s.csv"), wide_sales(2)).first()
    assert row["d_1"] is None and row["d_2"] == 3.0


def test_poisson_draws_and_log_factorial(spark):
    df = spark.range(20000).select(((F.col("id") + 0.5) / 20000).alias("u"))
    assert df.select(F.avg(hashed_poisson(F.col("u")))).first()[0] == pytest.approx(1.0, abs=0.01)
    for n in (0, 5, 170, 171, 1000):
        got = spark.range(1).select(log_factorial(F.lit(n))).first()[0]
        assert got == pytest.approx(math.lgamma(n + 1), rel=1e-9)
    assert spark.range(1).select(clip_zero(F.lit(-1.0))).first()[0] == 0.0


def test_seasonal_fit_follows_a_weekly_pattern():
    d = np.arange(1, 400)
    days = pd.DataFrame({"d": d, "y": 50 + 20 * np.sin(2 * np.pi * d / 7), "event": None, "snap": 0, "price": 1.0, "dom": 1})
    predicted = fit_predict(days, {}, 371)
    assert np.abs(predicted[371:] - days.y.to_numpy()[371:]).max() < 3


def test_standardised_moments(spark):
    row = standardised(spark.range(10).select(F.col("id").cast("double").alias("x")), ["x"]).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert row[0] == pytest.approx(0.0) and row[1] == pytest.approx(1.0)


def test_unknown_horizon_is_refused():
    assert Horizon.named("evaluation").last == 1969
    with pytest.raises(ValueError):
        Horizon.named("other")
