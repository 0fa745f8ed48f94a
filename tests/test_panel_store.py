"""Prefix-sum means, the bucketed panel store, and recursion inside a partition."""

import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.horizon import Horizon
from shelfcast.operators.recursion import recursive_forecast
from shelfcast.operators.series_recursion import LinearModel, recursive_forecast_in_partition
from shelfcast.operators.windows import rolling_columns, series_features, with_rolling_means
from shelfcast.plans.panel import KEYS, panel_days
from shelfcast.plans.store_queries import store_features
from shelfcast.sources.panel_store import HORIZON_BLOCK, OVERWRITE_MODE, PanelStore, temporary_store


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- prefix sums -------------------------------------------------------------

def series_rows(seed=3, gaps=True):
    r = np.random.default_rng(seed)
    rows = []
    for s in range(12):
        for d in range(r.integers(1, 120)):
            rows.append((f"s{s}", int(d) * 2, None if gaps and r.random() < 0.1 else float(r.integers(0, 50))))
    return rows


def test_rolling_means_equal_frames_to_the_last_bit(spark):
    df = spark.createDataFrame(series_rows(), "id string, d int, sales double").withColumns({"_total": F.lit(1), "_KNOWN": F.lit(2)})
    lags, windows = [0, 1, 7, 28], [1, 2, 7, 28]
    frames = df.select("*", *[c.alias(n) for n, c in rolling_columns(["id"], "d", "sales", lags, windows).items()])
    sums = with_rolling_means(df, ["id"], "d", "sales", lags, windows)
    assert sums.columns == frames.columns
    key = lambda r: (r.id, r.d)
    assert sorted(sums.collect(), key=key) == sorted(frames.collect(), key=key)


def test_features_are_one_exchange_and_no_sliding_frame(spark):
    df = spark.createDataFrame(series_rows(), "id string, d int, sales double")
    plan = plan_of(series_features(df, ["id"]))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and plan.count("Sort [") == 1
    frames = set(re.findall(r"specifiedwindowframe\(RowFrame, [^)]*\)", plan.replace("$()", "")))
    assert frames <= {f"specifiedwindowframe(RowFrame, -{k}, -{k})" for k in range(100)} | {
        "specifiedwindowframe(RowFrame, unboundedpreceding, currentrow)"}


# --- the store ---------------------------------------------------------------

END = 400


def sales_rows(last, seed=5):
    r = np.random.default_rng(seed)
    rows = []
    for s in range(15):
        for d in sorted(r.choice(np.arange(1, END + 28), size=25, replace=False)):
            rows.append((f"i{s}_S", f"i{s}", "D", "C", "S", "T", int(d), float(r.integers(1, 9)), float(r.integers(100, 900))))
    # a series that ends early, one that begins with the new week, one that falls silent
    rows += [("old_S", "old", "D", "C", "S", "T", 3, 2.0, 300.0), ("new_S", "new", "D", "C", "S", "T", END - 2, 1.0, 150.0)]
    return [x for x in rows if x[6] <= last]


def sales_frame(spark, last=END + 27):
    return spark.createDataFrame(sales_rows(last), "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, d int, sales double, cents double")


def horizon(end):
    return Horizon("test", end, date(2020, 1, 1) + timedelta(days=end))


@pytest.mark.parametrize("weeks,step", [(1, 7), (4, 7), (13, 3), (1, 40), (104, 7)])
def test_appended_days_equal_the_whole_panel(spark, weeks, step):
    sales, before, today = sales_frame(spark), horizon(END - step), horizon(END)
    with temporary_store(spark, weeks=weeks, buckets=3) as (store, path):
        store.create(panel_days(sales, before), before.train_last, path)
        kept = {r.block: r.file for r in spark.table(store.name).groupBy("block").agg(F.max("_metadata.file_path").alias("file")).collect()}
        mode = spark.conf.get(OVERWRITE_MODE)
        for _ in range(2):  # a repeated append changes nothing
            store.append(lambda day: panel_days(sales.filter(F.col("d") >= day), today), before.train_last, today.train_last, today.last, KEYS)
        assert spark.conf.get(OVERWRITE_MODE) == mode
        whole = panel_days(sales, today)
        columns = [*KEYS, "d", "sales", "sell_price"]
        got, expected = (sorted(map(tuple, x.select(*columns).collect()), key=str) for x in (store.read(), whole))
        assert got == expected
        files = {r.block: r.file for r in spark.table(store.name).groupBy("block").agg(F.max("_metadata.file_path").alias("file")).collect()}
        first = store.first_day(before.train_last + 1) // (7 * weeks)
        assert {b for b in files if files[b] == kept.get(b)} == {b for b in kept if b != HORIZON_BLOCK and b < first}
        assert store.horizon().agg(F.min("d"), F.max("d")).first()[:] == (END + 1, END + 28)


def test_windows_and_joins_over_the_store_need_no_exchange(spark):
    today = horizon(END)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with temporary_store(spark, buckets=8) as (store, path):
            store.create(panel_days(sales_frame(spark), today), today.train_last, path)
            features = store_features(store)
            assert "Exchange" not in plan_of(features)
            last = store.read().groupBy("id").agg(F.max("d").alias("last"))
            joined = features.join(last, "id")
            assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined)
            expected = series_features(panel_days(sales_frame(spark), today), ["id"])
            names = expected.columns
            assert sorted(map(str, features.select(*names).collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_temporary_store_is_forgotten_after_a_failure(spark):
    with pytest.raises(ValueError):
        with temporary_store(spark) as (store, path):
            store.create(panel_days(sales_frame(spark), horizon(END)), END, path)
            raise ValueError
    assert not spark.catalog.tableExists(store.name)


# --- recursion in a partition ------------------------------------------------

def grid_rows(spark, seed=7):
    r = np.random.default_rng(seed)
    rows = []
    for s in range(40):
        rate = None if s % 5 == 0 else float(r.uniform(0.9, 1.1))
        for d in range(int(r.integers(1, 120)), 121):  # some series are short
            if d > 100 and s % 7 == 3 and d % 2:
                continue  # and some have gaps in the horizon
            sales = None if d > 100 or r.random() < 0.02 else float(r.integers(0, 30))
            rows.append((f"s{s}", s % 3, d, sales, rate, float(r.uniform(1, 5))))
    return spark.createDataFrame(rows, "id string, part int, d int, sales double, rate double, price double").repartition(7)


MODELS = [
    LinearModel({"lag_7": 0.5, "rmean_28_28": 0.4}),
    LinearModel({"lag_7": 0.02, "lag_28": 0.01, "rmean_7_7": 0.01, "price": -0.1}, 0.7, "log", 3.0),
]


@pytest.mark.parametrize("model", MODELS)
def test_partition_recursion_equals_the_rounds(spark, model):
    grid = grid_rows(spark)

    def predict(rows):
        score = F.lit(model.intercept)
        for name, w in model.coefficients.items():
            score = score + F.coalesce(F.col(name), F.lit(model.missing)) * w
        return rows.withColumn("prediction", F.exp(score) if model.link == "log" else score)

    loop = {(r.id, r.part, r.d): r.sales for r in recursive_forecast(grid, predict, 100, 20, ["id", "part"]).collect()}
    once = {(r.id, r.part, r.d): r.sales for r in recursive_forecast_in_partition(grid, model, 100, 20, ["id", "part"]).collect()}
    assert loop.keys() == once.keys() and len(once) > 600
    assert np.allclose([loop[k] for k in loop], [once[k] for k in loop], rtol=1e-9, atol=1e-9)


def test_partition_recursion_by_multiplier_and_in_small_batches(spark):
    grid, model = grid_rows(spark), MODELS[0]
    alphas = [1.0, 1.05]
    runs = recursive_forecast_in_partition(grid, model, 100, 20, multipliers=alphas)
    for alpha in alphas:
        own = recursive_forecast_in_partition(grid.withColumn("rate", F.lit(alpha)), model, 100, 20)
        assert sorted(map(tuple, runs.filter(F.col("alpha") == alpha).drop("alpha").collect())) == sorted(map(tuple, own.collect()))
    whole = sorted(map(tuple, runs.collect()))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, recursive_forecast_in_partition(grid, model, 100, 20, multipliers=alphas).collect())) == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_partition_recursion_is_one_shuffle(spark):
    plan = plan_of(recursive_forecast_in_partition(grid_rows(spark), MODELS[0], 100, 20))
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1


def test_a_model_must_not_look_back_further_than_the_history(spark):
    with pytest.raises(ValueError):
        recursive_forecast_in_partition(grid_rows(spark), LinearModel({"lag_90": 1.0}), 100)
    with pytest.raises(ValueError):
        LinearModel({}, link="probit")
