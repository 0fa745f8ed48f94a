"""Queries that fit models and forecast with them."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.operators.aggregates import share_of_total, target_means
from shelfcast.operators.evaluation import weighted_scores
from shelfcast.operators.halving import series_scorer, successive_halving, winners
from shelfcast.operators.models import (
    importances, poisson_model, predictor, share_model, softmax_share_model, train, tree_model, tune_rounds, tweedie_model, unpenalised,
)
from shelfcast.operators.recursion import average_runs, recursive_forecast
from shelfcast.operators.reshape import pivot_steps
from shelfcast.operators.seasonal import forecast_series, random_candidates, score_candidates
from shelfcast.operators.series_recursion import LinearModel, recursive_forecast_in_partition
from shelfcast.operators.topdown import renormalise
from shelfcast.operators.trend import holiday_windows, trend_forecast
from shelfcast.operators.windows import series_features
from shelfcast.plans.feature_queries import ROLLED, STORE_DEPT_SQL, features_sql, panel_features, store_dept_table
from shelfcast.plans.panel import (
    KEYS, SERIES_KEYS, dept_days, panel_calendar, panel_grid, panel_horizon, panel_rates, panel_sales, panel_tasks,
    recent_series,
)
from shelfcast.plans.panel_sql import with_panel
from shelfcast.plans.registry import query, r6
from shelfcast.plans.score_queries import (
    SCORE_SQL, SEASONAL_SQL, SHARES_SQL, score_history, scores_sql, seasonal_volumes, top_down_forecast,
)
from shelfcast.session import cut_lineage, measured, scratch_path

LAGGED = ["lag_7", "lag_28", *ROLLED]
NUMERIC = [*LAGGED, "sell_price", "mday", "snap_A", "snap_B"]
SMALL = ["dept_id", "store_id", "wday", "month"]
# What a lag or mean that reaches before the series counts as, in training and in prediction alike.
UNKNOWN = 0.0


# --- recursion ---------------------------------------------------------------

@query("recursive_seasonal", with_panel("part", *SEASONAL_SQL)
       + "SELECT store_id, dept_id, h, round(volume, 6) AS yhat FROM volumes")
def recursive_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly repetition with growth, per store and department."""
    end = panel_horizon(spark, sf_dir).train_last
    volumes = seasonal_volumes(panel_sales(spark, sf_dir).filter(F.col("d") <= end), end)
    return volumes.withColumn("yhat", r6("yhat"))


@query("wrmsse_top_down", with_panel("part", *SEASONAL_SQL, SHARES_SQL, *SCORE_SQL[:-1], """
spread_errs AS (
  SELECT b.* EXCLUDE (truth, snaive7, snaive28, mean28), 'top_down' AS model, truth - coalesce(volume * share, snaive7) AS error
  FROM base b JOIN shares s ON s.id = b.id
  LEFT JOIN volumes v ON v.store_id = b.store_id AND v.dept_id = b.dept_id AND v.h = b.h)""", *scores_sql("spread_errs")) + """
SELECT level, round(score, 6) AS score FROM scores""")
def wrmsse_top_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: volumes of stores and departments, shares, items, and their score on every level."""
    horizon, history, earned = score_history(spark, sf_dir)
    volumes = measured(seasonal_volumes(history, horizon.train_last)).select(
        "store_id", "dept_id", "h", F.lit("seasonal").alias("forecast_model"), F.col("yhat").alias("volume")
    )
    errors = top_down_forecast(measured(recent_series(spark, sf_dir)), volumes).select(*KEYS, "h", (F.col("truth") - F.col("yhat")).alias("error"))
    scores = weighted_scores(history, errors, earned, horizon.train_last, tasks=panel_tasks(spark, sf_dir))
    return scores.select("level", r6("score"))


# Coefficients of a linear model that SQL can follow.
COEFFICIENTS = {"lag_7": 0.3, "lag_28": 0.2, "rmean_7_28": 0.3, "rmean_28_28": 0.2}


def _linear(rows: DataFrame) -> DataFrame:
    terms = [F.coalesce(F.col(c), F.lit(0.0)) * w for c, w in COEFFICIENTS.items()]
    return rows.withColumn("prediction", sum(terms[1:], terms[0]))


def recursion_sql(source: str, keys: str, factor: str) -> list[str]:
    """The recursion one day at a time, twenty-eight steps."""
    linear = " + ".join(f"{w} * coalesce({c}, 0.0)" for c, w in COEFFICIENTS.items())
    parts = [f"""
ranked AS (SELECT {keys}, d, sales, row_number() OVER (PARTITION BY {keys} ORDER BY d DESC) AS r
           FROM {source} WHERE d <= (SELECT t FROM bounds)),
step0 AS (SELECT {keys}, d, sales FROM ranked WHERE r <= 60)"""]
    match = " AND ".join(f"s.{k.strip()} = f.{k.strip()}" for k in keys.split(","))
    for h in range(1, 29):
        parts.append(f"""
next{h} AS (SELECT {keys}, d, CAST(NULL AS DOUBLE) AS sales FROM {source} WHERE d = (SELECT t + {h} FROM bounds)),
all{h} AS (SELECT * FROM step{h - 1} UNION ALL SELECT * FROM next{h}),""" + features_sql(f"all{h}", keys, f"f{h}") + f""",
step{h} AS (SELECT * FROM step{h - 1} UNION ALL
  SELECT {', '.join('f.' + k.strip() for k in keys.split(','))}, f.d, {factor} * ({linear})
  FROM f{h} f JOIN {source} s ON {match} AND s.d = f.d WHERE f.d = (SELECT t + {h} FROM bounds))""")
    # each step feeds the next several times, so it is kept
    return [p.replace(" AS (SELECT * FROM step", " AS MATERIALIZED (SELECT * FROM step") for p in parts]


@query("recursive_forecast", with_panel("brand", "kept AS MATERIALIZED (SELECT id, d, sales, rate FROM grid)",
                                        *recursion_sql("kept", "id", "coalesce(s.rate, 1.0)")) + """
SELECT id, d, round(sales, 6) AS sales FROM step28 WHERE d > (SELECT t FROM bounds)""")
def recursive_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-level recursion of a linear model: four rounds of seven days."""
    grid = panel_grid(spark, sf_dir).select("id", "d", "sales", "rate")
    forecast = recursive_forecast(grid, _linear, panel_horizon(spark, sf_dir).train_last)
    return forecast.select("id", "d", r6("sales"))


@query("recursive_in_partition", with_panel("brand", "kept AS MATERIALIZED (SELECT id, d, sales, rate FROM grid)",
                                            *recursion_sql("kept", "id", "coalesce(s.rate, 1.0)")) + """
SELECT id, d, round(sales, 6) AS sales FROM step28 WHERE d > (SELECT t FROM bounds)""")
def recursive_in_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursion of a linear model with all steps of a series in one task."""
    grid = panel_grid(spark, sf_dir).select("id", "d", "sales", "rate")
    forecast = recursive_forecast_in_partition(grid, LinearModel(COEFFICIENTS), panel_horizon(spark, sf_dir).train_last)
    return forecast.select("id", "d", r6("sales"))


@query("wrmsse_recursive", with_panel(
    "brand", "kept AS MATERIALIZED (SELECT id, d, sales, rate FROM grid)", *recursion_sql("kept", "id", "coalesce(s.rate, 1.0)"), *SCORE_SQL[:-1], """
rerrs AS (SELECT i.*, f.d - t AS h, 'recursive' AS model, coalesce(s.sales, 0.0) - f.sales AS error
          FROM step28 f JOIN ids i ON i.id = f.id CROSS JOIN bounds
          LEFT JOIN sales s ON s.id = f.id AND s.d = f.d WHERE f.d > t)""", *scores_sql("rerrs")) + """
SELECT level, round(score, 6) AS score FROM scores""")
def wrmsse_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recursion's own forecasts against the days held out, on every level."""
    horizon, history, earned = score_history(spark, sf_dir, "brand")
    grid = panel_grid(spark, sf_dir).select(*KEYS, "d", "sales", "rate")
    forecast = recursive_forecast_in_partition(grid, LinearModel(COEFFICIENTS), horizon.train_last, keys=KEYS)
    forecast = forecast.withColumnRenamed("sales", "yhat")
    truth = panel_sales(spark, sf_dir, "brand").filter(F.col("d") > horizon.train_last).select("id", "d", "sales")
    errors = forecast.join(truth, ["id", "d"], "left").select(
        *KEYS, (F.col("d") - horizon.train_last).alias("h"), (F.coalesce("sales", F.lit(0.0)) - F.col("yhat")).alias("error")
    )
    scores = weighted_scores(history, errors, earned, horizon.train_last, tasks=panel_tasks(spark, sf_dir))
    return scores.select("level", r6("score"))


ALPHAS = [1.035, 1.03, 1.025]


@query("alpha_ensemble", with_panel("brand", "kept AS MATERIALIZED (SELECT id, d, sales, alpha FROM grid CROSS JOIN "
                                    "(VALUES (1.035::DOUBLE), (1.03::DOUBLE), (1.025::DOUBLE)) a(alpha))",
                                    *recursion_sql("kept", "alpha, id", "s.alpha")) + """
SELECT id, d, round(list_reduce(list_sort(list(sales)), lambda a, b: a + b) / count(*), 6) AS sales
FROM step28 WHERE d > (SELECT t FROM bounds) GROUP BY id, d""")
def alpha_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three recursions with their own multipliers in the same tasks, then averaged."""
    runs = recursive_forecast_in_partition(
        panel_grid(spark, sf_dir, rate=False).select("id", "d", "sales"), LinearModel(COEFFICIENTS),
        panel_horizon(spark, sf_dir).train_last, multipliers=ALPHAS,
    )
    return average_runs(runs).select("id", "d", r6("sales"))


# --- MLlib models ------------------------------------------------------------

def _training(spark: SparkSession, sf_dir: str):
    """Features with the share of the store and department, split at the horizon."""
    horizon = panel_horizon(spark, sf_dir)
    table = panel_features(spark, sf_dir)
    history = table.filter(F.col("d") <= horizon.train_last)
    weighted = history.withColumn("recency", F.col("d") / F.lit(float(horizon.train_last)))
    return horizon, table, weighted


def _calibration(scored: DataFrame, label: str) -> DataFrame:
    """Actual and predicted means and the error per department."""
    square = F.pow(F.col(label) - F.col("prediction"), F.lit(2.0))
    return scored.groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(label), 4).alias("actual"),
        F.round(F.avg("prediction"), 4).alias("predicted"), F.round(F.sqrt(F.avg(square)), 4).alias("rmse"),
    )


def _fit_volume(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    """Fitted on all days but the last 28 of the history, which it is measured on."""
    horizon, _, history = _training(spark, sf_dir)
    history = cut_lineage(history.select("d", "sales", "recency", *NUMERIC, *SMALL).na.fill(UNKNOWN, subset=LAGGED))
    cut = horizon.train_last - horizon.steps
    model = train(history.filter(F.col("d") <= cut), estimator, NUMERIC, SMALL)
    return _calibration(model.transform(history.filter(F.col("d") > cut)), "sales")


@query("train_volume")
def train_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poisson model of item volumes, weighted by recency."""
    return _fit_volume(spark, sf_dir, poisson_model(weight="recency"))


def categories_sql(rows: str, value: str) -> str:
    """Actual means per category; those of a fit with a canonical link must be the same."""
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, count(*) AS n, round({value}, 4) AS actual, round({value}, 4) AS predicted "
        f"FROM {rows} GROUP BY {c}" for c in SERIES_KEYS
    )


def _category_means(scored: DataFrame, label: str, weight: str) -> DataFrame:
    """Weighted actual and predicted mean of every department and of every store."""
    sums = scored.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"),
        F.sum(F.col(weight) * F.col(label)).alias("actual"), F.sum(F.col(weight) * F.col("prediction")).alias("predicted"),
    )
    each = sums.unpivot(["n", "w", "actual", "predicted"], SERIES_KEYS, "feature", "category")
    return each.groupBy("feature", "category").agg(
        F.sum("n").alias("n"), F.round(F.sum("actual") / F.sum("w"), 4).alias("actual"),
        F.round(F.sum("predicted") / F.sum("w"), 4).alias("predicted"),
    )


@query("volume_by_category", with_panel("brand", """
weighted AS (SELECT dept_id, store_id, sales, d / CAST(t AS DOUBLE) AS w FROM grid, bounds WHERE d <= t)""")
       + categories_sql("weighted", "sum(w * sales) / sum(w)"))
def volume_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Poisson model with next to no penalty: its weighted means per category are those of its training rows."""
    _, _, history = _training(spark, sf_dir)
    history = cut_lineage(history.select("sales", "recency", *LAGGED, *SERIES_KEYS).na.fill(UNKNOWN, subset=LAGGED))
    model = train(history, unpenalised(poisson_model(weight="recency")), LAGGED, SERIES_KEYS)
    return _category_means(model.transform(history), "sales", "recency")


@query("train_tweedie")
def train_tweedie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_volume(spark, sf_dir, tweedie_model(weight="recency"))


def share_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of item shares: lags and means are taken over the shares, as the model predicts those."""
    grid = panel_grid(spark, sf_dir, rate=False)
    shares = share_of_total(grid, ["dept_id", "store_id", "d"], "sales", "share")
    return series_features(shares.drop("sales").withColumnRenamed("share", "sales"), ["id"])


@query("train_share")
def train_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy model of item shares."""
    rows, numeric = share_history(spark, sf_dir), [*LAGGED, "sell_price"]
    model = train(rows, share_model(label="sales"), numeric, SMALL, unknown=UNKNOWN)
    return _calibration(predictor(model, numeric=numeric)(rows), "sales")


@query("share_by_category", with_panel("brand", """
shared AS (
  SELECT dept_id, store_id, sales / nullif(sum(sales) OVER (PARTITION BY dept_id, store_id, d), 0) AS share
  FROM grid, bounds WHERE d <= t)""")
       + categories_sql("(SELECT * FROM shared WHERE share IS NOT NULL)", "avg(share)"))
def share_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share model with next to no penalty: its means per category are those of its training rows."""
    rows = share_history(spark, sf_dir).na.fill(UNKNOWN, subset=LAGGED).withColumn("one", F.lit(1.0))
    model = train(rows, unpenalised(share_model(label="sales")), LAGGED, SERIES_KEYS)
    return _category_means(model.transform(rows), "sales", "one")


def share_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows with a known share."""
    rows = share_features(spark, sf_dir).filter(F.col("sales").isNotNull())
    return cut_lineage(rows.select("sales", *LAGGED, "sell_price", *SMALL))


@query("recursive_model")
def recursive_model(spark: SparkSession, sf_dir: str, rounds: int = 20) -> DataFrame:
    """Item-level recursion of the average of a Poisson and a tree model, times the growth rate."""
    horizon = panel_horizon(spark, sf_dir)
    grid = cut_lineage(panel_grid(spark, sf_dir).withColumn("mday", F.dayofmonth("date")))
    history = cut_lineage(
        series_features(grid, ["id"]).filter(F.col("d") <= horizon.train_last).select("sales", *NUMERIC, *SMALL)
    )
    models = [train(history, e, NUMERIC, SMALL, unknown=UNKNOWN) for e in (poisson_model(), tree_model(rounds=rounds))]
    forecast = recursive_forecast(grid, predictor(*models, numeric=NUMERIC), horizon.train_last)
    return forecast.select("id", "d", r6("sales"))


@query("recursive_share")
def recursive_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursion of a share model; the shares of each new day add up to 1."""
    horizon = panel_horizon(spark, sf_dir)
    numeric = [*LAGGED, "sell_price"]
    model = train(share_history(spark, sf_dir), share_model(label="sales"), numeric, SMALL, unknown=UNKNOWN)
    grid = panel_grid(spark, sf_dir, rate=False)
    shares = share_of_total(grid, ["dept_id", "store_id", "d"], "sales", "share")
    shares = shares.drop("sales").withColumnRenamed("share", "sales")
    forecast = recursive_forecast(shares, predictor(model, numeric=numeric), horizon.train_last, share=True)
    return forecast.select("id", "dept_id", "store_id", "d", r6("sales", "share"))


@query("recursive_share_sums", with_panel("brand") + """
SELECT i.dept_id, i.store_id, t + h AS d, count(*) AS items, 1.0 AS share
FROM ids i JOIN (SELECT DISTINCT store_id, item_id FROM prices) p ON p.store_id = i.store_id AND p.item_id = i.item_id
CROSS JOIN steps CROSS JOIN bounds GROUP BY ALL""")
def recursive_share_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every priced item has a forecast share on every day, and those of a store and department add up to 1."""
    sums = recursive_share(spark, sf_dir).groupBy("dept_id", "store_id", "d").agg(F.count("id").alias("items"), F.sum("share").alias("share"))
    # each share comes rounded to six places
    return sums.withColumn("share", F.round("share", 3))


@query("topdown_volume")
def topdown_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store and department volumes: a Poisson model over lags of the totals, run recursively, one row per series."""
    horizon = panel_horizon(spark, sf_dir)
    sales = panel_sales(spark, sf_dir)
    days = dept_days(sales, horizon.last).withColumn("sales", F.when(F.col("d") <= horizon.train_last, F.col("sales")))
    rated = cut_lineage(days.join(panel_rates(sales, horizon), SERIES_KEYS))
    history = series_features(rated, SERIES_KEYS).filter(F.col("d") <= horizon.train_last)
    model = train(history, poisson_model(), LAGGED, SERIES_KEYS, unknown=UNKNOWN)
    forecast = recursive_forecast(rated, predictor(model, numeric=LAGGED), horizon.train_last, keys=SERIES_KEYS)
    wide = pivot_steps(forecast.withColumn("h", F.col("d") - horizon.train_last), SERIES_KEYS, "sales")
    return wide.select(*SERIES_KEYS, *[r6(c) for c in wide.columns[2:]])


@query("share_model")
def softmax_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial model of item shares by store, weekday and quarter, over the days of the horizon."""
    horizon = panel_horizon(spark, sf_dir)
    calendar = panel_calendar(spark, sf_dir).select("d", "wday", F.quarter("date").alias("quarter"))
    dated = panel_sales(spark, sf_dir, "brand").join(calendar, "d").filter(F.col("d") <= horizon.train_last)
    attributes = ["store_id", "wday", "quarter"]
    model, items = softmax_share_model(dated, "item_id", "sales", attributes)
    ahead = calendar.filter(F.col("d") > horizon.train_last)
    stores = dated.select("store_id").distinct().withColumn(
        "d", F.explode(F.sequence(F.lit(horizon.train_last + 1), F.lit(horizon.last)))
    )
    rows = stores.join(ahead, "d").withColumn("item_id", F.lit(items[0]))
    scored = model.transform(rows).select("store_id", "d", vector_to_array("probability").alias("p"))
    each = scored.select("store_id", "d", F.posexplode("p").alias("i", "share"))
    named = each.withColumn("item_id", F.element_at(F.array(*[F.lit(x) for x in items]), F.col("i") + 1))
    named = named.withColumn("dept_id", F.substring_index("item_id", "_", 1))
    return renormalise(named).select("item_id", "store_id", "d", r6("share"))


@query("model_roundtrip", with_panel("part", features_sql("(SELECT dept.* FROM dept, bounds WHERE d <= t)", "store_id, dept_id")) + f"""
SELECT dept_id, count(*) AS n, round(avg(sales), 4) AS actual, 0 AS changed FROM feats
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in LAGGED)} GROUP BY dept_id""")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model saved, loaded and used again: how many predictions the trip changed."""
    horizon = panel_horizon(spark, sf_dir)
    days = dept_days(panel_sales(spark, sf_dir), horizon.train_last)
    rows = cut_lineage(series_features(days, SERIES_KEYS).na.drop("any"))
    path = scratch_path(spark, "model")
    model = train(rows, poisson_model(), LAGGED, SERIES_KEYS)
    model.write().save(path)
    fitted = model.transform(rows).withColumnRenamed("prediction", "before").select(*rows.columns, "before")
    both = PipelineModel.load(path).transform(fitted)
    return both.groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("sales"), 4).alias("actual"),
        F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("changed"),
    )


# Settings of the global model: every depth with every number of rounds.
DEPTHS, ROUNDS = [3, 4, 5, 6], 24


@query("tune_global")
def tune_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree model's depth and rounds, 96 settings, measured on the last 28 days."""
    horizon = panel_horizon(spark, sf_dir)
    days = dept_days(panel_sales(spark, sf_dir), horizon.train_last)
    rows = series_features(days, SERIES_KEYS)
    held = F.col("d") > horizon.train_last - horizon.steps
    results = tune_rounds(rows, DEPTHS, ROUNDS, LAGGED, SERIES_KEYS, held=held)
    named = [(f"maxDepth={depth}, maxIter={rounds}", rmse) for depth, rounds, rmse in results]
    return spark.createDataFrame(named, "params string, rmse double")


@query("feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    horizon = panel_horizon(spark, sf_dir)
    days = dept_days(panel_sales(spark, sf_dir), horizon.train_last)
    rows = cut_lineage(series_features(days, SERIES_KEYS).na.drop("any"))
    return spark.createDataFrame(importances(train(rows, tree_model(), LAGGED, SERIES_KEYS), rows), "feature string, importance double")


# --- one model per series ----------------------------------------------------

# Parameter sets tried per series.
TRIALS = 100


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = panel_calendar(spark, sf_dir).select("d", F.col("event_name_1").alias("event"))
    return store_dept_table(spark, sf_dir).join(events, "d")


@query("per_series_forecast")
def per_series_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each store and department forecast by its own regression with default parameters."""
    return forecast_series(_series(spark, sf_dir), panel_horizon(spark, sf_dir).train_last)


@query("cv_rmsse")
def cv_rmsse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled error of that regression on the last four weeks of history."""
    scored = score_candidates(_series(spark, sf_dir), [{}], panel_horizon(spark, sf_dir).train_last)
    return scored.select(*SERIES_KEYS, r6("rmsse"))


@query("tune_per_series")
def tune_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of a hundred parameter sets for every series."""
    scored = score_candidates(_series(spark, sf_dir), random_candidates(TRIALS, seed=3), panel_horizon(spark, sf_dir).train_last)
    best = scored.groupBy(*SERIES_KEYS).agg(F.min(F.struct(r6("rmsse"), "candidate")).alias("b"))
    return best.select(*SERIES_KEYS, "b.candidate", "b.rmsse")


@query("tune_by_halving")
def tune_by_halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameter set of every series by successive halving, from three times as many as the full search has."""
    series, end = cut_lineage(_series(spark, sf_dir)), panel_horizon(spark, sf_dir).train_last
    score = series_scorer(series, random_candidates(3 * TRIALS, seed=3), end, SERIES_KEYS)
    best = winners(successive_halving(series, 3 * TRIALS, score, SERIES_KEYS), SERIES_KEYS)
    return best.select(*SERIES_KEYS, "candidate", r6("score", "rmsse"))


@query("seasonal_regression")
def seasonal_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series tuned, then forecast with its own parameters, one column per step."""
    horizon = panel_horizon(spark, sf_dir)
    series = cut_lineage(_series(spark, sf_dir))
    candidates = random_candidates(TRIALS, seed=3)
    scored = score_candidates(series, candidates, horizon.train_last)
    best = scored.groupBy(*SERIES_KEYS).agg(F.min_by("candidate", F.struct("rmsse", "candidate")).alias("candidate"))
    options = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in c.items()]) for c in candidates])
    tuned = series.join(best.select(*SERIES_KEYS, options[F.col("candidate")].alias("params")), SERIES_KEYS)
    forecast = forecast_series(tuned, horizon.train_last, params="params")
    return pivot_steps(forecast.withColumn("h", F.col("d") - horizon.train_last), SERIES_KEYS, "yhat")


def _trended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted and forecast totals of each store and department, with sparse trend changes and holiday windows."""
    events = panel_calendar(spark, sf_dir).select("d", F.col("event_name_1").alias("event"))
    series = holiday_windows(store_dept_table(spark, sf_dir), events)
    return trend_forecast(series, panel_horizon(spark, sf_dir).train_last)


@query("trend_intervals")
def trend_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of the horizon with the bounds of four fifths of the simulated futures."""
    ahead = _trended(spark, sf_dir).filter(F.col("d") > panel_horizon(spark, sf_dir).train_last)
    return ahead.select(*SERIES_KEYS, "d", r6("yhat"), r6("low"), r6("high"))


@query("trend_law", with_panel("brand", STORE_DEPT_SQL) + """
SELECT store_id, dept_id, count(*) AS n, round(avg(y), 4) AS actual, round(avg(y), 4) AS fitted,
       round(sum(d * y) / sum(d), 4) AS actual_by_day, round(sum(d * y) / sum(d), 4) AS fitted_by_day
FROM store_dept, bounds WHERE d <= t GROUP BY ALL""")
def trend_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level and slope have no penalty, so fitted days add up to the actual ones, plain and weighted by day."""
    past = _trended(spark, sf_dir).filter(F.col("d") <= panel_horizon(spark, sf_dir).train_last)
    by_day = lambda c: F.sum(F.col("d") * F.col(c)) / F.sum("d")
    return past.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("y"), 4).alias("actual"), F.round(F.avg("yhat"), 4).alias("fitted"),
        F.round(by_day("y"), 4).alias("actual_by_day"), F.round(by_day("yhat"), 4).alias("fitted_by_day"),
    )
