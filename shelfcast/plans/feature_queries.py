"""Queries over group totals, shares, windows, samples and model features."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.functions.dates import date_parts, fourier_terms
from shelfcast.operators.aggregates import (
    cardinality, null_profile, share_of_total, standardised, store_dept_series, target_means,
)
from shelfcast.operators.joins import with_calendar, with_rate
from shelfcast.operators.projection import mask_from, pick_by_group
from shelfcast.operators.sampling import sample_rows, sample_stratified, sample_weighted, sample_with_replacement
from shelfcast.operators.topdown import renormalise
from shelfcast.operators.windows import (
    age, amplitude_weight, growth_rates, lag_columns, last_days, recency_weight, series_features,
    with_rolling_means,
)
from shelfcast.plans.panel import (
    BASELINES, SERIES_KEYS, baseline_forecasts, dept_days, panel_calendar, panel_grid, panel_horizon, panel_rates,
    panel_sales,
)
from shelfcast.plans.panel_sql import with_panel
from shelfcast.plans.registry import query, r6
from shelfcast.sources.schemas import SEASONAL_PARAMS

ROLLED = {f"rmean_{k}_{n}": (k, n) for n in (7, 28) for k in (7, 28)}


def features_sql(source: str, keys: str, name: str = "feats") -> str:
    """Lags, and rolling means taken over the lag columns in a second step."""
    rolls = ", ".join(
        f"CASE WHEN count(lag_{k}) OVER w{n} = {n} THEN avg(lag_{k}) OVER w{n} END AS {c}" for c, (k, n) in ROLLED.items()
    )
    return f"""
{name} AS (
  SELECT *, {rolls}
  FROM (SELECT *, lag(sales, 7) OVER w AS lag_7, lag(sales, 28) OVER w AS lag_28
        FROM {source} WINDOW w AS (PARTITION BY {keys} ORDER BY d))
  WINDOW w7 AS (PARTITION BY {keys} ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
         w28 AS (PARTITION BY {keys} ORDER BY d ROWS BETWEEN 27 PRECEDING AND CURRENT ROW))"""


ROUND_ROLLED = ", ".join(f"round({c}, 6) AS {c}" for c in ROLLED)


# --- the grid and its features -----------------------------------------------

@query("grid", with_panel("part") + """
SELECT id, d, date, sales, wm_yr_wk, event_name_1, snap_A, snap_B, round(sell_price, 6) AS sell_price, round(rate, 6) AS rate FROM grid""")
def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales, calendar, prices and growth rate per item, store and day, with a masked horizon."""
    return panel_grid(spark, sf_dir, "part").select(
        "id", "d", "date", "sales", "wm_yr_wk", "event_name_1", "snap_A", "snap_B", r6("sell_price"), r6("rate")
    )


@query("features", with_panel("part", features_sql("grid", "id")) + f"""
SELECT id, d, sales, lag_7, lag_28, {ROUND_ROLLED}, wday, CAST(weekofyear(date) AS SMALLINT) AS week, month,
       CAST(quarter(date) AS SMALLINT) AS quarter, year, CAST(day(date) AS SMALLINT) AS mday FROM feats""")
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags, rolling means and calendar parts of the grid; the calendar's own columns are kept."""
    table = panel_features(spark, sf_dir, "part")
    return table.select(
        "id", "d", "sales", "lag_7", "lag_28", *[r6(c) for c in ROLLED],
        "wday", "week", "month", "quarter", "year", "mday",
    )


def panel_features(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    base = panel_grid(spark, sf_dir, grain)
    parts = [c.alias(name) for name, c in date_parts("date").items() if name not in base.columns]
    return series_features(base.select("*", *parts), ["id"])


@query("lags", with_panel("part", features_sql("grid", "id")) + "SELECT id, d, lag_7, lag_28 FROM feats")
def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = panel_grid(spark, sf_dir, "part", rate=False)
    return base.select("id", "d", *[c.alias(n) for n, c in lag_columns(["id"], "d", "sales").items()])


@query("rolling_means", with_panel("part", features_sql("grid", "id")) + f"SELECT id, d, {ROUND_ROLLED} FROM feats")
def rolling_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = panel_grid(spark, sf_dir, "part", rate=False)
    return with_rolling_means(base, ["id"], "d", "sales").select("id", "d", *[r6(c) for c in ROLLED])


@query("rolling_means_dept", with_panel("part", features_sql("dept", "store_id, dept_id")) + f"""
SELECT f.store_id, f.dept_id, d, sales, lag_7, lag_28, {ROUND_ROLLED}, round(rate, 6) AS rate
FROM feats f LEFT JOIN rates r ON r.dept_id = f.dept_id AND r.store_id = f.store_id""")
def rolling_means_dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags, rolling means and growth rate of each store and department."""
    horizon = panel_horizon(spark, sf_dir)
    days = dept_days(panel_sales(spark, sf_dir), horizon.last)
    rates = growth_rates(days.filter(F.col("d") <= horizon.train_last), horizon.train_last)
    table = with_rate(series_features(days, SERIES_KEYS), rates)
    return table.select("store_id", "dept_id", "d", "sales", "lag_7", "lag_28", *[r6(c) for c in ROLLED], r6("rate"))


# --- aggregates --------------------------------------------------------------

@query("dept_sales", with_panel("part") + "SELECT store_id, dept_id, d, sum(sales) AS sales FROM sales GROUP BY ALL")
def dept_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_sales(spark, sf_dir).groupBy("store_id", "dept_id", "d").agg(F.sum("sales").alias("sales"))


STORE_DEPT_SQL = """
store_dept AS (
  SELECT store_id, dept_id, d, max(date) AS ds, sum(sales) AS y,
         max(CASE state_id WHEN 'A' THEN snap_A ELSE snap_B END) AS snap, max(sell_price) AS price,
         CAST(max(day(date)) AS TINYINT) AS dom
  FROM grid GROUP BY ALL)"""


def store_dept_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals with snap, top price and day of month; no target in the horizon."""
    grid = panel_grid(spark, sf_dir, rate=False)
    snap = pick_by_group("state_id", {"A": "snap_A"}, "snap_B").cast("int")
    series = store_dept_series(grid.withColumn("snap", snap))
    return series.withColumn("y", mask_from("y", "d", panel_horizon(spark, sf_dir).train_last + 1))


@query("store_dept_series", with_panel("brand", STORE_DEPT_SQL) + """
SELECT store_id, dept_id, d, ds, y, snap, round(price, 6) AS price, dom FROM store_dept""")
def store_dept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_dept_table(spark, sf_dir).withColumn("price", r6("price"))


@query("growth_rate", with_panel("part") + "SELECT dept_id, store_id, round(rate, 6) AS rate FROM rates")
def growth_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = panel_rates(panel_sales(spark, sf_dir), panel_horizon(spark, sf_dir))
    return rates.withColumn("rate", r6("rate"))


SUMMED = ["lag_7", "lag_28", *ROLLED, "sales"]


@query("topdown_features", with_panel("brand", features_sql("grid", "id")) + "SELECT dept_id, store_id, cat_id, state_id, d, "
       + ", ".join(f"round(coalesce(sum({c}), 0.0), 6) AS {c}" for c in SUMMED) + " FROM feats GROUP BY ALL")
def topdown_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item features added up per store and department; unknown ones count as 0."""
    table = series_features(panel_grid(spark, sf_dir, rate=False), ["id"])
    sums = [r6(F.coalesce(F.sum(c), F.lit(0.0)), c) for c in SUMMED]
    return table.groupBy("dept_id", "store_id", "cat_id", "state_id", "d").agg(*sums)


SHARE_SQL = """SELECT id, d, sales / nullif(sum(sales) OVER (PARTITION BY dept_id, store_id, d), 0){} FROM sales"""


@query("item_share", with_panel("part") + SHARE_SQL.format(" AS share"))
def item_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_of_total(panel_sales(spark, sf_dir), ["dept_id", "store_id", "d"]).select("id", "d", "share")


@query("item_share_pct", with_panel("part") + SHARE_SQL.format(" * 100 AS product_share"))
def item_share_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir)
    return share_of_total(sales, ["store_id", "dept_id", "d"], name="product_share", scale=100.0).select("id", "d", "product_share")


@query("renormalise_share", with_panel("part") + """
SELECT id, h, round((mean28 + 0.01) / sum(mean28 + 0.01) OVER (PARTITION BY dept_id, store_id, h), 6) AS share FROM base""")
def renormalise_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted shares scaled to add up to 1 per store, department and day."""
    predicted = baseline_forecasts(spark, sf_dir).withColumn("share", F.col("mean28") + 0.01)
    return renormalise(predicted, "share", "h").select("id", "h", r6("share"))


@query("series_keys", with_panel("part") + "SELECT DISTINCT store_id, dept_id, item_id FROM sales")
def series_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_sales(spark, sf_dir).select("store_id", "dept_id", "item_id").dropDuplicates()


PROFILED = ["item_id", "dept_id", "store_id", "cat_id", "state_id", "event_name_1", "event_type_1", "event_name_2"]
EVENTED_SQL = "evented AS (SELECT s.*, c.* EXCLUDE (d) FROM sales s JOIN cal c ON c.d = s.d)"


@query("feature_cardinality", with_panel("part", EVENTED_SQL)
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM evented" for c in PROFILED))
def feature_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cardinality(with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir)), PROFILED)


@query("null_profile", with_panel("part", EVENTED_SQL) + "SELECT "
       + ", ".join(f"count(*) FILTER ({c} IS NULL) AS nulls_{c}" for c in PROFILED) + " FROM evented")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir)), PROFILED)


@query("negative_count", with_panel("part") + """
SELECT dept_id, count(*) FILTER (mean28 * 2 - snaive7 < 0) AS n_negative, count(*) AS n FROM base GROUP BY dept_id""")
def negative_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    forecast = F.col("mean28") * 2 - F.col("snaive7")
    return baseline_forecasts(spark, sf_dir).groupBy("dept_id").agg(
        F.count_if(forecast < 0).alias("n_negative"), F.count(F.lit(1)).alias("n")
    )


# --- windows and weights -----------------------------------------------------

@query("last_n_days", with_panel("part") + "SELECT id, d, sales FROM sales WHERE d > (SELECT max(d) - 365 FROM sales)")
def last_n_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return last_days(panel_sales(spark, sf_dir).select("id", "d", "sales"), 365)


@query("age", with_panel("part") + "SELECT id, d, row_number() OVER (PARTITION BY id ORDER BY d) AS age FROM grid")
def series_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_grid(spark, sf_dir, "part", rate=False).select("id", "d", age("id", "d").alias("age"))


@query("recency_weight", with_panel("part") + """
SELECT id, d, d / (SELECT max(d) FROM sales) AS by_max, d / (SELECT sum(d) FROM sales) AS by_sum FROM sales""")
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir)
    return sales.select("id", "d", recency_weight(sales).alias("by_max"), recency_weight(sales, scale="sum").alias("by_sum"))


@query("sampling_prob", with_panel("part") + "SELECT id, d, sales / (SELECT sum(sales) FROM sales) AS p FROM sales")
def sampling_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir)
    return sales.select("id", "d", amplitude_weight(sales).alias("p"))


# --- sorts, top-k, samples ---------------------------------------------------

@query("sorted_grid", with_panel("part") + "SELECT id, d, sales FROM sales ORDER BY id, d")
def sorted_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_sales(spark, sf_dir).select("id", "d", "sales").orderBy("id", "d")


MODEL_RMSE_SQL = """
model_rmse AS (
  SELECT store_id, dept_id, model, round(sqrt(avg((truth - yhat) ** 2)), 6) AS rmse
  FROM (UNPIVOT (SELECT store_id, dept_id, truth, snaive7, snaive28, mean28 FROM base)
        ON snaive7, snaive28, mean28 INTO NAME model VALUE yhat) GROUP BY ALL)"""


def _model_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = baseline_forecasts(spark, sf_dir)
    long = base.unpivot(["store_id", "dept_id", "truth"], BASELINES, "model", "yhat")
    square = F.pow(F.col("truth") - F.col("yhat"), F.lit(2.0))
    return long.groupBy("store_id", "dept_id", "model").agg(r6(F.sqrt(F.avg(square)), "rmse"))


@query("worst_series", with_panel("part", MODEL_RMSE_SQL) + """
SELECT store_id, dept_id, rmse FROM model_rmse WHERE model = 'snaive7' ORDER BY rmse DESC, store_id, dept_id LIMIT 10""")
def worst_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten series that one model forecasts worst."""
    ranked = _model_rmse(spark, sf_dir).filter("model = 'snaive7'").select("store_id", "dept_id", "rmse")
    return ranked.orderBy(F.desc("rmse"), "store_id", "dept_id").limit(10)


@query("best_params", with_panel("part", MODEL_RMSE_SQL) + """
SELECT store_id, dept_id, arg_min(model, (rmse, model)) AS model, min(rmse) AS rmse FROM model_rmse GROUP BY ALL""")
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate with the smallest error of each series."""
    best = _model_rmse(spark, sf_dir).groupBy("store_id", "dept_id").agg(F.min(F.struct("rmse", "model")).alias("b"))
    return best.select("store_id", "dept_id", "b.model", "b.rmse")


UNIFORM = "(CAST('0x' || substr(md5(id || '|' || CAST(d AS VARCHAR) || '|{}'), 1, 8) AS BIGINT) / 4294967296.0)"

# Cumulative probabilities of Poisson(1).
POISSON_STEPS = [sum(math.exp(-1.0) / math.factorial(k) for k in range(n + 1)) for n in range(12)]


@query("sample_replacement", with_panel("part") + f"""
SELECT id, d, sales FROM (
  SELECT *, unnest(generate_series(1, {' + '.join(f'CAST(u >= {c!r} AS INTEGER)' for c in POISSON_STEPS)})) AS copy
  FROM (SELECT id, d, sales, {UNIFORM.format(19)} AS u FROM sales))""")
def sample_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows drawn with replacement."""
    return sample_with_replacement(panel_sales(spark, sf_dir).select("id", "d", "sales"), ["id", "d"], seed=19)



@query("holdout_sample", with_panel("part") + f"SELECT id, d, sales FROM sales ORDER BY {UNIFORM.format(11)}, id, d LIMIT 5000")
def holdout_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 5,000 rows without replacement."""
    return sample_rows(panel_sales(spark, sf_dir).select("id", "d", "sales"), 5000, ["id", "d"], seed=11)


@query("weighted_sample", with_panel("part") + f"""
SELECT id, d, sales FROM sales ORDER BY -ln({UNIFORM.format(5)} + 1.0 / 8589934592.0) / sales, id, d LIMIT 2000""")
def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 2,000 rows, drawn in proportion to sales."""
    sales = panel_sales(spark, sf_dir).select("id", "d", "sales")
    return sample_weighted(sales, 2000, F.col("sales"), ["id", "d"], seed=5)


@query("stratified_sample", with_panel("part") + f"""
SELECT id, d, sales FROM (SELECT *, count(*) OVER (PARTITION BY sales) AS n FROM sales) WHERE {UNIFORM.format(3)} < 20.0 / n""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About twenty rows of every distinct sales value."""
    return sample_stratified(panel_sales(spark, sf_dir).select("id", "d", "sales"), "sales", 20, ["id", "d"], seed=3)


# --- encodings and design columns --------------------------------------------

@query("target_encode", with_panel("part") + """
SELECT id, d, (s + 10 * m) / (n + 10) AS item_id_mean
FROM (SELECT id, d, sum(sales) OVER (PARTITION BY item_id) AS s, count(*) OVER (PARTITION BY item_id) AS n,
             (SELECT avg(sales) FROM sales) AS m FROM sales)""")
def target_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item as its mean sales, shrunk to the overall mean by ten pseudo-rows."""
    sales = panel_sales(spark, sf_dir).select("id", "item_id", "d", "sales")
    return sales.join(target_means(sales, "item_id", "sales", 10.0), "item_id").select("id", "d", "item_id_mean")


@query("standardise", with_panel("part") + """
SELECT id, d, round((sales - (SELECT avg(sales) FROM sales)) / (SELECT stddev_pop(sales) FROM sales), 6) AS sales,
       round((cents - (SELECT avg(cents) FROM sales)) / (SELECT stddev_pop(cents) FROM sales), 6) AS cents FROM sales""")
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = standardised(panel_sales(spark, sf_dir).select("id", "d", "sales", "cents"), ["sales", "cents"])
    return scaled.select("id", "d", r6("sales"), r6("cents"))


FOURIER = [("yearly", 365.25, 3), ("monthly", 365.25 / 12, 2), ("weekly", 7.0, 2)]


@query("fourier_features", with_panel("part") + "SELECT store_id, dept_id, d, "
       + ", ".join(f"round({fn}(2 * pi() * {k} / {period!r} * d), 6) + 0.0 AS {name}_{fn}_{k}"
                   for name, period, order in FOURIER for k in range(1, order + 1) for fn in ("sin", "cos"))
       + " FROM dept")
def fourier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal design columns of the daily store and department totals."""
    days = dept_days(panel_sales(spark, sf_dir), panel_horizon(spark, sf_dir).last)
    wide = days.select("store_id", "dept_id", "d", *[
        c for name, period, order in FOURIER for c in fourier_terms(F.col("d").cast("double"), period, order, name)
    ])
    return wide.select("store_id", "dept_id", "d", *[r6(c) for c in wide.columns[3:]])


# Every tuned field, computed from the size and the top of a series: (name, SQL type, expression that both engines read).
PARAM_FIELDS = [
    ("changepoint_range", "DOUBLE", "(70 + n % 31) / 100.0"),
    ("changepoint_prior_scale", "DOUBLE", "(top % 100 + 1) / 1000.0"),
    ("holidays_prior_scale", "DOUBLE", "(n % 200 + 1) / 10.0"),
    ("seasonality_mode", "VARCHAR", "CASE WHEN n % 2 = 0 THEN 'additive' ELSE 'multiplicative' END"),
    ("yearly_order", "INTEGER", "n % 20 + 1"),
    ("monthly_order", "INTEGER", "n % 5 + 1"),
    ("weekly_order", "INTEGER", "top % 7 + 1"),
    ("yearly_prior_scale", "DOUBLE", "top / 100.0"),
    ("monthly_prior_scale", "DOUBLE", "(top % 13 + 1) / 10.0"),
    ("weekly_prior_scale", "DOUBLE", "(n % 17 + 1) / 10.0"),
    ("snap_mode", "VARCHAR", "CASE WHEN n % 3 = 0 THEN 'additive' ELSE 'multiplicative' END"),
    ("price_mode", "VARCHAR", "CASE WHEN n % 5 < 2 THEN 'additive' ELSE 'multiplicative' END"),
    ("dom_mode", "VARCHAR", "CASE WHEN top % 2 = 0 THEN 'additive' ELSE 'multiplicative' END"),
]


@query("parse_params", with_panel("part") + "SELECT store_id, dept_id, "
       + ", ".join(f"CAST({e} AS {t}) AS {c}" for c, t, e in PARAM_FIELDS) + """
FROM (SELECT store_id, dept_id, count(*) AS n, CAST(max(sales) AS BIGINT) AS top FROM sales GROUP BY ALL)""")
def parse_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters kept as a dict literal with all fields, parsed by schema (the text is never evaluated)."""
    sizes = panel_sales(spark, sf_dir).groupBy("store_id", "dept_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("sales").cast("bigint").alias("top")
    )
    entries = [
        F.concat(F.lit(f"'{c}': "), F.concat(F.lit("'"), F.expr(e), F.lit("'")) if t == "VARCHAR" else F.expr(e).cast("string"))
        for c, t, e in PARAM_FIELDS
    ]
    literal = F.concat(F.lit("{"), F.array_join(F.array(*entries), ", "), F.lit("}"))
    parsed = F.from_json(literal, SEASONAL_PARAMS, {"allowSingleQuotes": "true"})
    rows = sizes.select("store_id", "dept_id", parsed.alias("p"))
    return rows.select("store_id", "dept_id", *[f"p.{c}" for c, _, _ in PARAM_FIELDS])
