"""Queries over fits and encodings whose cost does not grow with the number of items or columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators.aggregates import out_of_fold_means
from shelfcast.operators.loglinear import PRIOR, fit_shares, margin_gap, share_cells
from shelfcast.operators.projection import category_dictionary
from shelfcast.operators.refit import linear_score, poisson_fit, store_fit, stored_start
from shelfcast.operators.reshape import sparse_rows
from shelfcast.operators.windows import series_features
from shelfcast.functions.numeric import hashed_uniform
from shelfcast.plans.feature_queries import UNIFORM, features_sql
from shelfcast.plans.panel import SERIES_KEYS, dept_days, panel_calendar, panel_horizon, panel_sales, panel_tasks
from shelfcast.plans.panel_sql import with_panel
from shelfcast.plans.registry import query, r6
from shelfcast.session import cut_lineage, measured, scratch_path

CONTEXT = ["store_id", "wday", "quarter"]
FOLDS = 5


def _fitted_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item shares of a department by store, weekday and quarter, over all days before the horizon; single parts."""
    horizon = panel_horizon(spark, sf_dir)
    calendar = panel_calendar(spark, sf_dir).select("d", "wday", F.quarter("date").alias("quarter"))
    dated = panel_sales(spark, sf_dir).filter(F.col("d") <= horizon.train_last).join(calendar, "d")
    # dealt by item once: pairs, cells and the items' rows are made where the sales lie
    dealt = dated.repartition(panel_tasks(spark, sf_dir), "item_id")
    cells = share_cells(dealt, ["dept_id"], ["item_id", "store_id"], calendar.select("wday", "quarter").distinct())
    return fit_shares(cells, "item_id", ["dept_id"], [[c] for c in CONTEXT], CONTEXT)


@query("share_loglinear")
def share_loglinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A softmax over all parts of a department, for each store and day of the horizon."""
    horizon = panel_horizon(spark, sf_dir)
    ahead = panel_calendar(spark, sf_dir).filter(F.col("d") > horizon.train_last)
    days = ahead.select("d", "wday", F.quarter("date").alias("quarter"))
    return _fitted_shares(spark, sf_dir).join(days, ["wday", "quarter"]).select("item_id", "dept_id", "store_id", "d", r6("share"))


@query("share_loglinear_law", with_panel("part") + f"""
SELECT 'item' AS level, item_id AS name, round({1 + PRIOR} * sum(sales), 3) AS sold, 0.0 AS gap FROM sales, bounds WHERE d <= t GROUP BY ALL
UNION ALL
SELECT 'store', store_id, round({1 + PRIOR} * sum(sales), 3), 0.0 FROM sales, bounds WHERE d <= t GROUP BY ALL
UNION ALL
SELECT 'dept', dept_id, round({1 + PRIOR} * sum(sales), 3), 0.0 FROM sales, bounds WHERE d <= t GROUP BY ALL""")
def share_loglinear_law(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted and sold amounts agree on every item, store and department, to half a hundredth of each."""
    pairs = _fitted_shares(spark, sf_dir).groupBy("item_id", "store_id", "dept_id")
    fitted = measured(pairs.agg(F.sum("seen").alias("seen"), F.sum("fit").alias("fit")))
    levels = [
        margin_gap(fitted, [f"{level}_id"]).select(
            F.lit(level).alias("level"), F.col(f"{level}_id").alias("name"), F.round("seen", 3).alias("sold"),
            F.round(F.abs(F.col("fit") - F.col("seen")) / F.col("seen"), 2).alias("gap"),
        )
        for level in ("item", "store", "dept")
    ]
    return levels[0].unionByName(levels[1]).unionByName(levels[2])


LOGS = ["log_lag_7", "log_lag_28", "log_rmean_7_28"]


@query("refit_volume", with_panel("part", features_sql("(SELECT dept.* FROM dept, bounds WHERE d <= t)", "store_id, dept_id"), f"""
logs AS (SELECT sales, {", ".join(f"ln(1 + {c[4:]}) AS {c}" for c in LOGS)} FROM feats
         WHERE {" AND ".join(f"{c[4:]} IS NOT NULL" for c in LOGS)})""")
       + " UNION ALL ".join(
           f"SELECT '{name}' AS feature, count(*) AS n, round(avg({x} * sales), 4) AS actual, round(avg({x} * sales), 4) AS fitted FROM logs"
           for name, x in [("(intercept)", "1"), *[(c, c) for c in LOGS]]))
def refit_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes fitted four weeks ago, stored, and refitted with the new days from there.

    At the maximum, sales and fitted sales have equal products with every feature.
    """
    horizon = panel_horizon(spark, sf_dir)
    days = series_features(dept_days(panel_sales(spark, sf_dir), horizon.train_last), SERIES_KEYS)
    rows = cut_lineage(days.select("d", "sales", *[F.log1p(c[4:]).alias(c) for c in LOGS]).na.drop("any"))
    path = scratch_path(spark, "fit")
    earlier = rows.filter(F.col("d") <= horizon.train_last - horizon.steps)
    store_fit(spark, path, LOGS, poisson_fit(earlier, LOGS, "sales"))
    fit = poisson_fit(rows, LOGS, "sales", stored_start(spark, path, LOGS))
    scored = rows.withColumn("_fitted", F.exp(linear_score(LOGS, fit.coefficients)))
    products = F.array(*[
        F.struct(F.lit(name).alias("feature"), x.alias("x")) for name, x in [("(intercept)", F.lit(1.0)), *[(c, F.col(c)) for c in LOGS]]
    ])
    each = scored.select("sales", "_fitted", F.explode(products).alias("p"))
    return each.groupBy(F.col("p.feature").alias("feature")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("p.x") * F.col("sales")), 4).alias("actual"),
        F.round(F.avg(F.col("p.x") * F.col("_fitted")), 4).alias("fitted"),
    )


@query("out_of_fold_encode", with_panel("part", f"""
folded AS (SELECT id, item_id, d, sales, CAST(floor({UNIFORM.format(23)} * {FOLDS}) AS INTEGER) AS fold FROM sales)""") + """
SELECT id, d, round((s + 10 * prior) / (n + 10), 6) AS item_id_mean FROM (
  SELECT id, d, sum(sales) OVER i - sum(sales) OVER c AS s, count(*) OVER i - count(*) OVER c AS n,
         (sum(sales) OVER () - sum(sales) OVER f) / (count(*) OVER () - count(*) OVER f) AS prior
  FROM folded WINDOW i AS (PARTITION BY item_id), c AS (PARTITION BY item_id, fold), f AS (PARTITION BY fold))""")
def out_of_fold_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item as its mean sales in the folds that the row is not in, shrunk by ten pseudo-rows."""
    sales = panel_sales(spark, sf_dir).select("id", "item_id", "d", "sales")
    fold = F.floor(hashed_uniform("id", "d", seed=23) * FOLDS).cast("int")
    return out_of_fold_means(sales, "item_id", "sales", fold, 10.0).select("id", "d", r6("item_id_mean"))


@query("sparse_matrix", with_panel("part", """
codes AS (SELECT item_id, CAST(row_number() OVER (ORDER BY item_id) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT item_id FROM sales))""") + """
SELECT store_id, d, code // 4096 AS block, count(*) AS cells,
       string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS indices, string_agg(CAST(CAST(sales AS BIGINT) AS VARCHAR), ',' ORDER BY code) AS cell_values
FROM sales JOIN codes ON codes.item_id = sales.item_id GROUP BY ALL""")
def sparse_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per store and day, a column per part: sparse, in blocks of columns."""
    sales = measured(panel_sales(spark, sf_dir).select("store_id", "item_id", "d", "sales"))
    rows = sparse_rows(sales, ["store_id", "d"], "item_id", measured(category_dictionary(sales, ["item_id"])), "sales")
    return rows.select(
        "store_id", "d", F.col("block").cast("long").alias("block"), F.size("indices").cast("long").alias("cells"),
        F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
        F.array_join(F.col("values").cast("array<bigint>").cast("array<string>"), ",").alias("cell_values"),
    )
