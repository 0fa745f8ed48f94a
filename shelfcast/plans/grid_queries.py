"""Queries over sources, the grid, reshaping, joins and projections."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.functions.dates import date_parts, is_weekend, parse_day, week_of_month
from shelfcast.functions.numeric import hashed_uniform, round_count
from shelfcast.functions.text import has_label, relabel, series_key, split_series_key, with_label
from shelfcast.operators.joins import (
    hashed_holdout, join_models, update_join, with_calendar, with_prices, with_prices_left, with_rate, without,
)
from shelfcast.operators.ordering import order_like, ranged_index
from shelfcast.operators.projection import (
    CATEGORICAL, distinct_values, cast_features, category_dictionary, encode_categories, feature_columns,
    mask_from, one_hot, pick_by_group, rename_steps, temporal_split, tight_types, trailing_slice,
)
from shelfcast.operators.reshape import (
    dual_label, future_rows, horizon_label, item_matrix, melt_days, melt_steps, pivot_steps, wide_lines,
)
from shelfcast.operators.windows import rolling_columns
from shelfcast.plans.panel import (
    BASELINES, KEYS, baseline_forecasts, horizon_forecasts, panel_calendar, panel_dense, panel_grid, panel_horizon, panel_prices,
    panel_rates, panel_sales, recent_series, table, week_of,
)
from shelfcast.plans.panel_sql import with_panel
from shelfcast.plans.registry import query, r6
from shelfcast.session import measured, scratch_path
from shelfcast.sources.files import (
    nan_to_null, read_csv, read_csv_glob, read_table, read_wide, write_csv, write_forecasts, write_lines, write_table,
)
from shelfcast.sources.schemas import SALES_KEYS

UNIFORM = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) / 4294967296.0"
F28 = ", ".join(f"round(avg(CASE WHEN h = {i} THEN v END), 6) AS F{i}" for i in range(1, 29))


# --- sources and sinks -------------------------------------------------------

PRICE_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()), T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.ShortType()), T.StructField("sell_price", T.DoubleType()),
])


@query("scan_csv_typed", with_panel("part") + """
SELECT store_id, item_id, wm_yr_wk, round(sell_price, 6) AS sell_price FROM prices""")
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written to CSV and scanned back with an explicit schema."""
    path = write_csv(panel_prices(panel_sales(spark, sf_dir), panel_horizon(spark, sf_dir)), scratch_path(spark, "prices"))
    return read_csv(spark, path, PRICE_SCHEMA).select("store_id", "item_id", "wm_yr_wk", r6("sell_price"))


@query("scan_pruned", """
SELECT l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_shipdate >= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 365""")
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns and a trailing day range; both reach the Parquet scan."""
    horizon = panel_horizon(spark, sf_dir)
    first = horizon.date_of(horizon.last) - timedelta(days=365)
    lines = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") >= F.lit(first).cast("timestamp_ntz"))
    return lines.select("l_partkey", "l_suppkey", "l_quantity")


@query("scan_limit", with_panel("part") + """
SELECT id, d, sales FROM sales ORDER BY d, id LIMIT 1000""")
def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows, in a stated order so that they are always the same."""
    return panel_sales(spark, sf_dir).select("id", "d", "sales").orderBy("d", "id").limit(1000)


@query("scan_dates", with_panel("part") + "SELECT date, d, weekday FROM cal")
def scan_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar dates written in another format and parsed by the scan."""
    calendar = panel_calendar(spark, sf_dir).select(F.date_format("date", "dd.MM.yyyy").alias("date"), "d", "weekday")
    path = write_csv(calendar, scratch_path(spark, "calendar"))
    schema = T.StructType([
        T.StructField("date", T.DateType()), T.StructField("d", T.IntegerType()), T.StructField("weekday", T.StringType()),
    ])
    return read_csv(spark, path, schema, date_format="dd.MM.yyyy")


@query("parquet_roundtrip", with_panel("part") + "SELECT id, item_id, dept_id, store_id, d, sales, cents FROM sales")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written as a table partitioned by store, and read back."""
    path = write_table(panel_sales(spark, sf_dir), scratch_path(spark, "panel"), ["store_id"])
    return read_table(spark, path).select("id", "item_id", "dept_id", "store_id", "d", "sales", "cents")


def _baseline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_forecasts(spark, sf_dir).select("id", "h", *BASELINES).unpivot(
        ["id", "h"], BASELINES, "model", "yhat"
    )


@query("scan_glob", with_panel("part") + """
SELECT model, id, h, round(yhat, 6) AS yhat
FROM (UNPIVOT (SELECT id, h, snaive7, snaive28, mean28 FROM base) ON snaive7, snaive28, mean28 INTO NAME model VALUE yhat)""")
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of CSV files per model, read by one glob; the model comes from the path."""
    root, per_id = scratch_path(spark, "models"), measured(recent_series(spark, sf_dir))
    for m in BASELINES:  # a folder per write: rows are not sorted into folders
        rows = horizon_forecasts(per_id).select("id", "h", F.col(m).alias("yhat"))
        # an id stands in 28 lines in a row, of which gzip leaves little
        write_csv(rows, f"{root}/model={m}", compression="gzip")
    schema = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("h", T.IntegerType()), T.StructField("yhat", T.DoubleType()),
    ])
    rows = read_csv_glob(spark, f"{root}/model=*", schema)
    model = F.substring_index(F.substring_index("file_path", "/model=", -1), "/", 1)
    return rows.select(model.alias("model"), "id", "h", r6("yhat"))


@query("sink_csv", with_panel("part") + f"SELECT id || '_validation' AS id, {F28.replace('THEN v', 'THEN snaive7')} FROM base GROUP BY id")
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A submission file written and read back."""
    from shelfcast.sources.schemas import wide_forecast

    wide = pivot_steps(baseline_forecasts(spark, sf_dir), ["id"], "snaive7")
    path = write_csv(wide.withColumn("id", with_label("id", "validation")), scratch_path(spark, "submission"))
    return read_csv(spark, path, wide_forecast(["id"]))


@query("sink_forecasts", with_panel("part") + """
SELECT model, 'validation' AS horizon, CAST(count(*) AS BIGINT) AS n, round(sum(yhat), 4) AS total
FROM (UNPIVOT (SELECT id, h, snaive7, snaive28, mean28 FROM base) ON snaive7, snaive28, mean28 INTO NAME model VALUE yhat)
GROUP BY model""")
def sink_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models in one dataset partitioned by model and horizon; totals per partition after reading it back."""
    rows = _baseline_rows(spark, sf_dir).withColumn("horizon", F.lit("validation"))
    stored = read_table(spark, write_forecasts(rows, scratch_path(spark, "forecasts")))
    return stored.groupBy("model", "horizon").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("yhat"), 4).alias("total")
    )


# --- projections, filters, casts ---------------------------------------------

@query("feature_columns", with_panel("brand") + """
SELECT item_id, dept_id, cat_id, store_id, state_id, wday, month, year, event_name_1, event_type_1,
       event_name_2, event_type_2, snap_A, snap_B, round(sell_price, 6) AS sell_price FROM grid""")
def features_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid without the columns that are not features."""
    grid = panel_grid(spark, sf_dir)
    return grid.select(*feature_columns(grid)).withColumn("sell_price", r6("sell_price"))


@query("drop_cols", with_panel("part") + """
SELECT s.id, s.d, s.sales, c.snap_A, c.snap_B, c.wm_yr_wk FROM sales s JOIN cal c ON c.d = s.d""")
def drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir))
    return joined.drop(
        *KEYS[1:], "cents", "date", "weekday", "wday", "month", "year",
        "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    )



# the tables end on day 2500 at every scale, so the horizon starts at day 2473
@query("rename_horizon", with_panel("part") + "SELECT id, "
       + ", ".join(f"max(CASE WHEN h = {i} THEN snaive28 END) AS d_{2472 + i}" for i in range(1, 29))
       + " FROM base GROUP BY id")
def rename_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast columns under the names of the days they forecast."""
    wide = pivot_steps(baseline_forecasts(spark, sf_dir), ["id"], "snaive28")
    return rename_steps(wide, panel_horizon(spark, sf_dir).train_last)


@query("trailing_slice", with_panel("part") + f"""
SELECT s.id, s.d, date, s.sales FROM sales s JOIN cal c ON c.d = s.d, bounds
WHERE s.d BETWEEN t + 1 - 366 AND t + 1""")
def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 366 days before the first forecast day; the scan itself starts at that date."""
    horizon = panel_horizon(spark, sf_dir)
    sales = panel_sales(spark, sf_dir, first=horizon.first_day - timedelta(days=366))
    dated = sales.select("id", "d", F.date_add(F.lit(horizon.first_day), F.col("d") - horizon.train_last - 1).alias("date"), "sales")
    return trailing_slice(dated, horizon.first_day)


@query("cutoff", with_panel("part") + "SELECT id, d, sales FROM sales WHERE d <= (SELECT t FROM bounds)")
def cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = panel_horizon(spark, sf_dir).train_last
    return panel_sales(spark, sf_dir).filter(F.col("d") <= end).select("id", "d", "sales")


@query("filter_label", with_panel("part") + "SELECT id || '_validation' AS id, h, snaive7 FROM base")
def filter_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one horizon label out of a file that has both."""
    base = baseline_forecasts(spark, sf_dir).withColumn("id", with_label("id", "evaluation"))
    both = dual_label(base, "id", "evaluation", "validation")
    return both.filter(has_label("id", "validation")).select("id", "h", "snaive7")


@query("snap_by_state", with_panel("part") + """
SELECT id, s.d, CASE state_id WHEN 'A' THEN snap_A ELSE snap_B END AS snap FROM sales s JOIN cal c ON c.d = s.d""")
def snap_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir))
    return joined.select("id", "d", pick_by_group("state_id", {"A": "snap_A"}, "snap_B").cast("int").alias("snap"))


@query("mask_future", with_panel("part") + """
SELECT store_id, dept_id, d, CASE WHEN d <= (SELECT t FROM bounds) THEN sales END AS y FROM dept""")
def mask_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shelfcast.plans.panel import dept_days

    horizon = panel_horizon(spark, sf_dir)
    days = dept_days(panel_sales(spark, sf_dir), horizon.last)
    return days.select("store_id", "dept_id", "d", mask_from("sales", "d", horizon.train_last + 1).alias("y"))


@query("drop_nulls", with_panel("brand") + """
SELECT id, d, sales, round(sell_price, 6) AS sell_price FROM grid WHERE sales IS NOT NULL AND event_name_1 IS NOT NULL""")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = panel_grid(spark, sf_dir, rate=False).na.drop(subset=["sales", "event_name_1"])
    return grid.select("id", "d", "sales", r6("sell_price"))


@query("fill_nulls", with_panel("part") + """
SELECT id, s.d, coalesce(event_name_1, 'None') AS event_name_1, coalesce(event_type_1, 'None') AS event_type_1,
       coalesce(event_name_2, 'nothing') AS event_name_2, coalesce(sell_price, 0.0) AS sell_price
FROM sales s JOIN cal c ON c.d = s.d
LEFT JOIN (SELECT store_id, item_id, wm_yr_wk + 1 AS wm_yr_wk, round(sell_price, 6) AS sell_price FROM prices) p
  USING (store_id, item_id, wm_yr_wk)""")
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last week's price, and events, with missing values filled."""
    sales = panel_sales(spark, sf_dir)
    last_week = panel_prices(sales, panel_horizon(spark, sf_dir)).select("store_id", "item_id", (F.col("wm_yr_wk") + 1).alias("wm_yr_wk"), r6("sell_price"))
    joined = with_calendar(sales, panel_calendar(spark, sf_dir)).join(last_week, ["store_id", "item_id", "wm_yr_wk"], "left")
    filled = joined.na.fill({"event_name_1": "None", "event_type_1": "None", "event_name_2": "nothing", "sell_price": 0.0})
    return filled.select("id", "d", "event_name_1", "event_type_1", "event_name_2", "sell_price")


@query("cast_features", with_panel("part") + """
SELECT id, CAST(s.d AS INTEGER) AS d, CAST(sales AS FLOAT) AS sales, CAST(wday AS INTEGER) AS wday,
       CAST(snap_A AS FLOAT) AS snap_A FROM sales s JOIN cal c ON c.d = s.d""")
def cast_feature_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir))
    return cast_features(joined.select("id", "d", "sales", "wday", "snap_A"), ["wday"], ["sales", "snap_A"])


CODED = ["item_id", "dept_id", "cat_id", "store_id", "state_id", "event_name_1", "event_type_1"]


@query("category_codes", with_panel("part", "evented AS (SELECT s.*, c.* EXCLUDE (d) FROM sales s JOIN cal c ON c.d = s.d)") + "SELECT id, d, "
       + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c} NULLS FIRST) - 1 AS INTEGER) AS {c}" for c in CODED)
       + " FROM evented")
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinal codes of every attribute; missing events take code 0."""
    joined = with_calendar(panel_sales(spark, sf_dir), panel_calendar(spark, sf_dir)).select("id", "d", *CODED)
    return encode_categories(joined, category_dictionary(joined, CODED), CODED)


@query("decode_labels", with_panel("part") + "SELECT store_id, dept_id, d, sum(sales) AS sales FROM sales GROUP BY ALL")
def decode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate on codes, then join the labels back."""
    sales = panel_sales(spark, sf_dir).select("store_id", "dept_id", "d", "sales")
    dictionary = category_dictionary(sales, ["store_id", "dept_id"])
    coded = encode_categories(sales, dictionary, ["store_id", "dept_id"])
    summed = coded.groupBy("store_id", "dept_id", "d").agg(F.sum("sales").alias("sales"))
    for attribute in ("store_id", "dept_id"):
        labels = dictionary.filter(F.col("attribute") == attribute).select(F.col("code").alias(attribute), "value")
        summed = summed.join(labels, attribute).drop(attribute).withColumnRenamed("value", attribute)
    return summed


@query("one_hot", with_panel("part") + "SELECT id, d, sales, "
       + ", ".join(f"CAST(cat_id = '{c}' AS INTEGER) AS cat_id_{c}" for c in ["BULK", "REGULAR", "VALUE"]) + ", "
       + ", ".join(f"CAST(store_id = '{s}' AS INTEGER) AS \"store_id_{s}\"" for s in ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])
       + " FROM sales")
def one_hot_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir).select("id", "d", "sales", "cat_id", "store_id")
    stores = distinct_values(table(spark, sf_dir, "region"), "r_name")
    return one_hot(one_hot(sales, "cat_id", distinct_values(sales, "cat_id")), "store_id", stores)


@query("tight_types", with_panel("part") + """
SELECT id, CAST(d AS SMALLINT) AS d, CAST(sales AS FLOAT) AS sales, CAST(cents AS INTEGER) AS cents FROM sales""")
def tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel in the narrowest types that hold it."""
    return tight_types(panel_sales(spark, sf_dir).select("id", "d", "sales", "cents"))


@query("clip_round", with_panel("part") + """
SELECT id, h, CAST(greatest(round_even(mean28 * 7 - snaive7, 0), 0) AS INTEGER) AS yhat FROM base""")
def clip_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-even rounding of a difference, not below zero."""
    base = baseline_forecasts(spark, sf_dir)
    return base.select("id", "h", round_count(F.col("mean28") * 7 - F.col("snaive7")).alias("yhat"))


@query("temporal_split", with_panel("part") + """
SELECT split, dept_id, count(*) AS n, min(d) AS first_d, max(d) AS last_d, sum(sales) AS sales
FROM (SELECT *, CASE WHEN d >= t + 1 THEN 'validation' WHEN d >= t - 27 THEN 'test' WHEN d > 800 THEN 'train' END AS split
      FROM sales, bounds)
GROUP BY ALL""")
def split_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = panel_horizon(spark, sf_dir).train_last
    split = temporal_split("d", 800, end - 27, end + 1)
    return panel_sales(spark, sf_dir).groupBy(split.alias("split"), "dept_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.sum("sales").alias("sales")
    )


# --- reshape -----------------------------------------------------------------

@query("melt_sales", with_panel("brand") + "SELECT id, d, sales FROM dense")
def melt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sales file with one column per day (all days), scanned by its schema and melted."""
    last = panel_horizon(spark, sf_dir).last
    lines = wide_lines(panel_sales(spark, sf_dir, "brand"), SALES_KEYS, last)
    path = write_lines(lines, scratch_path(spark, "wide"))
    long = nan_to_null(melt_days(read_wide(spark, path, last), ["id"]))
    return long.withColumn("sales", F.col("sales").cast("double"))


@query("pivot_horizon", with_panel("part") + f"SELECT id, {F28.replace('THEN v', 'THEN mean28 + snaive7')} FROM base GROUP BY id")
def pivot_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = baseline_forecasts(spark, sf_dir)
    wide = pivot_steps(base.withColumn("v", F.col("mean28") + F.col("snaive7")), ["id"], "v")
    return wide.select("id", *[r6(f"F{i}") for i in range(1, 29)])


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query("day_item_matrix", with_panel("brand", """
rolled AS (SELECT *, CASE WHEN count(sales) OVER w = 28 THEN avg(sales) OVER w END AS rmean_28_28
           FROM masked WINDOW w AS (PARTITION BY id ORDER BY d ROWS BETWEEN 55 PRECEDING AND 28 PRECEDING)),
branded AS (SELECT *, split_part(item_id, '_', 2) AS brand FROM rolled)""") + "SELECT store_id, dept_id, d, "
       + ", ".join(f"round(coalesce(max(CASE WHEN brand = '{b}' THEN rmean_28_28 END), 0.0), 6) AS \"rmean_28_28_{i}\", "
                   f"coalesce(max(CASE WHEN brand = '{b}' THEN sales END), 0.0) AS \"sales_{i}\"" for i, b in enumerate(BRANDS))
       + " FROM branded GROUP BY ALL")
def day_item_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales and slow means of all brands of a department side by side, per store and day."""
    dense = panel_dense(panel_sales(spark, sf_dir, "brand"), panel_horizon(spark, sf_dir))
    mean = rolling_columns(["id"], "d", "sales", [28], [28])["rmean_28_28"]
    rolled = dense.select("store_id", "dept_id", "d", F.split("item_id", "_")[1].alias("brand"), "sales", mean.alias("rmean_28_28"))
    brands = sorted(distinct_values(table(spark, sf_dir, "part"), "p_brand"), key=lambda b: (len(b), b))
    matrix = item_matrix(rolled, ["store_id", "dept_id", "d"], "brand", brands, ["rmean_28_28", "sales"])
    return matrix.select("store_id", "dept_id", "d", *[r6(c) for c in matrix.columns[3:]])


@query("future_grid", with_panel("part") + """
SELECT id, c.d, date, wm_yr_wk FROM ids CROSS JOIN (SELECT t + CAST(unnest(generate_series(1, 56)) AS INTEGER) AS d FROM bounds) f
JOIN cal c ON c.d = f.d""")
def future_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifty-six future days asked for; those beyond the calendar drop out at the join."""
    ids = panel_sales(spark, sf_dir).select("id").distinct()
    rows = future_rows(ids, panel_horizon(spark, sf_dir).train_last)
    return with_calendar(rows, panel_calendar(spark, sf_dir)).select("id", "d", "date", "wm_yr_wk")


@query("horizon_label", with_panel("part") + """
SELECT id, 'F' || CAST(d - t AS VARCHAR) AS f, sales FROM sales, bounds WHERE d > t""")
def label_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = panel_horizon(spark, sf_dir).train_last
    ahead = panel_sales(spark, sf_dir).filter(F.col("d") > end)
    return ahead.select("id", horizon_label("d", end).alias("f"), "sales")


@query("dual_label", with_panel("part") + """
SELECT id || '_' || label AS id, h, snaive7 AS yhat FROM base CROSS JOIN (VALUES ('validation'), ('evaluation')) v(label)""")
def both_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = baseline_forecasts(spark, sf_dir).select(with_label("id", "evaluation").alias("id"), "h", F.col("snaive7").alias("yhat"))
    return dual_label(base, "id", "evaluation", "validation")


@query("append_eval", with_panel("part") + """
SELECT id || '_validation' AS id, h, snaive7 AS yhat FROM base UNION ALL SELECT id || '_evaluation', h, snaive28 FROM base""")
def append_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = baseline_forecasts(spark, sf_dir)
    validation = base.select(with_label("id", "validation").alias("id"), "h", F.col("snaive7").alias("yhat"))
    evaluation = base.select(with_label("id", "evaluation").alias("id"), "h", F.col("snaive28").alias("yhat"))
    return validation.unionByName(evaluation)


@query("random_submission", with_panel("part") + f"""
SELECT id || '_validation' AS id, h, truth + floor(100 * {UNIFORM.format("id || '|' || CAST(h AS VARCHAR) || '|11'")}) AS yhat FROM base""")
def random_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truth plus whole noise below 100 for every id and step, to compare scores with."""
    noise = F.floor(hashed_uniform("id", "h", seed=11) * 100)
    base = baseline_forecasts(spark, sf_dir)
    return base.select(with_label("id", "validation").alias("id"), "h", (F.col("truth") + noise).alias("yhat"))


# --- joins -------------------------------------------------------------------

@query("join_calendar", with_panel("part") + "SELECT id, sales, c.* FROM sales s JOIN cal c ON c.d = s.d")
def join_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir).select("id", "d", "sales")
    return with_calendar(sales, panel_calendar(spark, sf_dir))


def _dense_weeks(spark: SparkSession, sf_dir: str):
    sales = panel_sales(spark, sf_dir, "brand")
    horizon = panel_horizon(spark, sf_dir)
    return panel_dense(sales, horizon).withColumn("wm_yr_wk", week_of()), panel_prices(sales, horizon)


JOIN_PRICES_SQL = with_panel("brand") + """
SELECT id, d, m.sales, round(sell_price, 6) AS sell_price
FROM masked m JOIN prices p ON p.store_id = m.store_id AND p.item_id = m.item_id AND p.wm_yr_wk = floor(d / 7)"""


@query("join_prices", JOIN_PRICES_SQL)
def join_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in weeks without a price drop out."""
    return with_prices(*_dense_weeks(spark, sf_dir)).select("id", "d", "sales", r6("sell_price"))


@query("join_prices_left", JOIN_PRICES_SQL)
def join_prices_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows by a left join and a filter."""
    return with_prices_left(*_dense_weeks(spark, sf_dir)).select("id", "d", "sales", r6("sell_price"))


@query("join_rate", with_panel("part") + """
SELECT id, d, sales, round(rate, 6) AS rate FROM sales s LEFT JOIN rates r ON r.dept_id = s.dept_id AND r.store_id = s.store_id""")
def join_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = panel_sales(spark, sf_dir)
    rated = with_rate(sales, panel_rates(sales, panel_horizon(spark, sf_dir)))
    return rated.select("id", "d", "sales", r6("rate"))


@query("join_models", with_panel("part") + """
SELECT id || '_validation' AS id, h, snaive7, snaive28, round(mean28, 6) AS mean28 FROM base""")
def models_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three forecast tables joined on id and step in one shuffle."""
    base = baseline_forecasts(spark, sf_dir)
    joined = join_models({m: base.select("id", "h", F.col(m).alias("yhat")) for m in BASELINES})
    # labelled after the join: the models' rows are dealt by id already
    return joined.withColumn("id", with_label("id", "validation")).withColumn("mean28", r6("mean28"))


@query("update_join", with_panel("part") + """
SELECT b.id, b.h, coalesce(s.sales, b.snaive7) AS yhat FROM base b, bounds
LEFT JOIN sales s ON s.id = b.id AND s.d = t - 28 + b.h""")
def update_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of four weeks earlier where there were any, else the base forecast."""
    end = panel_horizon(spark, sf_dir).train_last
    base = baseline_forecasts(spark, sf_dir).select("id", "h", F.col("snaive7").alias("yhat"))
    recent = panel_sales(spark, sf_dir).filter(F.col("d").between(end - 27, end))
    return update_join(base, recent.select("id", (F.col("d") - end + 28).alias("h"), F.col("sales").alias("yhat")), ["id", "h"], "yhat")


@query("order_like_sample", with_panel("part") + f"""
SELECT id, CAST(row_number() OVER (ORDER BY id DESC) - 1 AS BIGINT) AS "order", {F28.replace('THEN v', 'THEN snaive7')}
FROM base GROUP BY id""")
def ordered_like_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps of a forecast file in the row order of a sample file."""
    sample = ranged_index(panel_sales(spark, sf_dir).select("id").distinct(), [F.col("id").desc()], name="order")
    wide = pivot_steps(baseline_forecasts(spark, sf_dir), ["id"], "snaive7")
    ordered = order_like(wide, sample)
    return ordered.select("id", "order", *[r6(f"F{i}") for i in range(1, 29)])


@query("holdout_split", with_panel("part") + f"""
SELECT id, d, sales FROM sales WHERE NOT ({UNIFORM.format("id || '|' || CAST(d AS VARCHAR) || '|7'")} < 0.2)""")
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows: all rows but a hashed fifth, by anti-join on the row key."""
    sales = panel_sales(spark, sf_dir).select("id", "d", "sales")
    return without(sales, hashed_holdout(sales, ["id", "d"], 0.2, seed=7), ["id", "d"])


# --- scalar functions --------------------------------------------------------

@query("date_parts", """
SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS SMALLINT) AS wday, CAST(weekofyear(o_orderdate) AS SMALLINT) AS week,
       CAST(month(o_orderdate) AS SMALLINT) AS month, CAST(quarter(o_orderdate) AS SMALLINT) AS quarter,
       CAST(year(o_orderdate) AS SMALLINT) AS year, CAST(day(o_orderdate) AS SMALLINT) AS mday,
       CAST(ceil(day(o_orderdate) / 7.0) AS SMALLINT) AS wom, isodow(o_orderdate) >= 6 AS is_week_end FROM orders""")
def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    parts = [c.alias(name) for name, c in date_parts("date").items()]
    return orders.select("o_orderkey", *parts, week_of_month("date").alias("wom"), is_weekend("date").alias("is_week_end"))


@query("parse_day", with_panel("part") + "SELECT id, d, sales FROM sales")
def parse_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day labels ``d_<k>`` back to integers."""
    labelled = panel_sales(spark, sf_dir).select("id", F.concat(F.lit("d_"), "d").alias("d"), "sales")
    return labelled.select("id", parse_day("d").alias("d"), "sales")


@query("relabel_ids", with_panel("part") + "SELECT id || '_validation' AS id, id || '_evaluation' AS relabelled FROM ids")
def relabel_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = panel_sales(spark, sf_dir).select(with_label("id", "validation").alias("id")).distinct()
    return ids.select("id", relabel("id", "validation", "evaluation").alias("relabelled"))


@query("series_key", with_panel("part") + "SELECT store_id || '_' || dept_id AS key, d, sum(sales) AS sales FROM sales GROUP BY ALL")
def keyed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_sales(spark, sf_dir).groupBy(series_key("store_id", "dept_id").alias("key"), "d").agg(F.sum("sales").alias("sales"))


@query("split_key", with_panel("part") + "SELECT DISTINCT id, dept_id || '_' || split_part(item_id, '_', 2) AS head, store_id AS rest FROM ids")
def split_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series ids back into item (first two tokens) and store."""
    ids = panel_sales(spark, sf_dir).select("id").distinct()
    head, rest = split_series_key("id")
    return ids.select("id", head.alias("head"), rest.alias("rest"))
