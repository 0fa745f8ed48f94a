"""Explicit schemas of the input files, so that no reader has to infer types."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the input files.
SALES_KEYS = ["id", "item_id", "dept_id", "store_id", "cat_id", "state_id"]

CALENDAR = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("d", T.StringType()),
        T.StructField("wm_yr_wk", T.ShortType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("wday", T.ShortType()),
        T.StructField("month", T.ShortType()),
        T.StructField("year", T.ShortType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
        T.StructField("event_name_2", T.StringType()),
        T.StructField("event_type_2", T.StringType()),
        T.StructField("snap_CA", T.FloatType()),
        T.StructField("snap_TX", T.FloatType()),
        T.StructField("snap_WI", T.FloatType()),
    ]
)

PRICES = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.ShortType()),
        T.StructField("sell_price", T.FloatType()),
    ]
)


def wide_sales(last_day: int, first_day: int = 1) -> T.StructType:
    """Schema of a sales file with one column per day."""
    keys = [T.StructField(name, T.StringType()) for name in SALES_KEYS]
    days = [T.StructField(f"d_{k}", T.FloatType()) for k in range(first_day, last_day + 1)]
    return T.StructType(keys + days)


def wide_forecast(keys: list[str], steps: int = 28) -> T.StructType:
    """Schema of a forecast, weight or submission file: keys and ``F1..F28``."""
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in keys]
        + [T.StructField(f"F{i}", T.DoubleType()) for i in range(1, steps + 1)]
    )


# The tuned parameters stored as a dict literal.
SEASONAL_PARAMS = T.StructType(
    [
        T.StructField("changepoint_range", T.DoubleType()),
        T.StructField("changepoint_prior_scale", T.DoubleType()),
        T.StructField("holidays_prior_scale", T.DoubleType()),
        T.StructField("seasonality_mode", T.StringType()),
        T.StructField("yearly_order", T.IntegerType()),
        T.StructField("monthly_order", T.IntegerType()),
        T.StructField("weekly_order", T.IntegerType()),
        T.StructField("yearly_prior_scale", T.DoubleType()),
        T.StructField("monthly_prior_scale", T.DoubleType()),
        T.StructField("weekly_prior_scale", T.DoubleType()),
        T.StructField("snap_mode", T.StringType()),
        T.StructField("price_mode", T.StringType()),
        T.StructField("dom_mode", T.StringType()),
    ]
)
