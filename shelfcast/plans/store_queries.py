"""Queries over the stored panel."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from shelfcast.functions.dates import date_parts
from shelfcast.horizon import Horizon
from shelfcast.operators.joins import with_calendar
from shelfcast.operators.windows import series_features
from shelfcast.plans.feature_queries import ROLLED, ROUND_ROLLED, features_sql
from shelfcast.plans.panel import KEYS, date_of, panel_calendar, panel_days, panel_horizon, panel_sales, panel_tasks
from shelfcast.plans.panel_sql import with_panel
from shelfcast.plans.registry import query, r6
from shelfcast.session import measured
from shelfcast.sources.panel_store import PanelStore, temporary_store

WEEK = 7


def stored_panel(spark: SparkSession, sf_dir: str, store: PanelStore, path: str, horizon: Horizon, grain: str = "part") -> None:
    """Fill a new store with the panel as it is known at the horizon's last day of history."""
    store.create(panel_days(panel_sales(spark, sf_dir, grain), horizon), horizon.train_last, path)


def append_days(spark: SparkSession, sf_dir: str, store: PanelStore, known_last: int, horizon: Horizon, grain: str = "part") -> None:
    """Take the days after ``known_last`` into the store; only the sales of the blocks that change are read."""

    def since(day: int) -> DataFrame:
        return panel_days(panel_sales(spark, sf_dir, grain, horizon.date_of(max(day, 1))), horizon)

    store.append(since, known_last, horizon.train_last, horizon.last, KEYS)


def store_features(store: PanelStore) -> DataFrame:
    """Lags and rolling means of the stored series: windows over buckets, without a shuffle."""
    return series_features(store.read(), ["id"])


@query("stored_features", with_panel("part", features_sql("grid", "id")) + f"""
SELECT id, d, sales, lag_7, lag_28, {ROUND_ROLLED}, wday, CAST(weekofyear(date) AS SMALLINT) AS week, month FROM feats""")
def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the panel, from a store that is bucketed and sorted by series."""
    with temporary_store(spark, weeks=104, buckets=panel_tasks(spark, sf_dir)) as (store, path):
        stored_panel(spark, sf_dir, store, path, panel_horizon(spark, sf_dir))
        dated = with_calendar(store_features(store), panel_calendar(spark, sf_dir).select("d", "date", "wday", "month"))
        table = dated.withColumn("week", date_parts("date")["week"]).select(
            "id", "d", "sales", "lag_7", "lag_28", *[r6(c) for c in ROLLED], "wday", "week", "month")
        return measured(table)


@query("append_week", with_panel("part") + """
SELECT id, item_id, dept_id, cat_id, store_id, state_id, d, date, sales, round(sell_price, 6) AS sell_price FROM grid""")
def append_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel stored a week ago, with the last week of history appended: the same rows as one made today."""
    today = panel_horizon(spark, sf_dir)
    before = Horizon(today.label, today.train_last - WEEK, today.first_day - timedelta(days=WEEK))
    with temporary_store(spark, weeks=104, buckets=panel_tasks(spark, sf_dir)) as (store, path):
        stored_panel(spark, sf_dir, store, path, before)
        append_days(spark, sf_dir, store, before.train_last, today)
        # the store's own files are the result: they outlive the table, so nothing is copied
        rows = store.files(path).withColumn("date", date_of())
        # prices are whole cents, so there is nothing to round
        return rows.select(*KEYS, "d", "date", "sales", "sell_price")
