"""A retail sales panel derived from the star-schema tables.

Stores are regions, departments are part types.  Items are either single parts
(``part``: the number of series grows with the data) or brands within a type
(``brand``: fewer, longer series, for lag features and models).  Sales are
sparse: a row exists for a day with sales.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.horizon import STEPS, Horizon
from shelfcast.operators.joins import with_calendar, with_rate
from shelfcast.operators.reshape import fill_days
from shelfcast.operators.windows import growth_rates

# The day before day 1, and the grouping of types and regions.
EPOCH = date(1994, 12, 31)
CATEGORIES = {"VALUE": ["ECONOMY", "PROMO"], "REGULAR": ["MEDIUM", "SMALL"]}
CATEGORY_ELSE = "BULK"
STATES = {"A": ["AFRICA", "ASIA"]}
STATE_ELSE = "B"
KEYS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
SERIES_KEYS = ["store_id", "dept_id"]
# Events by month and day.
EVENTS = {
    (1, 1): ("NewYear", "National"),
    (2, 14): ("Valentines", "Cultural"),
    (7, 4): ("Independence", "National"),
    (11, 11): ("Veterans", "National"),
    (12, 25): ("Christmas", "Religious"),
}
SECOND_EVENTS = {(12, 25): ("WinterSale", "Cultural")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=64)
def _last_date(spark: SparkSession, sf_dir: str, files: tuple[str, ...]) -> date:
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("date").alias("d")).first()["d"]


def panel_horizon(spark: SparkSession, sf_dir: str, label: str = "validation") -> Horizon:
    """The last 28 days of the data are held out, so that the truth is known.

    The last date is remembered for a table's list of files: files that are added
    are seen, one that is overwritten under its own name is not.
    """
    files = tuple(sorted(table(spark, sf_dir, "lineitem").inputFiles()))
    last = (_last_date(spark, sf_dir, files) - EPOCH).days
    end = last - STEPS
    return Horizon(label, end, date.fromordinal(EPOCH.toordinal() + end + 1))


# Lines that one task takes: a line gives about twelve rows of the grid, so a task sorts well under a million.
TASK_LINES = 1 << 16


@lru_cache(maxsize=64)
def _line_count(spark: SparkSession, sf_dir: str, files: tuple[str, ...]) -> int:
    return table(spark, sf_dir, "lineitem").count()


def panel_tasks(spark: SparkSession, sf_dir: str) -> int:
    """How many tasks the panel is dealt over: in proportion to the lines, so that a task's memory stays the same.

    Spark would merge the shuffled rows, which are narrow, into few tasks, where
    each of them becomes many days.  Remembered like the last date.
    """
    files = tuple(sorted(table(spark, sf_dir, "lineitem").inputFiles()))
    return _line_count(spark, sf_dir, files) // TASK_LINES + 1


def _mapped(column: str, groups: dict[str, list[str]], other: str) -> Column:
    mapped = None
    for name, members in groups.items():
        condition = F.col(column).isin(members)
        mapped = F.when(condition, name) if mapped is None else mapped.when(condition, name)
    return mapped.otherwise(other)


def day_number(date_col: str | Column) -> Column:
    return F.datediff(date_col, F.lit(EPOCH))


def date_of(day: str = "d") -> Column:
    return F.date_add(F.lit(EPOCH), F.col(day))


def panel_lines(spark: SparkSession, sf_dir: str, grain: str = "part", first: date | None = None) -> DataFrame:
    """``id, item_id, dept_id, store_id, d, sales, cents`` of each line, where the scan has put it: for totals that are
    summed map-side.  ``first`` keeps only recent history; the filter reaches the Parquet scan."""
    lines = table(spark, sf_dir, "lineitem")
    if first is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(first).cast("timestamp_ntz"))
    lines = lines.select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.col("l_shipdate").cast("date").alias("date")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    item = {"part": F.concat_ws("_", "p_type", "p_partkey"), "brand": F.concat_ws("_", "p_type", "p_brand")}[grain]
    # a left-deep chain: Spark knows the size of each plain table, but not that of a joined dimension
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            item.alias("item_id"), F.col("p_type").alias("dept_id"), F.col("r_name").alias("store_id"),
            day_number("date").alias("d"), F.col("l_quantity").alias("sales"),
            F.floor(F.col("l_extendedprice") * 100 + 0.5).alias("cents"),
        )
        .withColumn("id", F.concat_ws("_", "item_id", "store_id"))
    )


def panel_sales(spark: SparkSession, sf_dir: str, grain: str = "part", first: date | None = None) -> DataFrame:
    """``KEYS, d, sales, cents``: units and exact revenue by item, store and day; ``first`` as in :func:`panel_lines`."""
    # dealt by series once; days, weeks, windows and forecasts of a series stay in its task
    return (
        panel_lines(spark, sf_dir, grain, first)
        .repartition(panel_tasks(spark, sf_dir), "id")
        .groupBy("id", "item_id", "dept_id", "store_id", "d")
        .agg(F.sum("sales").alias("sales"), F.sum("cents").alias("cents"))
        .select(
            "id",
            "item_id",
            "dept_id",
            _mapped("dept_id", CATEGORIES, CATEGORY_ELSE).alias("cat_id"),
            "store_id",
            _mapped("store_id", STATES, STATE_ELSE).alias("state_id"),
            "d",
            "sales",
            "cents",
        )
    )


def panel_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from day 1 to the last day of the data."""
    last = table(spark, sf_dir, "lineitem").agg(day_number(F.max("l_shipdate").cast("date")).alias("last"))
    days = last.select(F.explode(F.sequence(F.lit(1), F.col("last"))).alias("d")).withColumn("date", date_of())
    dom, month = F.dayofmonth("date"), F.month("date")

    def event(table: dict, part: int) -> Column:
        found = F.lit(None).cast("string")
        for (m, day), names in table.items():
            found = F.when((month == m) & (dom == day), names[part]).otherwise(found)
        return found

    return days.select(
        "d",
        "date",
        week_of("d").alias("wm_yr_wk"),
        F.date_format("date", "EEEE").alias("weekday"),
        (F.weekday("date") + 1).cast("int").alias("wday"),
        month.cast("int").alias("month"),
        F.year("date").cast("int").alias("year"),
        event(EVENTS, 0).alias("event_name_1"),
        event(EVENTS, 1).alias("event_type_1"),
        event(SECOND_EVENTS, 0).alias("event_name_2"),
        event(SECOND_EVENTS, 1).alias("event_type_2"),
        (dom % 2).cast("int").alias("snap_A"),
        (dom % 3 == 0).cast("int").alias("snap_B"),
    )


def week_of(day: str = "d") -> Column:
    """Pricing week; the day number starts on a Sunday."""
    return F.floor(F.col(day) / 7).cast("int")


def unit_price() -> Column:
    """Average unit price in whole cents."""
    return F.floor(F.sum("cents") / F.sum("sales")) / 100


def panel_prices(sales: DataFrame, horizon: Horizon) -> DataFrame:
    """Price by store, item and week, from the days before the horizon; weeks without sales have none."""
    history = sales.filter(F.col("d") <= horizon.train_last)
    return history.groupBy("store_id", "item_id", week_of().alias("wm_yr_wk")).agg(unit_price().alias("sell_price"))


def dept_days(sales: DataFrame, last: int) -> DataFrame:
    """Dense daily totals per store and department from day 1 to ``last``; later sales are not read."""
    daily = sales.filter(F.col("d") <= last).groupBy("store_id", "dept_id", "d").agg(F.sum("sales").alias("sales"))
    return fill_days(daily, SERIES_KEYS, 1, last)


def panel_rates(sales: DataFrame, horizon: Horizon) -> DataFrame:
    """Growth rate of each store and department, from the history before the horizon."""
    history = sales.filter(F.col("d") <= horizon.train_last)
    return growth_rates(dept_days(history, horizon.train_last), horizon.train_last)


def weekly_sales(sales: DataFrame, end: int) -> DataFrame:
    """``KEYS, week, price, s0, ..., s6``: a row for each priced week up to ``end``, with the sales of its days.

    ``sales`` are dealt by series, and so is all that is made of them.
    """
    history = sales.filter(F.col("d") <= end)
    return history.groupBy(*KEYS, week_of().alias("week")).agg(
        unit_price().alias("price"),
        *[F.max(F.when(F.col("d") % 7 == k, F.col("sales"))).alias(f"s{k}") for k in range(7)],
    )


def panel_days(sales: DataFrame, horizon: Horizon) -> DataFrame:
    """``KEYS, d, sales, sell_price``: the days of priced weeks, and those of the horizon at the series' last price."""
    end = horizon.train_last
    latest = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("week"))) == 1
    weeks = weekly_sales(sales, end).withColumn("latest", latest)
    day = lambda k: (F.col("week") * 7 + k).cast("int")
    known = [F.struct(day(k).alias("d"), F.coalesce(F.col(f"s{k}"), F.lit(0.0)).alias("sales")) for k in range(7)]
    ahead = [F.struct(F.lit(end + h).alias("d"), F.lit(None).cast("double").alias("sales")) for h in range(1, horizon.steps + 1)]
    # a series' last week has the horizon's price, and gives its days as well
    days = F.when(F.col("latest"), F.array(*known, *ahead)).otherwise(F.array(*known))
    rows = weeks.select(*KEYS, F.col("price").alias("sell_price"), F.explode(days).alias("day"))
    return rows.filter(F.col("day.sales").isNull() | F.col("day.d").between(1, end)).select(*KEYS, "day.*", "sell_price")


def panel_grid(spark: SparkSession, sf_dir: str, grain: str = "brand", rate: bool = True) -> DataFrame:
    """Item x store x day grid: sales, calendar, prices and growth rate.

    A series has the seven days of each week in which it has a price, and all
    days of the horizon, at its last price and without sales.  Nothing of the
    horizon's sales is used.  Days come from the priced weeks, so the grid grows
    with the sales rows and not with items times days; sales are dealt by series
    once, and weeks, days and windows over the series reuse that partitioning.
    """
    horizon = panel_horizon(spark, sf_dir)
    sales = panel_sales(spark, sf_dir, grain)
    grid = with_calendar(panel_days(sales, horizon), panel_calendar(spark, sf_dir))
    return with_rate(grid, panel_rates(sales, horizon)) if rate else grid


def panel_dense(sales: DataFrame, horizon: Horizon, mask: bool = True) -> DataFrame:
    """Every item, store and day; the horizon has no sales when ``mask``ed."""
    dense = fill_days(sales, "id", 1, horizon.last, carry=KEYS[1:])
    if mask:
        dense = dense.withColumn("sales", F.when(F.col("d") <= horizon.train_last, F.col("sales")))
    return dense


BASELINES = ["snaive7", "snaive28", "mean28"]


def recent_series(spark: SparkSession, sf_dir: str, grain: str = "part") -> DataFrame:
    """``KEYS, days, total``: a row per id with its at most 28 recent and 28 held-out days, and the sum of the recent ones."""
    horizon = panel_horizon(spark, sf_dir)
    end, steps = horizon.train_last, horizon.steps
    offset = F.col("d") - end
    recent, ahead = offset.between(1 - steps, 0), offset.between(1, steps)
    return (
        panel_sales(spark, sf_dir, grain)
        .groupBy(*KEYS)
        .agg(
            F.map_from_entries(F.collect_list(F.when(recent | ahead, F.struct(offset, "sales")))).alias("days"),
            F.sum(F.when(recent, F.col("sales")).otherwise(0.0)).alias("total"),
        )
    )


def horizon_forecasts(per_id: DataFrame, steps: int = STEPS, carry: Sequence[str] = ()) -> DataFrame:
    """The rows of :func:`recent_series` by day of the horizon, with three simple forecasts."""

    def at(day: Column) -> Column:
        return F.coalesce(F.try_element_at("days", day.cast("int")), F.lit(0.0))

    h = F.col("h")
    return per_id.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select(
        *KEYS,
        *carry,
        "h",
        at(h).alias("truth"),
        at((h - 1) % 7 - 6).alias("snaive7"),
        at(h - steps).alias("snaive28"),
        (F.col("total") / steps).alias("mean28"),
    )


def baseline_forecasts(spark: SparkSession, sf_dir: str, grain: str = "part") -> DataFrame:
    """``KEYS, h, truth`` and three simple forecasts for all ids and horizon days.

    One aggregate over the sales gathers the days of each id; the horizon rows are exploded from those.
    """
    return horizon_forecasts(recent_series(spark, sf_dir, grain))
