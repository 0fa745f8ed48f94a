"""What keeps the panel's jobs in proportion to the lines: tasks, buckets, exchanges, stored tables."""

import os
import random
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.numeric import hashed_poisson, hashed_uniform
from shelfcast.llm import simhash_wide
from shelfcast.operators import loglinear
from shelfcast.operators.hierarchy import rollup_levels
from shelfcast.operators.reshape import pivot_steps
from shelfcast.operators.sampling import sample_with_replacement
from shelfcast.plans import panel, store_queries
from shelfcast.plans.catalog import QUERIES
from shelfcast.sources import panel_store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few_lines_a_task(monkeypatch):
    monkeypatch.setattr(panel, "TASK_LINES", 1000)


def test_tasks_follow_the_lines(spark, small, few_lines_a_task):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    assert panel.panel_tasks(spark, small) == lines // 1000 + 1 > 4
    assert panel.panel_sales(spark, small).rdd.getNumPartitions() == panel.panel_tasks(spark, small)


@pytest.mark.parametrize("name", ["lags", "rolling_means", "pivot_horizon", "sink_csv", "submission", "join_models"])
def test_sales_are_dealt_by_series_once(spark, small, few_lines_a_task, name):
    if name == "sink_csv":  # the query returns what it has written
        shown = plan(pivot_steps(panel.baseline_forecasts(spark, small), ["id"], "snaive7"))
    else:
        shown = plan(QUERIES[name](spark, small))
    assert "hashpartitioning(id" in shown
    # nothing is dealt by series a second time: Spark's own exchanges are those of its small joins
    assert not [line for line in shown.splitlines() if "hashpartitioning(id" in line and "REPARTITION_BY_NUM" not in line]


def test_top_down_never_joins_days_to_shares(spark, small, few_lines_a_task):
    assert "hashpartitioning(id" not in plan(QUERIES["top_down"](spark, small))


def test_buckets_follow_the_lines(spark, small, few_lines_a_task, monkeypatch):
    given, real = [], store_queries.temporary_store

    def noted(spark, **options):
        given.append(options.get("buckets"))
        return real(spark, **options)

    monkeypatch.setattr(store_queries, "temporary_store", noted)
    rows = QUERIES["stored_features"](spark, small)
    assert given == [panel.panel_tasks(spark, small)]
    assert rows.count() == QUERIES["features"](spark, small).count()


def test_a_fit_stores_its_cells_once(spark, monkeypatch):
    stored, real = [], loglinear.measured
    monkeypatch.setattr(loglinear, "measured", lambda df: stored.append(df.columns) or real(df))
    rows = [(f"d{i % 2}", f"i{i}", f"s{s}", w, float(1 + (i * s + w) % 4)) for i in range(6) for s in range(2) for w in range(3)]
    # an item in two departments has its margins over both
    rows.append(("d1", "i0", "s0", 0, 5.0))
    sales = spark.createDataFrame(rows, "dept string, item string, store string, wday int, sales double")
    cells = loglinear.share_cells(sales, ["dept"], ["item", "store"], sales.select("wday").distinct())
    fit = loglinear.fit_shares(cells, "item", ["dept"], [["store"], ["wday"]], ["store", "wday"], cycles=40)
    assert len(stored) == 1
    got = fit.toPandas()
    x = got.assign(fit=1.0)

    def scaled(x, keys):
        sums = x.groupby(keys)[["seen", "fit"]].transform("sum")
        return x.assign(fit=x["fit"] * sums["seen"] / sums["fit"])

    for _ in range(40):
        for keys in (["dept", "store", "wday"], ["item", "store"], ["item", "wday"]):
            x = scaled(x, keys)
    x = scaled(x, ["dept", "store", "wday"])
    assert (abs(x["fit"] - got["fit"]) < 1e-9 * x["fit"]).all() and len(got) == cells.count()


def test_rows_of_a_group_of_near_copies_grow_with_its_size(spark):
    r = random.Random(3)
    masks = simhash_wide.block_masks()[:1]
    prints = [1 << 40 | r.getrandbits(8) << 50 | k for k in range(100)]
    rows = spark.createDataFrame([(0, p & ~masks[0], p & ~masks[0]) for p in prints], "choice int, fp long, part long").distinct()
    n = rows.count()
    found = simhash_wide.run_pairs(rows.select(F.col("choice"), "fp", "part"), masks, 64, simhash_wide.CROWDED)
    assert n > 40 and found.count() <= 3 * n


def test_a_near_pair_comes_from_one_choice(spark):
    masks = simhash_wide.block_masks()
    rows = spark.range(2).selectExpr("id as fp", "id as part").withColumn(
        "choice", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))))
    assert [tuple(r) for r in simhash_wide.run_pairs(rows, masks, 10, 16).collect()] == [(0, 1, -1)]


def test_members_of_a_crowd_give_only_pairs_that_could_link(spark):
    r = random.Random(4)
    # 60 fingerprints of one run: sets of their own, but for one pair of like ones
    sets = [sorted(r.getrandbits(31) for _ in range(50)) for _ in range(60)]
    sets[59] = sets[7][:47] + [1, 2, 3]
    rows = [(0, k, k, simhash_wide.parity_mark(s).tolist(), len(s)) for k, s in enumerate(sets)]
    rows = spark.createDataFrame(rows, "choice int, fp long, part long, mark array<long>, n long")
    found = simhash_wide.run_pairs(rows, [~63], 64, None, marked=True).select("a", "b").collect()
    assert [tuple(p) for p in found] == [(7, 59)]


def test_marks_never_differ_more_than_their_sets():
    r = random.Random(5)
    for _ in range(200):
        own = {r.getrandbits(31) for _ in range(r.randint(0, 300))}
        other = {x for x in own if r.random() < 0.8} | {r.getrandbits(31) for _ in range(r.randint(0, 40))}
        a, b = (simhash_wide.parity_mark(np.array(sorted(s), dtype=np.int32)) for s in (own, other))
        assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= len(own ^ other)


def test_a_draw_with_replacement_takes_its_digest_twice_at_most(spark):
    rows = spark.range(3000).selectExpr("id", "cast(id % 7 as int) as d")
    drawn = sample_with_replacement(rows, ["id", "d"], seed=19)
    # once for the copies, once where Spark drops the rows without any
    assert plan(drawn).count("md5(") <= 2
    times = rows.withColumn("n", hashed_poisson(hashed_uniform("id", "d", seed=19))).filter("n > 0")
    assert drawn.groupBy("id", "d").agg(F.count(F.lit(1)).cast("int").alias("n")).exceptAll(times).isEmpty()
    assert drawn.count() == times.agg(F.sum("n")).first()[0]


@pytest.mark.parametrize("name", ["hierarchy_rollup", "wrmsse", "blend_search"])
def test_item_levels_are_summed_in_the_tasks_of_the_items(spark, small, few_lines_a_task, name):
    shown = plan(QUERIES[name](spark, small))
    dealt = [line for line in shown.splitlines() if "hashpartitioning(item_id" in line]
    assert any("REPARTITION_BY_NUM" in line for line in dealt)
    # no row of a day is dealt by item and day, or by level and key, again
    assert not [line for line in dealt if ", d#" in line or ", h#" in line]


def test_rows_without_an_item_keep_their_level_keys(spark):
    rows = [(None, "s1", "d1", "c", "x", 1, 2.0), ("i1", "s1", "d1", "c", "x", 1, 3.0), (None, "s2", "d1", "c", "x", 1, 4.0)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, dept_id string, cat_id string, state_id string, d int, sales double")
    got = {(r.level, r.key): r.sales for r in rollup_levels(df).filter("level like 'item%'").collect()}
    assert got == {("item", ""): 6.0, ("item", "i1"): 3.0, ("item_state", "x"): 6.0, ("item_state", "i1/x"): 3.0,
                   ("item_store", "s1"): 2.0, ("item_store", "s2"): 4.0, ("item_store", "i1/s1"): 3.0}


def test_files_of_the_models_do_not_repeat_each_id_28_times(spark, small):
    rows = QUERIES["scan_glob"](spark, small)
    written = sum(os.path.getsize(unquote(urlparse(f).path)) for f in rows.inputFiles())
    ids = rows.select("id").distinct().collect()
    assert rows.count() == 3 * 28 * len(ids)
    # an id, and what its 28 steps add, in each of three folders
    assert written < 3 * sum(len(r.id) + 28 * 4 for r in ids)


def test_an_append_stores_no_day_twice(spark, small, monkeypatch):
    stored, real = [], panel_store.measured
    monkeypatch.setattr(panel_store, "measured", lambda df: stored.append(real(df)) or stored[-1])
    rows = QUERIES["append_week"](spark, small)
    # the result lies in the files of the store
    assert rows.count() and all("/block=" in f for f in rows.inputFiles())
    fresh, quiet = stored
    # beside the new days only a row for each silent series
    assert "d" in fresh.columns and "d" not in quiet.columns
    assert quiet.count() == quiet.select("id").distinct().count() > 0
    assert quiet.join(fresh, "id").isEmpty()
