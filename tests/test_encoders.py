"""Out-of-fold means, sparse rows and exact samples against plain Python."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.numeric import hashed_uniform
from shelfcast.operators.aggregates import out_of_fold_means, target_means
from shelfcast.operators.projection import category_dictionary
from shelfcast.operators.reshape import sparse_rows
from shelfcast.operators.sampling import rank_bin, sample_rows, sample_weighted, smallest


def folded_means(rows, smoothing):
    """(row, mean over the rows of its category in other folds) by plain sums."""
    out = {}
    for k, category, target, fold in rows:
        others = [t for _, _, t, f in rows if f != fold and t is not None]
        own = [t for _, c, t, f in rows if f != fold and c == category and t is not None]
        prior = sum(others) / len(others) if others else None
        weight = len(own) + smoothing
        out[k] = (sum(own) + smoothing * prior) / weight if prior is not None and weight else prior
    return out


@pytest.mark.parametrize("smoothing", [0.0, 3.0])
def test_out_of_fold_means(spark, smoothing):
    r = random.Random(3)
    rows = [(k, r.choice(["a", "b", "c", None]), r.choice([1.0, 2.0, 7.0, None]), k % 4) for k in range(80)]
    rows += [(100, "single", 5.0, 1), (101, "empty", None, 2)]
    df = spark.createDataFrame(rows, "k int, cat string, y double, fold int").repartition(3)
    got = out_of_fold_means(df, "cat", "y", F.col("fold"), smoothing)
    assert got.columns == ["k", "cat", "y", "fold", "cat_mean"]
    found = {r.k: r.cat_mean for r in got.collect()}
    expected = folded_means(rows, smoothing)
    assert len(found) == len(rows) and all(abs(found[k] - expected[k]) < 1e-12 for k in expected)


def test_one_fold_has_no_others(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "cat string, y double")
    assert [r.cat_mean for r in out_of_fold_means(df, "cat", "y", F.lit(0)).collect()] == [None, None]
    assert out_of_fold_means(df.limit(0), "cat", "y", F.lit(0)).count() == 0


def test_random_target_encodes_to_no_signal(spark):
    """Means that include the row's own target tell something about noise; out-of-fold means do not."""
    noise = spark.range(30_000).select(
        "id", (F.col("id") % 6000).alias("cat"), hashed_uniform(F.col("id").cast("string"), seed=1).alias("y"))
    fold = F.floor(hashed_uniform(F.col("id").cast("string"), seed=2) * 5)
    leaky = noise.join(target_means(noise, "cat", "y"), "cat").agg(F.corr("y", "cat_mean")).first()[0]
    clean = out_of_fold_means(noise, "cat", "y", fold, 5.0).agg(F.corr("y", "cat_mean")).first()[0]
    assert leaky > 0.4 and abs(clean) < 0.03


def test_sparse_rows(spark):
    r = random.Random(5)
    cells = [(r.randrange(6), f"v{r.randrange(40)}", r.choice([0.0, 1.0, 2.5])) for _ in range(300)] + [(1, None, 4.0), (9, "v1", 0.0)]
    df = spark.createDataFrame(cells, "row int, item string, x double").repartition(3)
    dictionary = category_dictionary(df, ["item"])
    code = {r["value"]: r["code"] for r in dictionary.collect()}
    assert code == {v: i for i, v in enumerate([None, *sorted({c for _, c, _ in cells if c})])}
    dense = collections.defaultdict(float)
    for row, item, x in cells:
        dense[row, code[item]] += x
    found = {}
    for b in sparse_rows(df, ["row"], "item", dictionary, "x", block=16).collect():
        assert b.indices == sorted(b.indices) and {i // 16 for i in b.indices} == {b.block}
        found.update({(b.row, i): v for i, v in zip(b.indices, b["values"])})
    assert found == {k: v for k, v in dense.items() if v}


def test_a_hundred_thousand_columns(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("row"), F.concat(F.lit("c"), "id").alias("item"), F.lit(1).alias("x"))
    rows = sparse_rows(df, ["row"], "item", category_dictionary(df, ["item"]), "x")
    sums = rows.agg(F.sum(F.size("indices")).alias("cells"), F.max(F.size("indices")).alias("most"), F.max("block").alias("block")).first()
    assert (sums.cells, sums.block) == (100_000, 100_000 // 4096) and sums.most <= 4096


def test_smallest_is_exact(spark):
    r = random.Random(8)
    ranks = [r.choice([0.0, 2.0**-80, 0.25, 0.5, r.random(), r.random() * 1e6]) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(ranks)), "k int, x double").repartition(4)
    order = [k for _, k in sorted((x, k) for k, x in enumerate(ranks))]
    for n in (0, 1, 7, 130, 499, 500, 900):
        got = smallest(df, F.col("x"), ["k"], n)
        assert got.columns == ["k", "x"] and sorted(row.k for row in got.collect()) == sorted(order[:n])
    assert smallest(df.limit(0), F.col("x"), ["k"], 3).count() == 0


def test_bins_are_few_and_in_order(spark):
    ranks = np.sort(np.concatenate([[0.0], 2.0 ** np.random.default_rng(1).uniform(-70, 70, 5000)]))
    bins = [r.b for r in spark.createDataFrame([(float(x),) for x in ranks], "x double").select(rank_bin(F.col("x")).alias("b")).collect()]
    assert bins == sorted(bins) and len(set(bins)) < 64 * 140


def test_samples_repeat_and_weigh(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 4).alias("w"))
    first = {r.id for r in sample_rows(df, 300, ["id"], seed=4).collect()}
    assert len(first) == 300 and first == {r.id for r in sample_rows(df.repartition(7), 300, ["id"], seed=4).collect()}
    drawn = collections.Counter(r.w for r in sample_weighted(df, 1200, F.col("w"), ["id"], seed=4).collect())
    assert sum(drawn.values()) == 1200 and drawn[0] == 0 and 2.3 < drawn[3] / drawn[1] < 3.9
