"""The block bootstrap against its own draws by hand, and against draws of single rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions.numeric import drawn_poisson, mixed_draw
from shelfcast.operators.evaluation import BOOTSTRAP_BLOCKS, bootstrap_block_means, bootstrap_means

THRESHOLDS = np.cumsum([np.exp(-1)] + list(np.exp(-1) / np.cumprod(np.arange(1, 12, dtype=float))))


def rows_of(spark, n, seed=1):
    r = np.random.default_rng(seed)
    rows = [(m, k, float(v)) for m in ("a", "b") for k, v in enumerate(r.gamma(2.0, 3.0, n) * (1 if m == "a" else 2))]
    return rows, spark.createDataFrame(rows, "model string, id int, residual double").repartition(5)


def draw_by_hand(a, b, seed):
    m, (k1, k2, k3, k4) = 2**31 - 1, (742938285, 950706376, 1226874159, 62089911)
    x = (a + seed + 1) * k1 % m
    x = (x ^ b * k4 % m) * k2 % m
    x = (x ^ a * k3 % m) * k3 % m
    return (x ^ b) * k4 % m


def test_draws_are_uniform_and_poisson(spark):
    df = spark.range(400).select(F.col("id").alias("a")).crossJoin(spark.range(500).select(F.col("id").alias("b")))
    drawn = df.select("a", "b", mixed_draw(F.col("a"), F.col("b"), 3).alias("x")).withColumn("w", drawn_poisson(F.col("x"))).toPandas()
    assert (drawn.x == [draw_by_hand(int(a), int(b), 3) for a, b in zip(drawn.a, drawn.b)]).all()
    assert (drawn.w == [(x / (2**31 - 1) >= THRESHOLDS).sum() for x in drawn.x]).all()
    u = drawn.x / (2**31 - 1)
    assert abs(u.mean() - 0.5) < 0.002 and abs(u.var() * 12 - 1) < 0.01
    assert abs(drawn.w.mean() - 1) < 0.01 and abs(drawn.w.var() - 1) < 0.02
    table = drawn.pivot(index="a", columns="b", values="w").to_numpy()
    for side in (table, table.T):  # neither blocks nor replicates go together
        c = np.corrcoef(side[:200])
        assert np.abs(c - np.eye(200)).max() < 5.5 / np.sqrt(side.shape[1])


@pytest.mark.parametrize("replicates", [1, 10])
def test_replicates_by_hand(spark, replicates):
    rows, df = rows_of(spark, 300)
    got = {(r.model, r.rep): r.mean_residual for r in bootstrap_block_means(df, ["id"], replicates, seed=5, blocks=16).collect()}
    sums = {}
    for model, id, v in rows:
        block = int(hashlib.md5(f"{id}|5".encode()).hexdigest()[:8], 16) % 16
        n, s = sums.get((model, block), (0, 0.0))
        sums[model, block] = (n + 1, s + v)
    expected = {}
    for rep in range(replicates):
        for model in ("a", "b"):
            n = s = 0
            for b in range(16):
                w = int((draw_by_hand(b, rep, 5) / (2**31 - 1) >= THRESHOLDS).sum())
                n, s = n + w * sums.get((model, b), (0, 0))[0], s + w * sums.get((model, b), (0, 0))[1]
            expected[model, rep] = s / n
    assert got.keys() == expected.keys()
    assert np.allclose([got[k] for k in got], [expected[k] for k in got])


def test_spread_is_that_of_single_rows(spark):
    """Against the law of single rows' draws; a block bootstrap's spread has the standard error of its blocks."""
    rows, df = rows_of(spark, 6000)
    replicates, ratios = 3000, []
    for seed in range(3):
        means = bootstrap_block_means(df, ["id"], replicates, seed=seed).groupBy("model").agg(
            F.stddev_pop("mean_residual").alias("std"), F.avg("mean_residual").alias("mean"), F.count(F.lit(1)).alias("n"))
        for b in means.collect():
            own = np.array([v for m, _, v in rows if m == b.model])
            ratios.append(b.std / (own.std() / np.sqrt(len(own))))
            assert b.n == replicates and abs(b.mean - own.mean()) < 0.1 * b.std
    error = np.sqrt(0.5 / BOOTSTRAP_BLOCKS + 0.5 / replicates)
    assert max(abs(x - 1) for x in ratios) < 3 * error and abs(np.mean(ratios) - 1) < 0.02


def test_rows_and_blocks_agree_where_each_row_is_a_block(spark):
    """Few rows in many blocks: both ways draw for single rows, and have one law."""
    _, df = rows_of(spark, 200)
    std = lambda means: {r.model: r.s for r in means.groupBy("model").agg(F.stddev_pop("mean_residual").alias("s")).collect()}
    rowwise, blocked = std(bootstrap_means(df, ["id", "model"], 2000, seed=1)), std(bootstrap_block_means(df, ["id"], 2000, seed=1, blocks=1 << 20))
    assert all(abs(blocked[m] / rowwise[m] - 1) < 0.06 for m in rowwise)
