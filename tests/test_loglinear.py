"""Proportional fitting of shares against the multinomial maximum, and refits from stored state."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.loglinear import fit_shares, margin_gap, share_cells
from shelfcast.operators.refit import poisson_fit, store_fit, stored_start

MARGINS = [["store"], ["wday"], ["quarter"]]


@pytest.fixture(scope="module")
def sales(spark):
    r = random.Random(4)
    rows = [
        (f"d{i % 2}", f"i{i}", f"s{s}", w, q, float(r.randint(0, 9) * (1 + i % 5)))
        for i, s, w, q in itertools.product(range(20), range(2), range(3), range(2)) if (i * 7 + s) % 11
    ]
    return spark.createDataFrame(rows, "dept string, item string, store string, wday int, quarter int, sales double").repartition(4)


@pytest.fixture(scope="module")
def found(sales):
    cells = share_cells(sales, ["dept"], ["item", "store"], sales.select("wday", "quarter").distinct())
    return fit_shares(cells, "item", ["dept"], MARGINS, ["store", "wday", "quarter"], cycles=25).toPandas()


def softmax_newton(cells):
    """The multinomial maximum by numpy: damped Newton steps on one weight per item and margin value."""
    names = [[("item", m[0], i, v) for i, v in sorted(set(zip(cells["item"], cells[m[0]])))] for m in MARGINS]
    column = {n: k for k, n in enumerate(itertools.chain(*names))}
    X = np.zeros((len(cells), len(column)))
    for row, cell in enumerate(cells.to_dict("records")):
        for m in MARGINS:
            X[row, column["item", m[0], cell["item"], cell[m[0]]]] = 1
    contexts = cells.groupby(["store", "wday", "quarter"]).ngroup().to_numpy()
    seen, w = cells["seen"].to_numpy(), np.zeros(X.shape[1])
    total = np.bincount(contexts, seen)[contexts]
    for _ in range(60):
        e = np.exp(X @ w)
        p = e / np.bincount(contexts, e)[contexts]
        centred = X - np.stack([np.bincount(contexts, p * X[:, k]) for k in range(X.shape[1])], 1)[contexts]
        w = w + np.linalg.lstsq(centred.T @ (centred * (total * p)[:, None]), X.T @ (seen - total * p), rcond=1e-10)[0]
    return p


def test_shares_equal_the_multinomial_maximum(found):
    for _, cells in found.groupby("dept"):
        cells = cells.reset_index(drop=True)
        assert np.abs(softmax_newton(cells) - cells["share"].to_numpy()).max() < 1e-6


def test_shares_add_up_and_margins_are_met(sales, found):
    assert np.allclose(found.groupby(["dept", "store", "wday", "quarter"])["share"].sum(), 1.0)
    assert (found["share"] > 0).all()
    for margin in MARGINS:
        sums = found.groupby(["item", *margin])[["seen", "fit"]].sum()
        assert np.allclose(sums["seen"], sums["fit"], rtol=1e-7)
    sold = sales.filter("sales > 0").select("item", "store").distinct().count()
    assert len(found) == sold * 6 and abs(found["seen"].sum() - 1.1 * sales.agg(F.sum("sales")).first()[0]) < 1e-6


def test_no_sales_give_no_shares(sales):
    cells = share_cells(sales.limit(0), ["dept"], ["item", "store"], sales.select("wday", "quarter").distinct())
    fit = fit_shares(cells, "item", ["dept"], MARGINS, ["store", "wday", "quarter"], 2)
    assert fit.count() == 0 and margin_gap(fit, ["item"]).count() == 0


@pytest.fixture(scope="module")
def counts(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(4000, 3))
    y = r.poisson(np.exp(1.0 + x @ [0.5, -0.3, 0.0]))
    rows = [(*map(float, a), float(b), i) for i, (a, b) in enumerate(zip(x, y))]
    rows += [(None, 0.0, 0.0, 5.0, 1), (0.0, 0.0, 0.0, None, 2)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, n int").cache()


FEATURES = ["a", "b", "c"]


def test_fit_solves_the_likelihood_equations(counts):
    fit = poisson_fit(counts, FEATURES, "y")
    rows = counts.na.drop("any").toPandas()
    X = np.column_stack([np.ones(len(rows)), rows[FEATURES]])
    assert np.abs(X.T @ (rows["y"] - np.exp(X @ fit.coefficients))).max() < 1e-3
    assert np.allclose(fit.coefficients, [1.0, 0.5, -0.3, 0.0], atol=0.06)


def test_refit_from_stored_state(spark, counts, tmp_path):
    path = str(tmp_path / "fit")
    store_fit(spark, path, FEATURES, poisson_fit(counts.filter("n < 3500"), FEATURES, "y"))
    start = stored_start(spark, path, FEATURES)
    cold, warm = poisson_fit(counts, FEATURES, "y"), poisson_fit(counts, FEATURES, "y", start)
    assert np.allclose(cold.coefficients, warm.coefficients, atol=1e-6) and warm.passes < cold.passes
    assert stored_start(spark, path, ["c", "new"]) == [start[0], start[3], 0.0]


def test_bad_start_and_collinear_features(counts):
    twice = counts.withColumn("d", F.col("a") * 2)
    good = poisson_fit(counts, FEATURES, "y")
    bad = poisson_fit(counts, FEATURES, "y", [-4.0, 3.0, 2.0, -2.0])
    assert np.allclose(good.coefficients, bad.coefficients, atol=1e-5)
    both = poisson_fit(twice, [*FEATURES, "d"], "y").coefficients
    assert abs(both[1] + 2 * both[4] - good.coefficients[1]) < 1e-5


def test_nothing_to_fit(counts):
    assert poisson_fit(counts.limit(0), FEATURES, "y").coefficients == [0.0] * 4
    assert poisson_fit(counts.withColumn("y", F.lit(0.0)), FEATURES, "y") == ([0.0] * 4, 0)
