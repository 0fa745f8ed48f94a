"""A Poisson regression that can go on from stored coefficients.

Newton's steps need sums of products of features only.  Each pass is one map-side
aggregate of ``p * (p + 1) / 2 + p + 2`` sums, so what reaches the driver is bounded
by the number of features and not by the rows.  A fit that starts from the stored
coefficients of an earlier horizon is close already and needs few passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.operators.models import kept


class Fit(NamedTuple):
    """Coefficients, the intercept first, and the passes over the rows that they took."""

    coefficients: list[float]
    passes: int


def linear_score(features: Sequence[str], coefficients: Sequence[float]) -> Column:
    score = F.lit(float(coefficients[0]))
    for name, c in zip(features, coefficients[1:]):
        score = score + F.lit(float(c)) * F.col(name)
    return score


def _sums(rows: DataFrame, features: Sequence[str], label: str, coefficients: Sequence[float]):
    """Log-likelihood, gradient and information at the given coefficients, in one aggregate."""
    xs = [F.lit(1.0), *[F.col(f) for f in features]]
    p = len(xs)
    at = rows.withColumn("_eta", linear_score(features, coefficients)).withColumn("_mu", F.exp("_eta"))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    row = at.agg(
        F.sum(F.col(label) * F.col("_eta") - F.col("_mu")),
        *[F.sum((F.col(label) - F.col("_mu")) * x) for x in xs],
        *[F.sum(F.col("_mu") * xs[i] * xs[j]) for i, j in pairs],
    ).first()
    gradient, information = np.array(row[1:p + 1], float), np.zeros((p, p))
    for (i, j), value in zip(pairs, row[p + 1:]):
        information[i, j] = information[j, i] = value
    return row[0], gradient, information


def poisson_fit(
    rows: DataFrame, features: Sequence[str], label: str, start: Sequence[float] | None = None, tolerance: float = 1e-10,
    most_passes: int = 60,
) -> Fit:
    """Maximum likelihood with a log link, from ``start`` or from the mean label; rows with a NULL are left out.

    A step that lowers the likelihood is halved.  No rows, or labels that are all
    0, give a fit of zeros in no pass.
    """
    complete = rows.select(*features, label).na.drop("any")
    with kept(complete) as stored:
        mean = stored.agg(F.avg(label)).first()[0]
        if not mean:
            return Fit([0.0] * (len(features) + 1), 0)
        beta = np.array([np.log(mean), *[0.0] * len(features)] if start is None else start, float)
        best, gradient, information = _sums(stored, features, label, beta)
        passes = 1
        while passes < most_passes:
            step = np.linalg.lstsq(information, gradient, rcond=1e-12)[0]
            if gradient @ step <= tolerance * max(1.0, abs(best)):
                # what is left to gain is below the tolerance: take the step and stop
                return Fit((beta + step).tolist(), passes)
            while passes < most_passes:
                found = _sums(stored, features, label, beta + step)
                passes += 1
                if found[0] is not None and np.isfinite(found[0]) and found[0] >= best:
                    break
                step = step / 2
            beta, (best, gradient, information) = beta + step, found
    return Fit(beta.tolist(), passes)


def store_fit(spark: SparkSession, path: str, features: Sequence[str], fit: Fit) -> None:
    named = list(enumerate(["(intercept)", *features]))
    rows = [(i, name, float(c)) for (i, name), c in zip(named, fit.coefficients)]
    spark.createDataFrame(rows, "position int, feature string, coefficient double").coalesce(1).write.mode("overwrite").parquet(path)


def stored_start(spark: SparkSession, path: str, features: Sequence[str]) -> list[float]:
    """Coefficients of a stored fit, in the order of ``features``; a feature that it lacks starts at 0."""
    known = {r["feature"]: r["coefficient"] for r in spark.read.parquet(path).collect()}
    return [known.get(name, 0.0) for name in ["(intercept)", *features]]
