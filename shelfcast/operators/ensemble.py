"""Blending and stacking of several forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.functions.numeric import clip_zero
from shelfcast.session import measured

# Fixed value: ridge penalty per observation.
RIDGE = 1e-4


def blend(weights: Mapping[str, float]) -> Column:
    """Fixed-weight mixture of model columns."""
    terms = [F.col(model) * F.lit(weight) for model, weight in weights.items()]
    return sum(terms[1:], terms[0])


def gram(df: DataFrame, group: Sequence[str], models: Sequence[str], actual: str) -> DataFrame:
    """Sums that determine a least-squares fit, one row per group.

    The products are summed map-side, so the rows of a group never meet.
    """
    pairs = list(combinations_with_replacement(range(len(models)), 2))
    cross = {p: F.sum(F.col(models[p[0]]) * F.col(models[p[1]])) for p in pairs}
    xtx = F.array(*[cross[min(i, j), max(i, j)] for i in range(len(models)) for j in range(len(models))])
    xty = F.array(*[F.sum(F.col(m) * F.col(actual)) for m in models])
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), xtx.alias("xtx"), xty.alias("xty"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def solve_ridge(n: pd.Series, xtx: pd.Series, xty: pd.Series, penalty: pd.Series) -> pd.Series:
    """Weights of each group from its sums; one small solve per group."""
    out = []
    for count, a, b, p in zip(n, xtx, xty, penalty):
        b = np.asarray(b)
        a = np.asarray(a).reshape(len(b), len(b)) + p * count * np.eye(len(b))
        out.append(np.linalg.pinv(a) @ b)
    return pd.Series(out)


def stack_weights(
    df: DataFrame, group: Sequence[str], models: Sequence[str], actual: str, penalty: float = RIDGE
) -> DataFrame:
    """Ridge weights ``w`` of the models, fitted separately in each group."""
    sums = gram(df, group, models, actual)
    return sums.select(*group, solve_ridge("n", "xtx", "xty", F.lit(penalty)).alias("w"))


def stack_apply(df: DataFrame, weights: DataFrame, group: Sequence[str], models: Sequence[str]) -> DataFrame:
    """``ensemble``: the weighted models of each row, not below zero."""
    joined = df.join(measured(weights), list(group))
    mixed = [F.col("w")[i] * F.col(m) for i, m in enumerate(models)]
    return joined.withColumn("ensemble", clip_zero(sum(mixed[1:], mixed[0]))).drop("w")
