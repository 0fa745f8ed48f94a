"""Search by successive halving: all candidates on a small budget, the better third on three times as much.

The search is a table of rungs (group, candidate, rung, budget, score, kept).
Each rung scores all survivors of all groups in one job and is written, so a
lost executor repeats one rung at most, and the next rung reads who survived.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from shelfcast.operators.seasonal import CHUNK, fit_predict
from shelfcast.session import measured

Scorer = Callable[[DataFrame, float], DataFrame]


def rung_plan(candidates: int, keep: float = 1 / 3, rungs: int = 3) -> list[tuple[int, float]]:
    """Number of candidates, and share of the full budget, of each rung; the last one has all of it."""
    return [(max(1, math.ceil(candidates * keep**k)), keep ** (rungs - 1 - k)) for k in range(rungs)]


def cost(plan: Sequence[tuple[int, float]]) -> float:
    """Work of a search in fits with the full budget."""
    return sum(n * budget for n, budget in plan)


def successive_halving(
    groups: DataFrame, candidates: int, score: Scorer, by: Sequence[str], keep: float = 1 / 3, rungs: int = 3
) -> DataFrame:
    """The table of rungs, ``by, candidate, rung, budget, score, kept``; in the last rung ``kept`` marks the best.

    ``groups`` has one row per group; ``score`` gives ``by, candidate, score`` of
    the survivors (``by, candidate``) on a share of the full budget.  A NULL
    score is worse than any other; equal scores go by the candidate's number.
    """
    by = list(by)
    survivors = groups.select(*by).distinct().withColumn("candidate", F.explode(F.sequence(F.lit(0), F.lit(candidates - 1))))
    plan, table = rung_plan(candidates, keep, rungs), None
    for rung, (_, budget) in enumerate(plan):
        left = plan[rung + 1][0] if rung + 1 < len(plan) else 1
        # a group has as many rows as candidates
        place = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").asc_nulls_last(), "candidate"))
        scored = measured(
            score(survivors, budget).select(*by, "candidate", "score")
            .withColumns({"rung": F.lit(rung), "budget": F.lit(float(budget))}).withColumn("kept", place <= left))
        survivors = scored.filter("kept").select(*by, "candidate")
        table = scored if table is None else table.unionByName(scored)
    return table


def winners(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by, candidate, score`` of the best of each group: those that the last rung keeps."""
    last = table.agg(F.max("rung")).scalar()
    return table.filter(F.col("kept") & (F.col("rung") == last)).select(*by, "candidate", "score")


def series_scorer(series: DataFrame, candidates: Sequence[dict], train_last: int, keys: Sequence[str], steps: int = 28) -> Scorer:
    """Scaled errors on the last ``steps`` days of history; the budget is the share of the days before that are fitted.

    A series is sent once per CHUNK survivors; it has one row per day.
    """
    keys, cutoff = list(keys), train_last - steps
    history = series.filter(F.col("d") <= train_last)

    def score(survivors: DataFrame, budget: float) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("candidate")) - 1
        chunks = survivors.withColumn("_chunk", F.floor(place / CHUNK)).groupBy(*keys, "_chunk").agg(
            F.array_sort(F.collect_list("candidate")).alias("_chosen"))

        def run(days: pd.DataFrame) -> pd.DataFrame:
            days = days.sort_values("d").reset_index(drop=True)
            held = (days["d"] > cutoff).to_numpy()
            before = days.loc[~held, "y"].to_numpy(float)
            scale = np.mean(np.diff(before) ** 2) if len(before) > 1 else 0.0
            # the scale is that of the whole history; the fit sees its last days only
            cut = max(0, len(before) - math.ceil(budget * len(before)))
            recent, ahead = days.iloc[cut:].reset_index(drop=True), held[cut:]
            rows = []
            for i in days["_chosen"].iloc[0]:
                value = None
                if held.any() and scale > 0:
                    error = recent["y"].to_numpy(float)[ahead] - fit_predict(recent, candidates[i], cutoff)[ahead]
                    value = float(np.sqrt(np.mean(error**2) / scale))
                rows.append([*days.loc[0, keys], int(i), value])
            return pd.DataFrame(rows, columns=[*keys, "candidate", "score"])

        fields = [T.StructField(k, series.schema[k].dataType) for k in keys]
        schema = T.StructType(fields + [T.StructField("candidate", T.IntegerType()), T.StructField("score", T.DoubleType())])
        return history.join(chunks, keys).groupBy(*keys, "_chunk").applyInPandas(run, schema)

    return score
