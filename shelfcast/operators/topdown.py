"""Spreading store x department forecasts over items."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfcast.operators.aggregates import share_of_total
from shelfcast.operators.joins import update_join


def spread(forecasts: DataFrame, weights: DataFrame) -> DataFrame:
    """Item forecasts of every forecast model under every weight model.

    ``forecasts``: store, dept, h, forecast_model, volume.
    ``weights``: id, store, dept, h, weight_model, weight.
    All pairs of models arise from one join on store, department and day.
    """
    joined = weights.join(forecasts, ["store_id", "dept_id", "h"])
    return joined.select(
        "id", "h", "forecast_model", "weight_model", (F.col("volume") * F.col("weight")).alias("yhat")
    )


def distribute_volume(forecasts: DataFrame, weights: DataFrame, sample: DataFrame) -> DataFrame:
    """Fill the sample's values from one pair of models; ids without a product keep theirs.

    ``sample``: id, h, yhat.
    """
    return update_join(sample, spread(forecasts, weights), ["id", "h"], "yhat")


def trailing_shares(recent: DataFrame) -> DataFrame:
    """Each item's share of its store x department over the given days."""
    keys = ["id", "item_id", "dept_id", "store_id"]
    volume = recent.groupBy(*keys).agg(F.sum("sales").alias("sales"))
    return share_of_total(volume, ["dept_id", "store_id"], store_totals=True)


def renormalise(predicted: DataFrame, value: str = "share", day: str = "d") -> DataFrame:
    """Scale the predicted shares of one store, department and day to add up to 1.

    Applied to new days only: past days add up to 1 already.
    """
    return share_of_total(predicted, ["dept_id", "store_id", day], value, value)
