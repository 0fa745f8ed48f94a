"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def with_label(series: str | Column, label: str) -> Column:
    """``<item>_<store>`` to ``<item>_<store>_<label>``."""
    return F.concat_ws("_", series, F.lit(label))


def has_label(id_col: str, label: str) -> Column:
    return F.col(id_col).contains(label)


def relabel(id_col: str, old: str, new: str) -> Column:
    """Replace a trailing horizon label."""
    return F.regexp_replace(F.col(id_col), f"{old}$", new)


def series_key(*columns: str) -> Column:
    return F.concat_ws("_", *columns)


def split_series_key(key: str, head: int = 2) -> tuple[Column, Column]:
    """The first ``head`` tokens, and the rest, of an underscore-joined key."""
    tokens = F.split(F.col(key), "_")
    rest = F.slice(tokens, F.lit(head + 1), F.greatest(F.size(tokens) - head, F.lit(0)))
    return F.substring_index(F.col(key), "_", head), F.array_join(rest, "_")
