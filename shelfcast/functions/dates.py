"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_parts(date: str = "date") -> dict[str, Column]:
    """Calendar features by name; ``week`` is the ISO week."""
    d = F.col(date)
    return {
        "wday": F.weekday(d).cast("smallint"),
        "week": F.weekofyear(d).cast("smallint"),
        "month": F.month(d).cast("smallint"),
        "quarter": F.quarter(d).cast("smallint"),
        "year": F.year(d).cast("smallint"),
        "mday": F.dayofmonth(d).cast("smallint"),
    }


def week_of_month(date: str = "date") -> Column:
    return F.ceil(F.dayofmonth(F.col(date)) / 7).cast("smallint")


def is_weekend(date: str = "date") -> Column:
    return F.weekday(F.col(date)) >= 5


def parse_day(label: str = "d") -> Column:
    """``d_123`` to 123; days are ordered as integers, never as text."""
    return F.substring(F.col(label), 3, 10).cast("int")


def fourier_terms(day: Column, period: float, order: int, prefix: str) -> list[Column]:
    """``sin`` and ``cos`` of the first ``order`` harmonics of ``period`` days."""
    import math

    terms = []
    for k in range(1, order + 1):
        angle = day * F.lit(2 * math.pi * k / period)
        terms += [F.sin(angle).alias(f"{prefix}_sin_{k}"), F.cos(angle).alias(f"{prefix}_cos_{k}")]
    return terms
