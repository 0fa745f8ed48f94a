"""Column selection, filters, null handling, casts and encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.operators.ordering import ranged_index

# Columns that are not model features, and the categorical ones.
NOT_FEATURES = ["id", "date", "sales", "d", "wm_yr_wk", "weekday", "rate"]
CATEGORICAL = [
    "item_id", "dept_id", "store_id", "cat_id", "state_id",
    "event_name_1", "event_name_2", "event_type_1", "event_type_2",
]


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def rename_steps(df: DataFrame, train_last: int, steps: int = 28) -> DataFrame:
    """Horizon columns ``F1..`` to the day columns they stand for."""
    return df.withColumnsRenamed({f"F{i}": f"d_{train_last + i}" for i in range(1, steps + 1)})


def trailing_slice(df: DataFrame, day: date, days: int = 366, column: str = "date") -> DataFrame:
    """Rows of the ``days`` days before ``day`` and of ``day`` itself."""
    return df.filter(F.col(column).between(F.lit(day - timedelta(days=days)), F.lit(day)))


def pick_by_group(group: str, choices: Mapping[str, str], default: str) -> Column:
    """The column named by ``choices`` for the row's group, else ``default``."""
    picked: Column | None = None
    for value, column in choices.items():
        condition = F.col(group) == value
        picked = F.when(condition, F.col(column)) if picked is None else picked.when(condition, F.col(column))
    return F.col(default) if picked is None else picked.otherwise(F.col(default))


def mask_from(value: str, day: str, start: int) -> Column:
    """NULL from ``start`` on: the forecast period has no target."""
    return F.when(F.col(day) < start, F.col(value))


def cast_features(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Categorical features to int and numeric ones to float, in one projection."""
    types = {**{c: "int" for c in categorical}, **{c: "float" for c in numeric}}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def temporal_split(day: str, train_after: int = 800, test_from: int = 1886, validation_from: int = 1914) -> Column:
    d = F.col(day)
    return (
        F.when(d >= validation_from, "validation")
        .when(d >= test_from, "test")
        .when(d > train_after, "train")
    )


def category_dictionary(df: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Ordinal codes ``(attribute, value, code)`` of several attributes.

    Codes follow the value order and a NULL, where present, takes code 0.  The
    distinct values of all attributes are found in one pass, and ranked by range
    so that an attribute with very many values is not ranked by one task.
    """
    pairs = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    coded = ranged_index(values, [F.col("value").asc_nulls_first()], ["attribute"], "code")
    return coded.select("attribute", "value", F.col("code").cast("int").alias("code"))


def encode_categories(df: DataFrame, dictionary: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Replace each attribute by its code; NULL is a value like any other.

    No broadcast is forced: a dictionary below Spark's own size threshold is
    broadcast, a larger one is joined by shuffle.
    """
    for attribute in attributes:
        codes = dictionary.filter(F.col("attribute") == attribute).select(
            F.col("value").alias("_value"), F.col("code").alias("_code")
        )
        df = (
            df.join(codes, F.col(attribute).cast("string").eqNullSafe(F.col("_value")), "left")
            .withColumn(attribute, F.col("_code"))
            .drop("_value", "_code")
        )
    return df


def distinct_values(df: DataFrame, column: str) -> list:
    """The distinct values of an attribute that is to become columns, in order."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One 0/1 column per value; the original column is dropped."""
    flags = [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values]
    return df.select(*[c for c in df.columns if c != column], *flags)


# Integer types by width, with the open range a column must lie in.
INTEGER_RANGES = [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)]
FLOAT_MAX = 3.4028234663852886e38


def tight_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the narrowest type that holds its range.

    One aggregate finds all ranges.  Spark has no half-width float, so floats
    become ``float`` or stay ``double``.
    """
    integers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.IntegralType)]
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    if not integers + floats:
        return df
    bounds = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in integers + floats],
        *[F.max(c).alias(f"max_{c}") for c in integers + floats],
    ).first()
    target = {}
    for c in integers + floats:
        low, high = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if low is None:
            continue
        if c in integers:
            for name, bits in INTEGER_RANGES:
                if low > -(2 ** (bits - 1)) and high < 2 ** (bits - 1) - 1:
                    target[c] = name
                    break
        elif low > -FLOAT_MAX and high < FLOAT_MAX:
            target[c] = "float"
    return df.select(*[F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])
