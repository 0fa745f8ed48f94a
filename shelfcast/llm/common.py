"""Helpers shared by the text operators: words, let-bindings, stored tables, joins to skewed groups."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A key with at least 1/HOT_KEYS of all rows is hot, so there are never more than HOT_KEYS hot keys.
HOT_KEYS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_case(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}\z", "")


def words(text: Column, gap: str = SPACE) -> Column:
    """Maximal runs outside ``gap``, in order; an empty array for NULL or a text without any."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), gap), lambda w: w != "")


def word_count(text: Column, gap: str = SPACE) -> Column:
    """Number of words, without keeping them: an empty piece can only be the first or the last one."""
    return let(
        F.split(F.coalesce(text, F.lit("")), gap),
        lambda w: F.size(w) - (F.get(w, F.lit(0)) == "").cast("int")
        - ((F.size(w) > 1) & (F.get(w, F.size(w) - 1) == "")).cast("int"),
    ).cast("long")


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the shared folder.

    The rows are frozen, a lost executor does not replay their history, and the
    planner knows the table's bytes when it chooses a join.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame, row: str = "_row") -> DataFrame:
    """A number for each row, for telling equal rows apart.  Only stable once the rows are stored."""
    return df.withColumn(row, F.monotonically_increasing_id())


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """``rows`` left-joined to one row per group, where a group may hold a third of all rows.

    ``size`` counts the rows of each group.  Groups of at least 1/HOT_KEYS of
    all grouped rows are at most HOT_KEYS many, so they are broadcast and their
    rows stay where they are; the others are joined by a shuffle in which no key
    is hot.  Both inputs should be stored tables, since each is read twice.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    is_hot = F.col(size) * HOT_KEYS >= F.lit(total)
    hot, cold = F.broadcast(groups.filter(is_hot)), groups.filter(~is_hot)
    near = rows.join(hot, key)
    far = rows.join(F.broadcast(groups.filter(is_hot).select(key)), key, "left_anti").join(cold, key, "left")
    return near.unionByName(far)


def fresh(names: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (Spark compares without case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
