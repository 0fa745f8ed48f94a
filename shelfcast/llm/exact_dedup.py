"""Exact duplicates by progressive refinement: length, then a prefix's hash, then the full hash.

Texts are equal when they are identical after every run of white space became
one space.  One pass over the texts writes a sketch: length, prefix hash, and
the digest that is reported for every row.  Refinement then decides what is
compared: rows whose length occurs once are settled from the length column
alone; only rows that share a length are grouped by prefix hash, and only rows
that share both have their digest read and shuffled.  No text is shuffled.

Defined results: NULL text counts as empty, and empty texts are copies of each
other.  A NULL id sorts last, so it stays only in a group without any other id.
Of rows that repeat id and text exactly one stays.  An empty table gives none.
Input columns other than id and text are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import SPACE, attach_groups, fresh, store, with_row

PREFIX = 64


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sketch(docs: DataFrame, row: Column, id: str, text: str) -> DataFrame:
    """Per row: ``_row, id, length, prefix_hash, digest``; stored, so that row numbers hold."""
    own = docs.select(row.alias("_row"), F.col(id).alias("id"), normal(F.col(text)).alias("normal"))
    return store(
        own.select(
            "_row",
            "id",
            F.octet_length("normal").alias("length"),
            F.xxhash64(F.substring("normal", 1, PREFIX)).alias("prefix_hash"),
            F.sha2(F.col("normal").cast("binary"), 256).alias("digest"),
        ),
        "exact-sketch",
    )


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that share ``keys`` with another row."""
    shared = store(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys), "exact-level")
    return rows.join(shared, keys, "left_semi")


def decide(rows: DataFrame) -> DataFrame:
    """The sketch with ``keep_id, group_size, kept`` added."""
    suspects = repeated(repeated(rows, ["length"]), ["length", "prefix_hash"])
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row"))
    groups = store(
        suspects.groupBy("length", "prefix_hash", "digest")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.id").alias("first_id"), F.col("first._row").alias("first_row"), "n"),
        "exact-groups",
    )
    joined = attach_groups(rows, groups, "digest", "n")
    alone = F.col("n").isNull()
    return joined.select(
        *rows.columns,
        F.when(alone, F.col("id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("_row") == F.col("first_row"))).alias("kept"),
    )


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id, keep_id, group_size, kept, text_sha256``."""
    return decide(sketch(docs, F.monotonically_increasing_id(), id, text)).select(
        F.col("id").alias(id), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    row = fresh(docs.columns, "_row")
    frozen = store(with_row(docs, row), "exact-input")
    gone = decide(sketch(frozen, F.col(row), id, text)).filter(~F.col("kept"))
    return frozen.join(gone.select(F.col("_row").alias(row)), row, "left_anti").select(*docs.columns)
