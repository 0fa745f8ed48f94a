"""Mixing sources to target weights by systematic sampling.

A source's rate is its target over its size, the same for each of its
documents.  Prefix sums of the expected copies run over the documents of the
source ordered by size, one random offset is added, and a document is taken once
for each whole number that its step crosses.  Ordering by size makes the walk
meet every size class in proportion, so the words taken differ from the target
by about one document.  Prefix sums come from a range-partitioned rank: a
source with a third of all rows is spread over many tasks.

Defined results: a NULL text has size 0; the NULL source is the last source.
Rows that tie in size and id are interchangeable.  An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.functions.numeric import hashed_uniform
from shelfcast.llm.common import fresh, store, with_row, word_count
from shelfcast.operators.ordering import ranged_index

WEIGHTS = (5, 2, 1)
MOST = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: ``no_source, source, source_size, target``; one row per source, so a plain window is enough.

    The targets share out the total by weight, none above ``most`` times its
    source's size.  Resharing the excess until none is above ends at one water
    level; the capped sources are the first ones in order of cap over weight,
    and a source is capped when its cap is below the level with all sources
    before it capped.
    """
    order = Window.orderBy("no_source", "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "source")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    capped = F.when(F.col("is_capped"), F.col("cap")).otherwise(F.lit(0))
    free = F.when(F.col("is_capped"), F.lit(0)).otherwise(F.col("weight"))
    return (
        sizes.groupBy("no_source", "source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "is_capped",
            F.col("cap").cast("double") * F.col("weight_left")
            <= (F.col("total") - F.col("cap_before")).cast("double") * F.col("weight"),
        )
        .withColumn("rest", F.col("total") - F.sum(capped).over(every))
        .withColumn("free_weight", F.sum(free).over(every))
        .select(
            "no_source", "source", "source_size",
            F.when(F.col("is_capped"), F.col("cap").cast("double"))
            .otherwise(F.col("rest").cast("double") * F.col("weight") / F.col("free_weight")).alias("target"),
        )
    )


def copies(sizes: DataFrame, seed: int = 0) -> DataFrame:
    """``sizes`` (``_row, id, no_source, source, size``) with ``source_size, target, copies`` added."""
    targets = store(source_targets(sizes), "mix-targets")
    ranked = ranged_index(
        sizes, [F.col("size"), F.col("id").asc_nulls_first(), F.col("_row")], ["no_source", "source"], "place"
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    walked = lambda place: F.floor(place.cast("double") * F.col("rate") + F.col("offset"))
    return (
        ranked.join(targets, ["no_source", "source"])
        .withColumn("rate", rate)
        .withColumn("offset", hashed_uniform("no_source", "source", seed=seed))
        .withColumn("copies", (walked(F.col("place") + 1) - walked(F.col("place"))).cast("long"))
        .drop("rate", "offset", "place")
    )


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """One row per document: ``id, size, source_size, target, taken, copies``."""
    sizes = store(measured(docs, F.monotonically_increasing_id(), id, text, source), "mix-sizes")
    return copies(sizes, seed).select(
        F.col("id").alias(id), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def measured(docs: DataFrame, row: Column, id: str, text: str, source: str) -> DataFrame:
    return docs.select(
        row.alias("_row"),
        F.col(id).alias("id"),
        F.col(source).isNull().cast("int").alias("no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        word_count(F.col(text)).alias("size"),
    )


def mixed(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    row = fresh(docs.columns, "_row")
    frozen = store(with_row(docs, row), "mix-input")
    sizes = store(measured(frozen, F.col(row), id, text, source), "mix-sizes")
    times = copies(sizes, seed).filter("copies > 0").select(F.col("_row").alias(row), F.col("copies").alias("_times"))
    name = fresh(docs.columns, "_times")
    times = times.withColumnRenamed("_times", name)
    copy = fresh([*docs.columns, row, name], "_copy")
    return (
        frozen.join(times, row)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(name).cast("int"))))
        .select(*docs.columns)
    )
