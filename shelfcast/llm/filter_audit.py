"""Filter interaction audit with sorted posting lists.

Each filter keeps, for every part of the corpus and stretch of document numbers,
the sorted list of the documents that fail it; so do the two labels.  A stretch
holds at most ``stretch`` documents, however large the part.  The documents that
some filters remove together are the union of their lists; unions are made from
smaller ones by searching the shorter list in the longer one (galloping: each
search starts where the one before ended, in numpy), and so are the parts of a
union with a label.  The sizes of the 32 unions add up over stretches, and all
orders of the filters are told from them: what a filter removes after others is
the growth of the union.

Defined results: a NULL text counts as empty.  A NULL language is the part named
by the empty string.  Document numbers are given to rows, so repeated ids are
documents of their own.  For filter E a NULL id comes after all others, and rows
with the least id of a text are all first.  A document has a label if any of its
rows in ``labels`` says 1.  Labels without an id, and of other documents, are not
looked at, nor are other columns.  Every part has all orders and steps, zeros
included; an empty table has no parts.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shelfcast.llm.common import attach_groups, store

FILTERS = "ABCDE"
STRETCH = 65_536
CAPITALS, SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
GOOD, TOXIC = len(FILTERS), len(FILTERS) + 1


def failing(text: bytes, code_points: int) -> list[bool]:
    """Whether a text fails the filters A to D."""
    words = text.split()  # bytes split at space and \x09-\x0D only
    return [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * (len(text) - len(text.translate(None, CAPITALS))) > 10 * code_points,
        len(text.translate(None, SIGNS)) < len(text),
    ]


def sketch(docs: DataFrame, id: str, text: str, lang: str) -> DataFrame:
    """``doc, id, part, alone, digest``, stored: which of A to D each document fails, and its text's digest."""
    whole = F.coalesce(F.col(text), F.lit(""))

    @F.pandas_udf("alone array<boolean>, digest binary")
    def of(texts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "alone": [failing(t, n) for t, n in zip(texts, sizes)],
            "digest": [hashlib.md5(t, usedforsecurity=False).digest() for t in texts],
        })

    return store(
        docs.select(
            F.monotonically_increasing_id().alias("doc"), F.col(id).alias("id"),
            F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("part"),
            of(whole.cast("binary"), F.char_length(whole)).alias("f"),
        ).select("doc", "id", "part", "f.*"),
        "audit-sketch",
    )


def flagged(rows: DataFrame, labels: DataFrame, id: str, quality: str, toxic: str) -> DataFrame:
    """``doc, part, flags``: the filters that a document fails and the labels it has, by number."""
    copies = store(
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "audit-copies")
    later = attach_groups(rows, copies, "digest", "n").withColumn(
        "late", F.coalesce(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False)))
    told = store(
        labels.filter(F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
        .agg(F.max((F.col(quality) == 1).cast("int")).alias("good"), F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
        .filter("good = 1 OR toxic = 1"),
        "audit-labels",
    )
    own = later.join(told, "id", "left")
    held = [*[F.get("alone", F.lit(k)) for k in range(len(FILTERS) - 1)], F.col("late"), F.col("good") == 1, F.col("toxic") == 1]
    flags = F.array(*[F.when(F.coalesce(h, F.lit(False)), F.lit(k)) for k, h in enumerate(held)])
    return store(own.select("doc", "part", F.array_compact(flags).alias("flags")), "audit-flags")


def postings(flags: DataFrame, stretch: int) -> DataFrame:
    """``part, stretch, list, docs``: sorted lists of the documents of a stretch that fail a filter or have a label."""
    return store(
        flags.select("part", F.expr(f"doc div {stretch}").alias("stretch"), F.explode("flags").alias("list"), "doc")
        .groupBy("part", "stretch", "list").agg(F.sort_array(F.collect_list("doc")).alias("docs")),
        "audit-postings",
    )


def found_in(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which entries of one sorted list are in another one."""
    if not len(other):
        return np.zeros(len(some), dtype=bool)
    place = np.searchsorted(other, some)
    return other[np.minimum(place, len(other) - 1)] == some


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection: the shorter list is searched in the longer one."""
    short, long = sorted((a, b), key=len)
    return int(found_in(short, long).sum())


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge of two sorted lists: entries of the shorter one that are new go where the search ended."""
    short, long = sorted((a, b), key=len)
    new = short[~found_in(short, long)]
    return np.insert(long, np.searchsorted(long, new), new)


def union_sizes(lists: dict[int, np.ndarray]) -> list[tuple[int, int, int, int]]:
    """For each set of filters, as bits: the size of the union of their lists, and what of it is good, and toxic."""
    nothing = np.empty(0, dtype=np.int64)
    of = lambda k: lists.get(k, nothing)
    unions = [nothing]
    for chosen in range(1, 1 << len(FILTERS)):
        top = chosen.bit_length() - 1
        unions.append(union(unions[chosen ^ (1 << top)], of(top)))
    return [(k, len(u), shared(u, of(GOOD)), shared(u, of(TOXIC))) for k, u in enumerate(unions)]


def merged_sizes(lists: DataFrame) -> DataFrame:
    """``part, chosen, n, good, toxic``: sizes of all unions, summed over the stretches of each part."""
    out = T.StructType([T.StructField("part", T.StringType())] + [T.StructField(c, T.LongType()) for c in ("chosen", "n", "good", "toxic")])

    def of(key, group):
        own = {k: np.asarray(d.values) for k, d in zip(group["list"].to_pylist(), group["docs"])}
        sizes = np.array(union_sizes(own), dtype=np.int64)
        return pa.table([pa.array([key[0].as_py()] * len(sizes), pa.string()), *sizes.T.copy()], names=out.names)

    sizes = lists.groupBy("part", "stretch").applyInArrow(of, out)
    return sizes.groupBy("part", "chosen").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang",
    quality: str = "quality", toxic: str = "toxic", stretch: int = STRETCH,
) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there."""
    flags = flagged(sketch(docs, id, text, lang), labels, id, quality, toxic)
    sizes = merged_sizes(postings(flags, stretch))
    # each part's sizes by set of filters: 32 entries
    of_set = F.map_from_entries(F.collect_list(F.struct("chosen", F.struct("n", "good", "toxic"))))
    parts = store(
        flags.groupBy("part").agg(F.count(F.lit(1)).alias("docs"))
        .join(sizes.groupBy("part").agg(of_set.alias("sizes")), "part", "left"),
        "audit-sizes",
    )
    orders = F.array(*[F.lit("".join(o)) for o in permutations(FILTERS)])
    rows = parts.withColumn("filter_order", F.explode(orders)).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, f) > 0, 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))

    def size(chosen: Column, name: str = "n") -> Column:
        return F.coalesce(F.try_element_at("sizes", chosen.cast("long"))[name], F.lit(0).cast("long"))

    before = bits(F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1))
    after = bits(F.substring(F.col("filter_order"), F.lit(1), F.col("step")))
    own, every = after - before, (1 << len(FILTERS)) - 1
    removed = size(after) - size(before)
    same_filter = Window.partitionBy("part", "own")
    return rows.withColumn("own", own).withColumn("removed", removed).select(
        "part", "filter_order", "step", (F.col("docs") - size(after)).alias("kept"), "removed",
        (size(own) - removed).alias("redundant"), (size(F.lit(every)) - size(every - own)).alias("unique_fails"),
        (size(after, "good") - size(before, "good")).alias("good_lost"),
        (size(after, "toxic") - size(before, "toxic")).alias("toxic_lost"),
        F.sum("removed").over(same_filter).alias("shapley"),
    )


SQL = r"""
WITH words AS (
    SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents)
), told AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id
), fails AS MATERIALIZED (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           (len(w) < 100)::INT AS a, (100 * len(list_distinct(w)) < 80 * len(w))::INT AS b,
           (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT AS c,
           regexp_matches(t, '[#$%&*|]')::INT AS d,
           coalesce(doc_id IS DISTINCT FROM min(doc_id) OVER (PARTITION BY t)
               AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL, false)::INT AS e
    FROM words LEFT JOIN told USING (doc_id)
), masks AS MATERIALIZED (
    SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
           count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY 1, 2
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.bit, w.bit, x.bit, y.bit, z.bit] AS bits
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.f, w.f, x.f, y.f, z.f])) = 5
), steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
    FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), rows AS MATERIALIZED (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS removed,
           coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
           coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (mask & own > 0 AND mask & earlier = 0), 0) AS toxic_lost
    FROM masks, steps GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own) AS shapley
FROM rows
"""
