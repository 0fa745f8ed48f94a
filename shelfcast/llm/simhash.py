"""Near duplicates by SimHash: pigeonhole blocks, joins on blocks, verified Hamming distance.

A fingerprint is cut into five blocks.  Two fingerprints that differ in at most
two bits agree in at least three blocks, so one of the ten choices of three
blocks finds every such pair.  Fingerprints are compared once each, however
many documents share one.  A block value with few fingerprints is joined with
itself and every pair is verified.  A crowded block value (a large group of
near copies) would make pairs with the square of its size; there each
fingerprint is written under itself and its one-bit variants outside the
blocks: two fingerprints differ in at most two bits exactly if they share one of
those, so each shared one links its members to their smallest.  Both ways are
exact and find the same components.

Defined results: NULL and empty texts have fingerprint zero and are linked like
any other.  The component id is the smallest id that is not NULL.  Of rows that
repeat id and text the filter keeps one.  An empty table gives none.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.llm.common import LOWER, UPPER, attach_groups, fresh, store, with_row
from shelfcast.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans(UPPER, LOWER)
BITS = 2
BLOCKS = 5
CROWDED = 32
# Shingles hashed at a time, so that memory does not follow the longest text.
CHUNK = 65_536


def fingerprint(text: str | None, size: int) -> int:
    """Signed 64-bit SimHash of the word shingles of one text."""
    if not text:
        return 0
    words = WORD.findall(text.translate(FOLD))
    if not words:
        return 0
    count = max(1, len(words) - size + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, CHUNK):
        part = words[start:start + CHUNK + size - 1]
        shingles = zip(*(part[k:] for k in range(size))) if len(part) >= size else [part]
        hashes = np.fromiter((digest(" ".join(s), 42) for s in shingles), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(text: Column, size: int) -> Column:
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, size)).astype("int64")

    return of(text)


def block_masks() -> list[int]:
    """Masks, as signed longs, of the choices of blocks; two differing bits spare one choice at least."""
    edges = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, BLOCKS - BITS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` between fingerprints (``fp``, distinct) within two differing bits.

    Not every such pair, but every component of close fingerprints comes out connected.
    """
    masks = F.array(*[F.lit(m) for m in block_masks()])
    keyed = store(
        prints.select("fp", F.posexplode(masks).alias("choice", "mask"))
        .select("choice", F.col("fp").bitwiseAND(F.col("mask")).alias("block"), "fp"),
        "simhash-blocks",
    )
    filled = store(keyed.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-filled")
    few = keyed.join(filled.filter(F.col("n") <= CROWDED).drop("n"), ["choice", "block"], "left_semi")
    pairs = (
        few.alias("x").join(few.alias("y"), ["choice", "block"])
        .filter("x.fp < y.fp").filter(F.bit_count(F.expr("x.fp ^ y.fp")) <= BITS)
        .selectExpr("x.fp AS a", "y.fp AS b")
    )
    crowd = keyed.join(filled.filter(F.col("n") > CROWDED).drop("n"), ["choice", "block"], "left_semi")
    one_bit = F.array(F.lit(0).cast("long"), *[F.lit(-(1 << 63) if k == 63 else 1 << k) for k in range(64)])
    outside = F.filter(one_bit, lambda f: f.bitwiseAND(F.get(masks, F.col("choice"))) == 0)
    shared = store(
        crowd.withColumn("flip", F.explode(outside))
        .select("choice", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"), "fp"),
        "simhash-crowded",
    )
    stars = shared.groupBy("choice", "near").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    far = shared.join(stars.drop("n"), ["choice", "near"]).filter("fp > least").selectExpr("least AS a", "fp AS b")
    return pairs.union(far).distinct()


def groups(rows: DataFrame) -> DataFrame:
    """``rows`` (``_row, id, fp``, stored) with ``component_id, first_row`` added.

    ``first_row`` is the row that stands for the component: the smallest id, NULL last.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row"))
    prints = store(rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "simhash-prints")
    roots = connected_components(links(prints.select("fp")))
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("best"))
    known = store(
        rooted.join(firsts, "root").select(
            "fp", "n", F.col("best.id").alias("component_id"), F.col("best._row").alias("first_row")
        ),
        "simhash-known",
    )
    return attach_groups(rows, known, "fp", "n")


def sketch(docs: DataFrame, row: Column, id: str, text: str, size: int) -> DataFrame:
    return store(
        docs.select(row.alias("_row"), F.col(id).alias("id"), fingerprints(F.col(text), size).alias("fp")),
        "simhash-sketch",
    )


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One row per document: ``id, fingerprint, component_id``."""
    return groups(sketch(docs, F.monotonically_increasing_id(), id, text, size)).select(
        F.col("id").alias(id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """One document of each component, with all its columns."""
    row = fresh(docs.columns, "_row")
    frozen = store(with_row(docs, row), "simhash-input")
    rows = groups(sketch(frozen, F.col(row), id, text, size))
    gone = rows.filter(F.col("_row") != F.col("first_row"))
    return frozen.join(gone.select(F.col("_row").alias(row)), row, "left_anti").select(*docs.columns)
