"""Near copies by SimHash at a wide distance, verified by the similarity of their five-word shingles.

A fingerprint is cut into nine blocks.  Two fingerprints that differ in at most
six bits agree in at least three blocks, so one of the 84 choices of three
blocks finds every such pair, and most pairs of seven to ten bits as their bits
often fall into the same block.  Pairs that share a choice and differ in at most
``bits`` bits are candidates; they link if the sets of their five-word shingles
have a Jaccard similarity of 0.8 or more.  Documents with one fingerprint are
one node, whose first row gives the set, and count as copies.

Fingerprints and choices are shuffled once, without texts, and compared in runs
of one block value; a pair comes from the first choice that it shares.  A run of
more than CROWDED fingerprints (a large group of near copies) does not give all
its pairs: it first gives its least member and the member before each one; links
found there join most of the group, and the next rounds look only at pairs whose
ends are still apart.  When a round joins nothing more, the remaining pairs of
different components are compared.  There each fingerprint brings a parity mark of
its set: two marks never differ in more bits than the sets differ in shingles, so
a pair whose marks already differ too much is none, and is not given.  No
candidate that could link is lost.

Defined results: NULL and empty texts have fingerprint zero and an empty set;
they are one node.  A text of fewer than five words is one shingle.  Of a group
the row with the smallest id stays, NULL last; of rows that repeat it, one.  An
empty table gives none.  Sets hold 32-bit hashes of shingles: for two sets of
400 shingles the chance that any two differing ones agree is about 4e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfcast.llm.common import attach_groups, fresh, store, with_row
from shelfcast.llm.components import connected_components
from shelfcast.llm.simhash import CHUNK, FOLD, WORD, sketch

SHINGLE = 5
SIZE = 3
BITS = 10
BLOCKS, SHARED = 9, 3
CROWDED = 16
# Sets are alike at a Jaccard similarity of OVER / UNDER.
OVER, UNDER = 4, 5
MARK_BITS = 256


def block_masks(blocks: int = BLOCKS, shared: int = SHARED) -> list[int]:
    """Masks, as signed longs, of the choices of ``shared`` blocks out of ``blocks``."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, shared)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the word shingles of one text."""
    words = WORD.findall((text or "").translate(FOLD))
    if not words:
        return np.empty(0, dtype=np.int32)
    found = []
    for start in range(0, max(1, len(words) - size + 1), CHUNK):
        part = words[start:start + CHUNK + size - 1]
        shingles = zip(*(part[k:] for k in range(size))) if len(part) >= size else [part]
        found.append(np.unique(np.fromiter((xxhash.xxh32_intdigest(" ".join(s)) for s in shingles), dtype=np.uint32)))
    return np.unique(np.concatenate(found)).view(np.int32)


def shingle_sets(text: Column, size: int) -> Column:
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingle_set(t, size))

    return of(text)


def parity_mark(items: np.ndarray) -> np.ndarray:
    """For each of MARK_BITS classes of hashes, the parity of their number in a set, packed into longs."""
    odd = np.bincount(np.asarray(items, dtype=np.int32).view(np.uint32) % MARK_BITS, minlength=MARK_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def parity_marks(items: pd.Series) -> pd.Series:
    return items.map(parity_mark)


def run_pairs(rows: DataFrame, masks: list[int], bits: int, crowded: int | None, marked: bool = False) -> DataFrame:
    """Candidates ``a < b`` from ``rows`` (``choice, fp, part``) that share a choice's block value.

    Runs of more than ``crowded`` rows give only the pairs with their first row and with the row
    before; each of their rows comes out once as ``b`` with its choice (-1 for other pairs), beside
    the first row if they are a candidate, else beside itself.  None: all pairs.  ``marked`` rows
    have the parity ``mark`` and the size ``n`` of their sets as well; they give only pairs that
    the marks leave open, and nothing else.
    """
    values = np.array(masks, dtype=np.int64)
    limit = np.iinfo(np.int64).max if crowded is None else crowded

    def compare(columns, starts) -> Iterator[pa.RecordBatch]:
        choice, fp, part, *sets = columns
        ends = np.append(starts[1:], len(fp))
        size = np.repeat(ends - starts, ends - starts)
        start, end = np.repeat(starts, ends - starts), np.repeat(ends, ends - starts)

        def close(x, y) -> np.ndarray:
            same = (np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64)) <= bits) & (part[x] != part[y]) & (fp[x] != fp[y])
            if marked:
                mark, n = sets
                at = np.flatnonzero(same)
                differ = np.bitwise_count((mark[x[at]] ^ mark[y[at]]).view(np.uint64)).sum(axis=1, dtype=np.int64)
                same[at] = (OVER + UNDER) * differ <= (UNDER - OVER) * (n[x[at]] + n[y[at]])
            return same

        def pairs(x, y) -> Iterator[pa.RecordBatch]:
            same = close(x, y)
            x, y = x[same], y[same]
            if len(x):
                first = first_shared(fp[x] ^ fp[y], choice[x])
                x, y = x[first], y[first]
                yield batch(np.minimum(fp[x], fp[y]), np.maximum(fp[x], fp[y]), np.full(len(x), -1, dtype=np.int32))

        step, at = 1, np.flatnonzero((size > 1) & (size <= limit))
        at = at[at + step < end[at]]
        while len(at):
            yield from pairs(at, at + step)
            step += 1
            at = at[at + step < end[at]]
        crowd = np.flatnonzero(size > limit)
        if len(crowd):
            least = start[crowd]
            near = close(least, crowd)
            if marked:
                least, own, at = least[near], crowd[near], np.full(near.sum(), -1, dtype=np.int32)
            else:
                least, own, at = np.where(near, least, crowd), crowd, choice[crowd]
            yield batch(np.minimum(fp[least], fp[own]), np.maximum(fp[least], fp[own]), at)
            later = crowd[crowd > start[crowd] + 1]
            yield from pairs(later - 1, later)

    def first_shared(differ, choice) -> np.ndarray:
        """Pairs that share no choice before theirs; a crowded one comes up again when its ends are still apart."""
        first = np.ones(len(differ), dtype=bool)
        for k in range(choice.max()):
            first &= ((differ & values[k]) != 0) | (choice <= k)
        return first

    def batch(a, b, choice) -> pa.RecordBatch:
        return pa.record_batch({"a": pa.array(a), "b": pa.array(b), "choice": pa.array(choice, pa.int32())})

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for got in batches:
            now = [got.column(n).to_numpy(zero_copy_only=False) for n in ("choice", "fp", "part")]
            if marked:
                now += [got.column("mark").flatten().to_numpy().reshape(-1, MARK_BITS // 64), got.column("n").to_numpy()]
            if kept is not None:
                now = [np.concatenate(both) for both in zip(kept, now)]
            choice, fp = now[:2]
            if not len(fp):
                continue
            key = fp & values[choice]
            starts = np.append(0, np.flatnonzero((choice[1:] != choice[:-1]) | (key[1:] != key[:-1])) + 1)
            last = starts[-1]
            if last:
                yield from compare([column[:last] for column in now], starts[:-1])
            kept = [column[last:] for column in now]
        if kept is not None:
            yield from compare(kept, np.zeros(1, dtype=np.int64))

    block = F.col("fp").bitwiseAND(F.get(F.array(*[F.lit(m) for m in masks]), F.col("choice")))
    columns = ["choice", "fp", "part", *(["mark", "n"] if marked else [])]
    return (
        rows.select(*columns).repartition("choice", block).sortWithinPartitions("choice", block, "fp")
        .mapInArrow(of, "a long, b long, choice int")
    )


def verified(pairs: DataFrame, sets: DataFrame, likeness: tuple[int, int] = (OVER, UNDER)) -> DataFrame:
    """The ``pairs`` (``a, b``, stored) whose sets reach the similarity; a pivot of many pairs is joined by broadcast."""
    counts = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    left = store(counts.join(sets.select(F.col("fp").alias("a"), F.col("items").alias("x")), "a"), "wide-left")
    right = sets.select(F.col("fp").alias("b"), F.col("items").alias("y"))
    both = attach_groups(pairs, left, "a", "n").drop("n").join(right, "b")
    over, under = likeness
    common = F.size(F.array_intersect("x", "y"))
    return (
        both.select("a", "b", common.alias("c"), (F.size("x") + F.size("y")).alias("s"))
        .filter((F.col("c") * under >= (F.col("s") - F.col("c")) * over) & (F.col("s") > 0)).select("a", "b")
    )


def links(prints: DataFrame, texts: DataFrame, bits: int = BITS) -> DataFrame:
    """Verified edges ``a, b`` that connect every group of ``prints`` (``fp``, distinct; ``_row`` of ``texts``)."""
    masks = block_masks()
    choices = F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("choice")
    found = store(
        run_pairs(prints.select(choices, "fp", F.col("fp").alias("part")), masks, bits, CROWDED).distinct(), "wide-pairs"
    )
    pairs = store(found.filter("a <> b").select("a", "b").distinct(), "wide-candidates")
    crowd = store(found.filter("choice >= 0").select("choice", F.col("b").alias("fp")), "wide-crowd")
    nodes = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(crowd.select("fp")).distinct()
    wanted = store(nodes.join(prints, "fp").select("fp", "_row"), "wide-nodes")
    sets = store(texts.join(wanted, "_row").select("fp", shingle_sets(F.col("text"), SHINGLE).alias("items")), "wide-sets")
    if not crowd.isEmpty():
        members = sets.join(crowd.select("fp").distinct(), "fp", "left_semi")
        marks = members.select("fp", parity_marks("items").alias("mark"), F.size("items").cast("long").alias("n"))
        crowd = store(crowd.join(store(marks, "wide-marks"), "fp"), "wide-marked")
    edges = store(verified(pairs, sets), "wide-links")
    rounds = not crowd.isEmpty()
    while rounds:
        more = store(verified(store(apart(crowd, edges, masks, bits, 1), "wide-star"), sets), "wide-more")
        rounds = not more.isEmpty()
        edges = edges.union(more)
        if not rounds:
            rest = store(apart(crowd, edges, masks, bits, None), "wide-rest")
            edges = edges.union(store(verified(rest, sets), "wide-last"))
    return edges


def apart(crowd: DataFrame, edges: DataFrame, masks: list[int], bits: int, crowded: int | None) -> DataFrame:
    """Candidates of crowded runs whose ends are in different components of ``edges``."""
    roots = connected_components(edges).select(F.col("node").alias("fp"), "root")
    rows = crowd.join(roots, "fp", "left").select("choice", "fp", F.coalesce("root", "fp").alias("part"), "mark", "n")
    return run_pairs(rows, masks, bits, crowded, marked=True).select("a", "b").distinct()


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, bits: int = BITS) -> DataFrame:
    """One document of each group of near copies, with all its columns."""
    row = fresh(docs.columns, "_row")
    frozen = store(with_row(docs, row), "wide-input")
    rows = sketch(frozen, F.col(row), id, text, size)
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row"))
    prints = store(rows.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "wide-prints")
    texts = frozen.select(F.col(row).alias("_row"), F.col(text).alias("text"))
    edges = links(prints.select("fp", F.col("first._row").alias("_row")), texts, bits)
    rooted = prints.join(connected_components(edges).withColumnRenamed("node", "fp"), "fp", "left")
    rooted = store(rooted.withColumn("root", F.coalesce("root", "fp")), "wide-rooted")
    best = store(rooted.groupBy("root").agg(F.min("first").alias("best"), F.count(F.lit(1)).alias("m")), "wide-best")
    known = store(
        attach_groups(rooted, best, "root", "m").select("fp", "n", F.col("best._row").alias("first_row")), "wide-known"
    )
    gone = attach_groups(rows, known, "fp", "n").filter(F.col("_row") != F.col("first_row"))
    gone = store(gone.select(F.col("_row").alias(row)), "wide-gone")
    return frozen.join(gone, row, "left_anti").select(*docs.columns)
