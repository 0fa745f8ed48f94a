"""Removal of repeated passages with a logarithmic family of sparse suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts
anywhere else, in the same text or another one.

The suffixes that are kept are those at anchors: in every ``length``-byte window
the least of its k-byte hashes (k is a quarter of the length; the leftmost of
equal ones) marks one position, which depends on the window alone.  Consecutive
windows with the same anchor are a run: about one per 150 bytes at 400.  Equal
windows have equal anchors, so only runs that share an anchor can match.

Texts come in batches.  A batch's array has its anchors in the order of the prefixes
that follow them (as hashes; only equality matters).  It is merge-scanned
against every existing level for anchors that occur in both, and within itself;
levels of equal size merge into one of twice the size, so an anchor is rewritten
a logarithmic number of times.  Entries are two numbers, an anchor and its count.

The runs of shared anchors are then read again and resolved exactly, ever finer, with one representative of
each distinct content: a run whose whole content repeats is repeated in full.
The others of that anchor are cut into blocks of 16 windows (aligned at the
anchor, compared where their common core repeats), and blocks that share a core
but not their content into single windows.  Contents are compared by 128-bit
hashes.  Nothing is compared pair by pair, so a passage in a third of all texts
costs no more than its runs.

Texts are held once each, bucketed by their hash, so that later passes join narrow
tables to them without moving text again.

Defined results: a NULL text counts as empty.  Texts below ``length`` bytes keep
every byte.  Repeated rows are copies of each other and lose all bytes if they
are long enough.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import attach_groups, store
from shelfcast.session import scratch_path

LENGTH = 400
BATCHES = 3
BLOCK = 16
# Window starts handled at a time, so that memory does not follow the longest text.
CHUNK = 1 << 20
LOW = np.uint64((1 << 21) - 1)
# Fixed by rule: a random odd multiplier and a random number per byte value.
_random = np.random.default_rng(20240229)
STEP = int(_random.integers(0, 2**63)) * 2 + 1
BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), np.uint64(base % 2**64))]), dtype=np.uint64)[:n]


class Roller:
    """Hashes of all k-byte pieces of a byte array."""

    def __init__(self, k: int):
        self.k = k
        self.up = _powers(STEP, 1)
        self.down = self.up

    def __call__(self, data: np.ndarray) -> np.ndarray:
        if len(data) > len(self.up):
            n = min(2 * len(data), len(data) + CHUNK)
            self.up, self.down = _powers(STEP, n), _powers(pow(STEP, -1, 2**64), n)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE[data] * self.up[:len(data)], out=sums[1:])
        h = (sums[self.k:] - sums[:-self.k]) * self.down[:len(data) - self.k + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones, from minima that run up to and down to block edges."""
    count = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, dtype=np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[width - 1:width - 1 + count])


def runs_of(data: bytes, length: int, roller: Roller) -> Iterator[tuple[int, int, int]]:
    """Runs ``(first, starts, anchor)``: window starts ``first .. first + starts - 1``, anchored ``anchor`` bytes after first."""
    width = length - roller.k + 1
    for base in range(0, len(data) - length + 1, CHUNK):
        part = np.frombuffer(data[base:base + CHUNK + length - 1], dtype=np.uint8)
        h = roller(part)
        at = (sliding_min((h & ~LOW) | np.arange(len(h), dtype=np.uint64), width) & LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        many = np.diff(np.concatenate([first, [len(at)]]))
        for s, n in zip(first.tolist(), many.tolist()):
            yield base + s, n, int(at[s]) - s


def signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


# A text is known by two 64-bit hashes of its SHA-256: narrower in a shuffle than the digest.
TEXT = ["t1", "t2"]
RUNS = "t1 long, t2 long, weight long, first long, starts int, anchor int, key long, content binary"
RUN_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
RUN_NAMES = [*TEXT, "weight", "first", "starts", "anchor", "key", "content"]


def key_of(data: bytes, place: int, k: int) -> int:
    return signed(xxhash.xxh3_64_intdigest(data[place:place + k]))


def all_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``key, t1, t2, n``: each text's anchors, and how many runs of all copies of the text have them."""

    def scan(batches):
        roller = Roller(length // 4)
        for batch in batches:
            for t1, t2, weight, text in zip(*batch.columns):
                data = text.as_py().encode()
                found = Counter(key_of(data, first + anchor, roller.k) for first, _, anchor in runs_of(data, length, roller))
                own = (t1.as_py(), t2.as_py())
                rows = [(key, *own, n * weight.as_py()) for key, n in found.items()]
                yield _batch(rows, ["key", *TEXT, "n"], [pa.int64()] * 4)

    return texts.select(*TEXT, "weight", "text").mapInArrow(scan, "key long, t1 long, t2 long, n long")


def runs_with(texts: DataFrame, keys: DataFrame, length: int) -> DataFrame:
    """Runs whose anchor is among ``keys`` (``t1, t2, key``), read from the texts where they lie."""
    per_text = keys.groupBy(*TEXT).agg(F.collect_list("key").alias("keys"))

    def scan(batches):
        roller = Roller(length // 4)
        for batch in batches:
            for t1, t2, weight, text, wanted in zip(*batch.columns):
                data, keys = text.as_py().encode(), set(wanted.as_py())
                own = (t1.as_py(), t2.as_py(), weight.as_py())
                rows = []
                for first, starts, anchor in runs_of(data, length, roller):
                    key = key_of(data, first + anchor, roller.k)
                    if key in keys:
                        content = xxhash.xxh3_128_digest(data[first:first + starts - 1 + length])
                        rows.append((*own, first, starts, anchor, key, content))
                yield _batch(rows, RUN_NAMES, RUN_KINDS)

    joined = texts.select(*TEXT, "weight", "text").join(per_text, TEXT).select(*TEXT, "weight", "text", "keys")
    return joined.mapInArrow(scan, RUNS)


def counted(rows: DataFrame) -> DataFrame:
    """One row per ``key, content``: the weight of all its rows and one of them."""
    place = F.struct(*TEXT, "first", "starts", "anchor")
    return rows.groupBy("key", "content").agg(F.sum("weight").alias("weight"), F.min(place).alias("place"))


class SuffixLevels:
    """The index: sorted arrays of anchors, and the anchors found in more than one run so far.

    Arrays of the same level are merged when the next batch comes, so the last
    batch does not rewrite what nothing reads.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self.shared: DataFrame | None = None

    def add(self, anchors: DataFrame) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (level, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((level + 1, self._array(a.unionByName(b))))
        array = self._array(anchors.select("key", "n"))
        found = array.filter("n > 1").select("key")
        for _, level in self.levels:
            found = found.union(array.select("key").join(level.select("key"), "key", "left_semi"))
        found = store(found, "suffix-shared")
        self.shared = found if self.shared is None else self.shared.union(found)
        self.levels.append((0, array))

    @staticmethod
    def _array(anchors: DataFrame) -> DataFrame:
        """One entry per anchor, in the order of anchors within each of Spark's partitions."""
        return store(anchors.groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key"), "suffix-level")


def contested(contents: DataFrame) -> DataFrame:
    """Contents (stored) whose key has other contents too."""
    keys = store(contents.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "suffix-contested")
    return attach_groups(contents, keys, "key", "n").filter(F.col("n").isNotNull()).drop("n")


def slices(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs (``weight, place``), read from the texts where they lie."""
    per_text = wanted.groupBy(*[F.col(f"place.{t}").alias(t) for t in TEXT]).agg(
        F.collect_list(F.struct("place.first", "place.starts", "place.anchor", "weight")).alias("runs"))

    def cut(batches):
        for batch in batches:
            for t1, t2, text, runs in zip(*batch.columns):
                data, own = text.as_py().encode(), (t1.as_py(), t2.as_py())
                rows = [
                    (*own, r["weight"], r["first"], r["starts"], r["anchor"],
                     data[r["first"]:r["first"] + r["starts"] - 1 + length])
                    for r in runs.as_py()
                ]
                yield _batch(rows, [*RUN_NAMES[:6], "body"], [*RUN_KINDS[:6], pa.binary()])

    joined = texts.select(*TEXT, "text").join(per_text, TEXT).select(*TEXT, "text", "runs")
    return joined.mapInArrow(cut, "t1 long, t2 long, weight long, first long, starts int, anchor int, body binary")


def pieces(bodies: DataFrame, length: int, block: int, with_core: bool = True) -> DataFrame:
    """Runs cut at multiples of ``block`` before the anchor, with the key of the windows' common core (single windows need none)."""

    def cut(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                body, i = r["body"], 0
                while i < r["starts"]:
                    number = (r["anchor"] - i) // block
                    n = min(r["starts"] - i, (r["anchor"] - i) - number * block + 1)
                    own = body[i:i + n - 1 + length]
                    core = r["anchor"] - number * block
                    key = xxhash.xxh3_64_intdigest(body[core:core + length - block + 1], number) if with_core else 0
                    rows.append((r["t1"], r["t2"], r["weight"], r["first"] + i, n, r["anchor"] - i, signed(key),
                                 xxhash.xxh3_128_digest(own)))
                    i += n
                if len(rows) > 20_000:
                    yield _batch(rows, RUN_NAMES, RUN_KINDS)
                    rows = []
            yield _batch(rows, RUN_NAMES, RUN_KINDS)

    return bodies.mapInArrow(cut, RUNS)


def text_key(sha: Column) -> list[Column]:
    return [F.xxhash64(sha).alias("t1"), F.xxhash64(F.lit(1), sha).alias("t2")]


def distinct_texts(docs: DataFrame, length: int) -> str:
    """Name of a table of the texts of at least ``length`` bytes, once each: ``t1, t2, weight, text``, bucketed by their key."""
    spark = docs.sparkSession
    name, path = f"suffix_texts_{uuid.uuid4().hex}", scratch_path(spark, "suffix-texts")
    (
        docs.filter(F.octet_length("text") >= length)
        .select(*text_key(F.sha2(F.col("text").cast("binary"), 256)), "text")
        .groupBy(*TEXT).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("weight"))
        .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *TEXT)
        .option("path", path).option("compression", "zstd").saveAsTable(name)
    )
    return name


def repeated_starts(texts: DataFrame, length: int, batches: int) -> DataFrame:
    """Window starts that repeat, as ``t1, t2, first, starts``, of texts that occur once."""
    anchors = store(all_anchors(texts, length), "suffix-anchors")
    index = SuffixLevels()
    for k in range(batches):
        index.add(anchors.filter(F.pmod("t1", F.lit(batches)) == k))
    runs = store(runs_with(texts, anchors.join(index.shared, "key", "left_semi"), length), "suffix-runs")
    contents = store(counted(runs), "suffix-contents")
    once = F.col("weight") == 1
    spot = [*TEXT, "first", "starts"]

    def repeated(rows: DataFrame, contents: DataFrame) -> DataFrame:
        """Rows of texts that occur once whose whole content occurs again."""
        again = store(contents.filter("weight > 1").groupBy("content").agg(F.sum("weight").alias("n")), "suffix-again")
        rows = rows.filter(once).select(*spot, "content")
        return attach_groups(rows, again, "content", "n").filter(F.col("n").isNotNull()).select(*spot)

    # blocks of the runs that share their anchor with other contents
    bodies = slices(texts, contested(contents).select("weight", "place"), length)
    blocks = store(pieces(bodies, length, BLOCK), "suffix-blocks")
    block_contents = store(counted(blocks), "suffix-block-contents")
    # single windows of the blocks that share their core with other contents; their bytes are read from the texts again
    bodies = slices(texts, contested(block_contents).select("weight", "place"), length)
    windows = store(pieces(bodies, length, 1, False).drop("anchor", "key"), "suffix-windows")
    window_contents = windows.groupBy("content").agg(F.sum("weight").alias("weight"))
    return repeated(runs, contents).union(repeated(blocks, block_contents)).union(repeated(windows, window_contents))


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, batches: int = BATCHES
) -> DataFrame:
    """One row per document: ``id, n_bytes, n_removed, n_spans, kept_sha256``."""
    own = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    rows = store(
        own.select("id", F.octet_length("text").cast("long").alias("n_bytes"), sha.alias("sha"))
        .withColumn("text_key", F.struct(*text_key(F.col("sha")))),
        "suffix-rows",
    )
    name = distinct_texts(own, length)
    texts = docs.sparkSession.table(name)
    spans = repeated_starts(texts, length, batches).groupBy(*TEXT).agg(F.collect_list(F.struct("first", "starts")).alias("spans"))

    def apply(batches):
        for batch in batches:
            done = []
            for t1, t2, own_text, found in zip(*batch.columns):
                data = own_text.as_py().encode()
                kept, removed, many, end = hashlib.sha256(), 0, 0, -1  # end of the removed stretch so far
                for r in sorted(found.as_py(), key=lambda r: r["first"]):
                    a, b = r["first"], r["first"] + r["starts"] - 1 + length
                    if a > end:
                        many += 1
                        kept.update(data[max(end, 0):a])
                        removed += b - a
                        end = b
                    elif b > end:
                        removed += b - end
                        end = b
                kept.update(data[max(end, 0):])
                done.append((t1.as_py(), t2.as_py(), removed, many, kept.hexdigest()))
            names = [*TEXT, "n_removed", "n_spans", "kept_sha256"]
            yield _batch(done, names, [*[pa.int64()] * 4, pa.string()])

    cut = (
        texts.filter("weight = 1").select(*TEXT, "text").join(spans, TEXT).select(*TEXT, "text", "spans")
        .mapInArrow(apply, "t1 long, t2 long, n_removed long, n_spans long, kept_sha256 string")
        .withColumn("n", F.lit(1).cast("long"))
    )
    copies = texts.filter("weight > 1").select(
        *TEXT, F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(EMPTY_SHA).alias("kept_sha256"), F.col("weight").alias("n"),
    )
    known = store(cut.unionByName(copies).withColumn("text_key", F.struct(*TEXT)).drop(*TEXT), "suffix-known")
    docs.sparkSession.sql(f"DROP TABLE {name}")  # nothing reads the texts any more
    joined = attach_groups(rows, known, "text_key", "n")
    untouched = F.col("n").isNull()
    return joined.select(
        F.col("id").alias(id), "n_bytes",
        F.when(untouched, F.lit(0)).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
