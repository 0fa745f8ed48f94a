"""Benchmark decontamination with one Aho-Corasick automaton over normalised test questions and answers.

Texts are normalised to words with one space between them: A-Z in lower case,
everything but letters, digits and characters outside ASCII a gap.  The patterns
are the windows of ``window`` consecutive words of each item (the whole item
where it has fewer), each with a space at either end, so matches begin and end
at words.  Every document is scanned once; the places of matches are word
numbers, and are mapped back to code points of the original text.

The automaton is built by each Python worker from the items' words, which are
sent to it.  ``part_windows`` bounds their number, about 3 kB of memory each: a
benchmark with more is dealt into parts by hash, in stretches of long items, and
each part is an automaton of its own that scans the documents; what the parts
find in a document is put together by its row.

Defined results: a NULL or empty text has no words.  An item without words has
no window.  Items are told apart by id: rows with the same id are one item, and
an item without an id marks words but is neither counted nor listed.  Equal
texts under several ids are all listed.  Repeated documents each give a row.
Without items nothing is hit; without documents there are no rows.  Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import fold_case, store, with_row, words

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
PART_WINDOWS = 32_768
# Windows of a long item that stay together.
STRETCH = 4096
# Characters scanned at a time, so that the automaton's copy does not follow the longest text.
CHUNK = 1 << 20
# Each byte as it is scanned: lower case, or a space for a gap.
SCANNED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
RUNS = "array<struct<first:long,last:long,start:long,end:long>>"


def normalised(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of `` word word ... ``, and the place of each in ``text`` plus one."""
    raw = np.frombuffer(b" " + text.translate(SCANNED) + b" ", np.uint8)
    blank = raw == 32
    kept = np.flatnonzero(~np.concatenate([[False], blank[1:] & blank[:-1]]))
    return raw[kept], kept


class Windows:
    """The automaton over the windows of some items, with what each window stands for."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int):
        found: dict[str, set] = {}
        for id, item in items:
            own = item.split(" ")
            for k in range(max(1, len(own) - window + 1)):
                found.setdefault(" ".join(own[k:k + window]), set()).add(id)
        self.items = [sorted(ids - {None}) for ids in found.values()]
        self.length = np.array([w.count(" ") + 1 for w in found], dtype=np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, w in enumerate(found):
            # one character for each byte, as the texts are scanned
            self.automaton.add_word(f" {w} ".encode().decode("latin-1"), k)
        self.automaton.make_automaton()

    def matches(self, scanned: str) -> tuple[np.ndarray, np.ndarray]:
        """Place of the last character, and number, of each window that occurs."""
        if not self.items:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found, places = [], self.automaton.iter(scanned[:CHUNK])
        found += places
        for start in range(CHUNK, len(scanned), CHUNK):
            places.set(scanned[start:start + CHUNK])
            found += places
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def scan(self, text: bytes) -> tuple[int, list[tuple], list[str]]:
        """Number of words, maximal runs of hit words with their code points (end exclusive), and the items found."""
        scanned, origin = normalised(text)
        spaces = np.flatnonzero(scanned == 32)
        ends, which = self.matches(scanned.tobytes().decode("latin-1"))
        if not len(ends):
            return len(spaces) - 1, [], []
        last = np.searchsorted(spaces, ends) - 1
        runs = merged(np.column_stack([last - self.length[which] + 1, last]))
        # code points before each byte: all bytes but those that continue a character
        before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
        starts = before[origin[spaces[runs[:, 0]] + 1] - 1]
        stops = before[origin[spaces[runs[:, 1] + 1] - 1]]
        found = sorted(set().union(*(self.items[k] for k in np.unique(which))))
        return len(spaces) - 1, [tuple(r) for r in np.column_stack([runs, starts, stops]).tolist()], found


def merged(runs: np.ndarray) -> np.ndarray:
    """Union of runs ``first, last, ...`` that overlap or touch, as maximal ones; what follows is taken from the ends."""
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    reach = np.maximum.accumulate(runs[:, 1])
    begins = np.flatnonzero(np.concatenate([[True], runs[1:, 0] > reach[:-1] + 1]))
    final = np.concatenate([begins[1:] - 1, [len(runs) - 1]])
    if runs.shape[1] == 2:
        return np.column_stack([runs[begins, 0], reach[final]])
    return np.column_stack([runs[begins, 0], reach[final], runs[begins, 2], np.maximum.accumulate(runs[:, 3])[final]])


@lru_cache(maxsize=1)
def built(items: tuple, window: int) -> Windows:
    """Kept by the worker for its next task."""
    return Windows(items, window)


def item_stretches(items: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """``id, words``: the items' words with a space between them, long items in overlapping stretches."""
    own = items.select(F.col(id).cast("string").alias("id"), words(fold_case(F.col(text)), GAP).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(STRETCH))
    stretch = F.slice("w", F.col("at") + 1, STRETCH + window - 1)
    return (
        own.filter(F.size("w") > 0).withColumn("at", F.explode(starts))
        .select("id", F.array_join(stretch, " ").alias("words"), F.greatest(F.size(stretch) - window + 1, F.lit(1)).alias("n"))
        .distinct()
    )


def scanned(docs: DataFrame, part: tuple, window: int) -> DataFrame:
    """``docs`` (``_row, id, text`` as bytes) scanned for one part's windows: ``_row, id, n_words, runs, items``."""

    @F.pandas_udf(f"n_words long, runs {RUNS}, items array<string>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = built(part, window)
        for texts in batches:
            yield pd.DataFrame([automaton.scan(bytes(t)) for t in texts], columns=["n_words", "runs", "items"])

    return docs.select("_row", "id", of("text").alias("f")).select("_row", "id", "f.*")


def benchmark_hits(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """One row per document: ``_row, id, n_words``, the ``runs`` of hit words, and the sorted ids of the ``items`` found."""
    stretches = store(item_stretches(items, item_id, item_text, window), "leaks-items")
    parts = -(-(stretches.agg(F.sum("n")).first()[0] or 0) // part_windows)
    dealt = F.pmod(F.xxhash64("id", "words"), F.lit(max(1, parts)))
    content = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    if parts <= 1:
        rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id).alias("id"), content)
        return scanned(rows, listed(stretches), window)
    rows = store(with_row(docs.select(F.col(id).alias("id"), content)), "leaks-texts")
    found = None
    for k in range(parts):
        own = store(scanned(rows, listed(stretches.filter(dealt == k)), window).filter((F.size("runs") > 0) | F.lit(k == 0)), "leaks-part")
        found = own if found is None else found.unionByName(own)
    together = found.groupBy("_row").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return together.withColumn("runs", joined(F.col("runs")))


def listed(stretches: DataFrame) -> tuple:
    """A part's items, ``part_windows`` windows or so, in a fixed order."""
    rows = [tuple(r) for r in stretches.select("id", "words").collect()]
    return tuple(sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1])))


def joined(runs: Column) -> Column:
    """Runs found by several parts as maximal ones."""

    @F.pandas_udf(RUNS)
    def of(lists: pd.Series) -> pd.Series:
        def one(own):
            if not len(own):
                return []
            table = np.array([(r["first"], r["last"], r["start"], r["end"]) for r in own], dtype=np.int64)
            return [dict(zip(("first", "last", "start", "end"), r)) for r in merged(table).tolist()]

        return lists.map(one)

    return of(runs)


def contamination(docs: DataFrame, items: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """One row per document: ``id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda total, r: total + r["last"] - r["first"] + 1)
    return benchmark_hits(docs, items, id, **options).select(
        F.col("id").alias(id), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


SQL = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), i AS MATERIALIZED (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM benchmark
), windows AS MATERIALIZED (
    SELECT DISTINCT item, least(10, len(words)) AS k, array_to_string(words[s:s + least(10, len(words)) - 1], ' ') AS gram
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS s FROM i WHERE len(words) > 0)
), grams AS (
    SELECT r, k, s, array_to_string(words[s:s + k - 1], ' ') AS gram
    FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM windows))
), hits AS MATERIALIZED (
    SELECT r, item, k, s FROM grams JOIN windows USING (k, gram)
), words_hit AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + k)) AS place FROM hits) GROUP BY r
), items_hit AS (
    SELECT r, count(DISTINCT item) AS n_items, coalesce(string_agg(DISTINCT item, ',' ORDER BY item), '') AS items FROM hits GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items_hit USING (r)
"""
