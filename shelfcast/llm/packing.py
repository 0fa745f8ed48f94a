"""Packing into length buckets that minimise padding, and token-budget batches inside each bucket.

The length of a text is its number of words.  Bucket boundaries come from a
dynamic program over the global histogram of lengths: every text is padded to
the longest of its bucket, and the boundaries make the sum of the padding as
small as ``buckets`` buckets allow.  Lengths up to 511 are bins of their own;
longer ones are binned by their nine leading bits, so that no input has more
than about 256 bins per doubling of length.  A bucket is padded to its longest
text, not to its bin.

A batch holds ``budget // padded`` texts of one bucket, one at least: a text
above the budget has a batch of its own.  No text is cut or dropped.  Places in
a bucket come from a range-partitioned rank in the order of a hash, so that a
batch mixes sources.

Defined results: NULL and empty texts have length 0 and share the first bucket.
Repeated rows are packed each.  An empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import store, word_count
from shelfcast.operators.ordering import ranged_index

BUCKETS = 16
BUDGET = 32_768
FINE = 512


def length_bin(length: Column) -> Column:
    """The largest length of the same bin."""
    step = F.pow(F.lit(2.0), F.length(F.bin(length)) - 9).cast("long")
    return F.when(length < FINE, length).otherwise((F.floor(length / step) + 1) * step - 1).cast("long")


def boundaries(histogram: list[tuple[int, int, int, int]], buckets: int = BUCKETS) -> list[tuple[int, int]]:
    """Buckets ``(last_bin, padded_length)`` of least padding, for bins ``(bin, longest, texts, words)`` in order.

    ``cost[j]`` is the least number of padded words of the first ``j`` bins; one
    more bucket each round, with all splits of a round weighed at once.
    """
    if not histogram:
        return []
    bins, longest, texts, _ = (np.array(x, dtype=np.float64) for x in zip(*histogram))
    n, many = len(bins), np.concatenate([[0.0], np.cumsum(texts)])
    cost, choices = np.full(n + 1, np.inf), []
    cost[0] = 0.0
    for _ in range(min(buckets, n)):
        best, came = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        best[0] = 0.0
        for j in range(1, n + 1):
            whole = cost[:j] + longest[j - 1] * (many[j] - many[:j])
            came[j] = int(np.argmin(whole))
            best[j] = whole[came[j]]
        cost = best
        choices.append(came)
    out, j = [], n
    for came in reversed(choices):
        if j == 0:
            break
        out.append((int(bins[j - 1]), int(longest[j - 1])))
        j = int(came[j])
    return out[::-1]


def packed(
    docs: DataFrame, id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET, seed: int = 0
) -> DataFrame:
    """One row per document: ``id, length, bucket, padded_length, batch, place``; batches count within a bucket."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = store(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), F.col(id).alias("id"),
            word_count(own).alias("length"), F.xxhash64(F.lit(seed), F.col(id), own).alias("drawn"),
        ).withColumn("bin", length_bin(F.col("length"))),
        "pack-rows",
    )
    histogram = (
        rows.groupBy("bin").agg(F.max("length"), F.count(F.lit(1)), F.sum("length")).orderBy("bin").collect()
    )
    cuts = boundaries([tuple(r) for r in histogram], buckets)
    last = F.array(*[F.lit(b).cast("long") for b, _ in cuts] or [F.lit(0).cast("long")])
    padded = F.array(*[F.lit(p).cast("long") for _, p in cuts] or [F.lit(0).cast("long")])
    bucketed = rows.withColumn("bucket", F.size(F.filter(last, lambda b: b < F.col("bin"))))
    ranked = ranged_index(bucketed, [F.col("drawn"), F.col("_row")], ["bucket"], "rank")
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.get(padded, F.col("bucket")), F.lit(1))))
    return ranked.select(
        F.col("id").alias(id), "length", "bucket", F.get(padded, F.col("bucket")).alias("padded_length"),
        F.floor(F.col("rank") / each).cast("long").alias("batch"), (F.col("rank") % each).cast("long").alias("place"),
    )
