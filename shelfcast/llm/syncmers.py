"""Document fingerprints from closed syncmers, in DataFrame functions only.

The units are words.  A k-mer is K consecutive words, its inner pieces are the
runs of S words in it.  It is a closed syncmer when its least inner hash lies at
its first or its last piece.  That depends on the k-mer alone, so equal passages
give equal anchors whatever surrounds them.  ``anchors`` are the hashes of the
syncmers with their word positions.  A mark is an anchor, the anchor after it and
the words between them: two texts share a mark where two anchors stand at the
same distance in both, wherever that is.  Likeness is the exact share of common
marks, over all of both texts.  The fingerprint string names the KEPT least
distinct anchor hashes and ends with a digest of all marks, so that texts with
equal fingerprints have likeness 1.

Edited texts need the beginning of the next document in the order of ids.  A few
ids split the order into stretches; each document goes to its stretch, and the
first ones of a stretch also end the stretch before (the first of all ends the
last), so every document meets its successor after one shuffle, and no
task sees more than a stretch.  Only ids and texts are shuffled; marks are made
where a stretch has come together.

Defined results: a NULL text counts as empty.  Fewer than K words give one
anchor, the whole sequence; no words give none, and two empty fingerprints have
likeness 1, an empty and another one 0.  A single row follows itself.  Rows with
equal ids are ordered by text, and a NULL id comes first.  An empty table gives
none.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.llm.common import SPACE, let

K, S, KEPT = 5, 2, 64
STRETCHES = 1024


def anchors(text: Column) -> Column:
    """``array<struct<position, hash>>`` of the closed syncmers of a text, in order."""
    pieces = F.filter(F.split(text, SPACE), lambda w: w != "")

    def of_words(words: Column) -> Column:
        def of_pairs(pairs: Column) -> Column:
            at = lambda i, n: F.get(pairs, i + n)
            chosen = F.filter(
                F.sequence(F.lit(0), F.size(words) - K),
                lambda i: F.least(at(i, 0), at(i, K - S)) <= F.least(*[at(i, n) for n in range(1, K - S)]),
            )
            return F.transform(chosen, lambda i: F.struct(
                i.alias("position"), F.xxhash64(at(i, 0), at(i, 2), at(i, 3)).alias("hash")))

        whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(F.array_join(words, " ")).alias("hash")))
        pairs = F.zip_with(
            F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
            lambda a, b: F.xxhash64(a, b),
        )
        return (
            F.when(F.size(words) >= K, let(pairs, of_pairs))
            .when(F.size(words) > 0, whole)
            .otherwise(F.slice(whole, 1, 0))
        )

    return let(pieces, of_words)


def marked(text: Column) -> Column:
    """``struct<least, marks>``: the KEPT least distinct 32-bit anchor hashes, and all distinct marks in order of hash."""

    def of_anchors(found: Column) -> Column:
        hashes = F.transform(found, lambda a: F.shiftrightunsigned(a["hash"], 32))

        def mark(a: Column, i: Column) -> Column:
            # the last anchor has none after it: NULLs leave a hash as it is
            after = F.get(found, i + 1)
            return F.xxhash64(a["hash"], after["hash"], after["position"] - a["position"])

        return F.struct(
            F.slice(F.sort_array(F.array_distinct(hashes)), 1, KEPT).alias("least"),
            F.sort_array(F.array_distinct(F.transform(found, mark))).alias("marks"),
        )

    return let(anchors(text), of_anchors)


def as_text(print_: Column) -> Column:
    """The fingerprint string: the least hashes, then the digest of all marks; empty for a text without words."""
    least = F.array_join(F.transform(print_["least"], lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")
    digest = F.lpad(F.lower(F.hex(F.xxhash64(print_["marks"]))), 16, "0")
    return F.when(F.size(print_["marks"]) == 0, F.lit("")).otherwise(F.concat(least, digest))


def likeness(a: Column, b: Column) -> Column:
    """Common marks over all marks of both; both arrays hold distinct ones."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n)).cast("double")
    )


def stretch_starts(docs: DataFrame, id: str, stretches: int) -> list:
    """Ids that begin a stretch, in order; at most ``stretches``, all of them found in the table."""
    ids = docs.select(F.col(id).alias("id")).filter(F.col("id").isNotNull())
    shares = [k / stretches for k in range(stretches)]
    return sorted(set(ids.agg(F.percentile_approx("id", shares, 100 * stretches)).first()[0] or []))


def with_next(
    docs: DataFrame, id: str, text: str, derived: Mapping[str, Column], stretches: int = STRETCHES
) -> DataFrame:
    """Each row with the ``derived`` columns, and ``next``: text and derived columns of the row after it in the order of ids.

    The text also orders rows of equal ids.  Derived columns are made after the shuffle, so they are not moved.
    """
    starts = stretch_starts(docs, id, stretches)
    values = F.array(*[F.lit(s) for s in starts]) if starts else F.array(F.lit(None).cast(docs.schema[id].dataType))
    own = F.when(F.col(id).isNull(), F.lit(-1)).otherwise(F.size(F.filter(values, lambda s: s <= F.col(id))) - 1)
    # NULL ids are a stretch of their own before the others
    has_null = bool(docs.filter(F.col(id).isNull()).limit(1).count())
    last = len(starts) - 1
    begins = F.array_contains(values, F.col(id)) if starts else F.lit(False)
    before = F.when(F.col("_own") == -1, F.lit(last)).when(
        F.col("_own") == 0, F.lit(-1 if has_null else last)).otherwise(F.col("_own") - 1)
    ends = F.col("_own").eqNullSafe(-1) | F.coalesce(begins, F.lit(False))
    place = F.when(ends, F.array(
        F.struct(F.col("_own").alias("stretch"), F.lit(False).alias("guest")),
        F.struct(before.alias("stretch"), F.lit(True).alias("guest")),
    )).otherwise(F.array(F.struct(F.col("_own").alias("stretch"), F.lit(False).alias("guest"))))
    order = Window.partitionBy("_stretch").orderBy("_guest", F.col(id).asc_nulls_first(), text)
    gathered = (
        docs.withColumn("_own", own)
        .withColumn("_at", F.explode(place))
        .select(*docs.columns, F.col("_at.stretch").alias("_stretch"), F.col("_at.guest").alias("_guest"))
        .repartition("_stretch")
    )
    return (
        gathered.withColumns(dict(derived))
        .withColumn("next", F.lead(F.struct(text, *derived)).over(order))
        .filter(~F.col("_guest"))
        .drop("_stretch", "_guest")
    )


def fingerprints(
    docs: DataFrame, id: str = "doc_id", text: str = "text", stretches: int = STRETCHES
) -> DataFrame:
    """One row per document: ``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = (
        with_next(rows, "id", "text", {"print": marked(F.col("text"))}, stretches)
        .withColumn("n_chars", n.cast("long"))
        .withColumn("edited", F.concat(
            F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.text"), F.lit(1), cut)))
        .withColumn("edited_print", marked(F.col("edited")))
    )
    return edited.select(
        F.col("id").alias(id), "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print.marks"), F.col("edited_print.marks")).alias("near_edited"),
        likeness(F.col("print.marks"), F.col("next.print.marks")).alias("near_next"),
    )
