"""Exact dedup, mixing, syncmers and licences against brute force on awkward rows."""

import collections
import hashlib
import re
import struct

import pytest
import xxhash
from helpers import SCHEMA, awkward, frame, words
from pyspark.sql import functions as F

from shelfcast.llm import exact_dedup, licenses, mixing, syncmers


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_groups(docs, rows):
    got = exact_dedup.exact_duplicates(docs).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r[0])
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    assert len(got) == len(rows)
    kept = collections.Counter()
    for g in got:
        ids = by_sha[g.text_sha256]
        known = [i for i in ids if i is not None]
        assert g.group_size == len(ids) and g.keep_id == (min(known) if known else None)
        kept[g.text_sha256] += g.kept
        assert not g.kept or g.doc_id == g.keep_id
    assert set(kept.values()) == {1} and len(kept) == len(by_sha)


def test_exact_filter_keeps_columns_and_one_of_each(docs, rows):
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = [normal(r.text) for r in left.collect()]
    assert sorted(texts) == sorted({normal(r[1]) for r in rows})


def test_exact_refines_texts_with_one_length_and_prefix(spark):
    head = "h" * 80
    rows = [(k, head + t) for k, t in enumerate(["a", "b", "a", "c"])]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {g.doc_id: g.keep_id for g in got} == {0: 0, 1: 1, 2: 0, 3: 3}


def test_hot_group_is_joined_whole(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.exact_duplicates(docs)
    assert got.count() == 4000
    assert got.filter("group_size = 1334 AND keep_id = 0").count() == 1334


def test_mix_meets_targets(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted([s for s in size if s is not None], key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, total = {}, sum(size.values())
    open_ = set(order)
    while True:  # reshare the excess until no source is above its cap
        rest = total - sum(3 * size[s] for s in order if s not in open_)
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            break
        open_ -= over
    target = {s: share[s] if s in open_ else 3.0 * size[s] for s in order}
    taken = collections.Counter()
    by_size = {(v, round(target[s], 6)): s for s, v in size.items()}
    largest = max(g.size for g in got)
    for g in got:
        s = by_size[(g.source_size, round(g.target, 6))]
        taken[s] += g.taken
        assert 0 <= g.taken <= 3 * g.size
    for s in order:
        assert abs(taken[s] - target[s]) <= 2 * largest
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda g: (g.doc_id is None, g.doc_id or 0, g.size, g.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_repeats_rows(docs):
    plan = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == plan


def anchors(text):
    return syncmers.anchors(F.lit(text))


def test_syncmers_do_not_depend_on_context(spark):
    passage = " ".join(f"w{k * k % 97}" for k in range(40))
    rows = [(0, passage), (1, "a b c d e f g " + passage + " h i j")]
    found = {r.k: r.a for r in spark.createDataFrame(rows, "k int, t string").select("k", syncmers.anchors(F.col("t")).alias("a")).collect()}
    inside = {(a.position + 7, a.hash) for a in found[0]}
    there = {(a.position, a.hash) for a in found[1]}
    assert inside and inside <= there
    # every k-mer of the passage that is no syncmer alone is none inside either
    assert {p for p, _ in there if 7 <= p <= 7 + 35} == {p for p, _ in inside}


def test_fingerprints_and_edits(docs, rows):
    got = syncmers.fingerprints(docs, stretches=7).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    texts = [r[1] or "" for r in order]
    expected = collections.Counter()
    for k, t in enumerate(texts):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + texts[(k + 1) % len(texts)][:cut]
        expected[(order[k][0], len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert collections.Counter((g.doc_id, g.n_chars, g.edited_sha256) for g in got) == expected
    assert all(0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1 for g in got)
    of = collections.defaultdict(set)
    for g in got:
        of[g.doc_id].add(g.fingerprint)
    same = [r[0] for r in rows if r[1] == rows[0][1]]
    assert len(set.union(*(of[i] for i in same))) == 1
    assert of[2] != of[3]


def chained_hash(*parts):
    """Spark's 64-bit hash of several packed values: the hash of one seeds the next."""
    seed = 42
    for data in parts:
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - 2**64 if seed >= 2**63 else seed


def long_hash(*longs, gap=None):
    return chained_hash(*[struct.pack("<q", h) for h in longs], *([] if gap is None else [struct.pack("<i", gap)]))


def brute_marks(text):
    own = words(text)
    k, s = syncmers.K, syncmers.S
    if len(own) < k:
        found = [(0, chained_hash(" ".join(own).encode()))] if own else []
    else:
        pieces = [chained_hash(a.encode(), b.encode()) for a, b in zip(own, own[1:])]
        found = []
        for i in range(len(own) - k + 1):
            inner = pieces[i:i + k - s + 1]
            if min(inner[0], inner[-1]) <= min(inner[1:-1]):
                found.append((i, long_hash(inner[0], inner[2], inner[3])))
    return {
        long_hash(h, found[n + 1][1], gap=found[n + 1][0] - p) if n + 1 < len(found) else long_hash(h)
        for n, (p, h) in enumerate(found)
    }


def brute_likeness(a, b):
    a, b = brute_marks(a), brute_marks(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited_text(text, after):
    cut = len(text) // 4
    return text[: len(text) - cut] + after[:cut]


def test_likeness_is_the_share_of_common_marks(spark, docs, rows):
    a = [f"w{k}" for k in range(400)]
    texts = [" ".join(a), " ".join(a[:300] + [f"v{k}" for k in range(100)]), "z y x w v u t", "", None, "one", "one " * 50,
             " ".join(["x", *a[:200], "y", *a[200:]]), " ".join(a[200:] + a[:200])]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in syncmers.fingerprints(made, stretches=4).collect()}
    for k, text in enumerate(texts):
        after = texts[(k + 1) % len(texts)] or ""
        assert got[k].near_next == brute_likeness(text or "", after)
        assert got[k].near_edited == brute_likeness(text or "", edited_text(text or "", after))
    assert 0.5 < got[0].near_next < 0.7 and got[3].near_next == 1.0 and got[7].near_next > 0.9
    # rows of one id are ordered by text, so those with an id of their own are compared here
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    found = collections.Counter((g.doc_id, g.near_edited, g.near_next) for g in syncmers.fingerprints(docs, stretches=7).collect())
    expected = collections.Counter()
    for k, r in enumerate(order):
        text, after = r[1] or "", order[(k + 1) % len(order)][1] or ""
        expected[(r[0], brute_likeness(text, edited_text(text, after)), brute_likeness(text, after))] += 1
    assert found == expected


def test_small_edit_of_a_very_long_text_shows(spark):
    """600 words in a row of 60,000 change: likeness is below 1 by that share, and the fingerprints differ."""
    long = [f"w{k * k % 7919}" for k in range(60_000)]
    other = long[:30_000] + [f"edit{k}" for k in range(600)] + long[30_600:]
    made = spark.createDataFrame([(0, " ".join(long)), (1, " ".join(other))], "doc_id long, text string")
    first, second = sorted(syncmers.fingerprints(made).collect(), key=lambda r: r.doc_id)
    assert first.near_next == second.near_next == brute_likeness(" ".join(long), " ".join(other)) < 1
    assert first.near_next > 0.9 and first.fingerprint != second.fingerprint


def test_single_document_follows_itself(spark):
    text = "one two three four five six seven eight"
    row = syncmers.fingerprints(spark.createDataFrame([(5, text)], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256((text[:30] + text[:9]).encode()).hexdigest() and row.near_next == 1.0


FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_licences(spark):
    texts = [
        "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
        "Released under the MIT License. mit-license MIT\nLICENSE", "apache licence", "...Apache License", None, "", "cc, by; cc", "mitlicense",
        "É mit license", "word " * 3000 + "gnu general public license", "the the by", "gnu general public gnu general public license license",
    ]
    rows = [(k, t, "x") for k, t in enumerate(texts)] + [(None, texts[0], "y"), (3, texts[3], "x")]
    got = licenses.scan_licences(spark.createDataFrame(rows, "doc_id long, text string, hits string")).collect()
    assert len(got) == len(rows)
    by_text = {r[0]: r[1] for r in rows}
    for g in got:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (by_text[g.doc_id] or "").translate(FOLD))
        places = [(k, label) for phrase, label in licenses.BASE for k in range(len(own)) if own[k:k + len(phrase.split())] == phrase.split()]
        assert (g.n_words, g.n_base) == (len(own), len(places))
        assert (g.first_word, g.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert g.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and 0 <= g.score <= 1
    labels = {g.doc_id: g.labels for g in got}
    assert labels[0] == "cc-by,cc-by-nc" and labels[1] == "gpl,gpl-3.0" and labels[3] == "" and labels[4] == "apache"


def test_every_notice_of_a_bundle_is_found(spark):
    """However common its words are and however many notices or ordinary words stand beside it."""
    known = licenses.templates()
    own = [(label, " ".join(words)) for _, is_base, label, words, _ in known if not is_base]
    every = {label for _, _, label, _, _ in known}
    texts = ["\n\n".join(notice for _, notice in own), "\n\n".join(notice for _, notice in own[::-1])]
    filler = " ".join(["and are source forms with any use to in or is"] * 200)
    texts += [f"{filler} {notice}. {filler}" for _, notice in own]
    by_label = dict(own)
    texts += [f"{by_label['apache-2.0']}\n{by_label['bsd']}", "lesser general public license"]
    rows = [(k, t) for k, t in enumerate(texts)]
    common = ["gnu general public license", "apache license", "mit license"]
    rows += [(-k, common[k % 3]) for k in range(1, 3001)]
    got = {g.doc_id: set(g.labels.split(",")) for g in licenses.scan_licences(
        spark.createDataFrame(rows, "doc_id long, text string")).filter("doc_id >= 0").collect()}
    assert got[0] == every and got[1] == every
    for k, (label, _) in enumerate(own):
        assert label in got[2 + k], label
    assert got[2 + len(own)] >= {"apache-2.0", "bsd"} and got[3 + len(own)] == {"lgpl"}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for made in (
        exact_dedup.exact_duplicates(docs), exact_dedup.drop_exact_duplicates(docs), mixing.mix(docs), mixing.mixed(docs),
        syncmers.fingerprints(docs), licenses.scan_licences(docs),
    ):
        assert made.count() == 0
