"""Near copies at a wide distance against brute force: shared blocks, verified sets, components, what stays."""

import itertools
import random

import pytest
from helpers import SCHEMA, awkward, frame, words
from pyspark.sql import functions as F

from shelfcast.llm import simhash, simhash_wide


def shingles(text, size=5):
    own = words((text or "").translate(simhash.FOLD))
    return {tuple(own[k:k + size]) for k in range(max(1, len(own) - size + 1))} if own else set()


def brute_groups(texts):
    """A group number for each text, from every pair."""
    masks = [m % (1 << 64) for m in simhash_wide.block_masks()]
    prints = [simhash.fingerprint(t, simhash_wide.SIZE) % (1 << 64) for t in texts]
    least, sets = {}, []
    for p, t in zip(prints, texts):
        least.setdefault(p, t)
    sets = [shingles(least[p]) for p in prints]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        differ = prints[a] ^ prints[b]
        if differ.bit_count() <= simhash_wide.BITS and any(not differ & m for m in masks):
            x, y = sets[a], sets[b]
            if not differ or (x | y and 5 * len(x & y) >= 4 * len(x | y)):
                root[find(a)] = find(b)
    return [find(k) for k in range(len(texts))]


def brute_kept(rows):
    """Ids that stay, of rows ordered by id with NULL last."""
    kept = {}
    for r, c in zip(rows, brute_groups([r[1] for r in rows])):
        kept.setdefault(c, r[0])
    return sorted(kept.values(), key=lambda i: (i is None, i))


def copies(seed=3, groups=6, size=14):
    """Chains of copies with one to four words changed, long and short, and texts of their own."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(2000)]
    texts = []
    for g in range(groups):
        base = [r.choice(vocabulary) for _ in range(60 + 60 * g)]
        for _ in range(size):
            text = list(base)
            for _ in range(r.randint(1, 4)):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            texts.append(" ".join(text))
        texts.append(" ".join(r.choice(vocabulary) for _ in range(80)))
    r.shuffle(texts)
    return [(k, t) for k, t in enumerate(texts)]


def ids(docs):
    return sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is None, i))


@pytest.mark.parametrize("crowded", [5, 128])
def test_groups_by_either_way(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash_wide, "CROWDED", crowded)
    rows = copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert ids(simhash_wide.drop_near_copies(docs)) == brute_kept(rows)


def test_most_similar_pairs_meet_and_others_stay():
    rows = copies(seed=8, groups=10)
    texts = [r[1] for r in rows]
    groups, sets = brute_groups(texts), [shingles(t) for t in texts]
    similar = [
        groups[a] == groups[b] for a, b in itertools.combinations(range(len(texts)), 2)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    assert len(similar) > 300 and sum(similar) / len(similar) >= 0.9
    alone = [k for k, own in enumerate(sets) if not any(own & other for j, other in enumerate(sets) if j != k)]
    assert len(alone) == 10 and all(groups.count(groups[k]) == 1 for k in alone)


def test_awkward_and_empty_rows(spark):
    rows = sorted(awkward(), key=lambda r: (r[0] is None, r[0] or 0))
    docs = frame(spark, rows).repartition(5)
    got = simhash_wide.drop_near_copies(docs)
    assert got.columns == docs.columns
    assert got.count() == len(brute_kept(rows))
    assert simhash_wide.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_of_any_type(spark):
    rows = copies(groups=2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.format_string("d%05d", "doc_id"))
    assert ids(simhash_wide.drop_near_copies(docs)) == [f"d{i:05d}" for i in brute_kept(rows)]


def test_every_pair_within_the_sure_distance_shares_a_block():
    masks = [m % (1 << 64) for m in simhash_wide.block_masks()]
    r = random.Random(2)
    for _ in range(2000):
        differ = sum(1 << b for b in r.sample(range(64), simhash_wide.BLOCKS - simhash_wide.SHARED))
        assert any(not differ & m for m in masks)


def test_sets_of_long_texts_equal_a_plain_set(monkeypatch):
    r = random.Random(5)
    text = " ".join(r.choice("abcdefgh") * r.randint(1, 3) for _ in range(400))
    whole = simhash_wide.shingle_set(text)
    monkeypatch.setattr(simhash_wide, "CHUNK", 7)
    assert (simhash_wide.shingle_set(text) == whole).all() and len(whole) == len(shingles(text))
