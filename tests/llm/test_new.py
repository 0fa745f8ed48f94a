"""Decontamination, conversation trie and filter audit against brute force on awkward rows."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SCHEMA, awkward, frame

from shelfcast.llm import decontaminate, filter_audit, prefix_trie

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(5).cache()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination ---------------------------------------------------------

def found_words(text):
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer((text or "").translate(UPPER))]


def brute_hits(text, items, window):
    own = found_words(text)
    plain, hit, names = [w for w, _, _ in own], set(), set()
    for name, item in items:
        w = [x for x, _, _ in found_words(item)]
        for s in range(max(1, len(w) - window + 1) if w else 0):
            g = w[s:s + window]
            for k in range(len(plain) - len(g) + 1):
                if plain[k:k + len(g)] == g:
                    hit |= set(range(k, k + len(g)))
                    names |= {str(name)} - {"None"}
    runs = []
    for k in sorted(hit):
        if runs and runs[-1][1] == k - 1:
            runs[-1][1] = k
        else:
            runs.append([k, k])
    return len(own), [(a, b, own[a][1], own[b][2]) for a, b in runs], sorted(names)


def benchmark(rows):
    """Items that are pieces of the documents, short ones, repeats, equal texts, NULLs."""
    r = random.Random(3)
    items = []
    for k, t in enumerate([t for _, t, *_ in rows if t][:40:4]):
        w = t.split()
        a = r.randrange(max(1, len(w) - 12))
        items.append((k, " ".join(w[a:a + r.choice([3, 12, 25])]).upper() + "!"))
    items += [(100, items[2][1]), (items[3][0], items[3][1]), (None, items[4][1]), (7, "stone cloud"), (101, None), (102, " . "),
              (103, "Ω≈ 漢字"), (104, "never seen anywhere"), (105, "the")]
    return items


@pytest.mark.parametrize("part_windows", [10**6, 5])
def test_hits_are_the_occurring_windows(spark, docs, rows, part_windows):
    items = benchmark(rows)
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, _row string")
    window = 4
    got = decontaminate.benchmark_hits(docs, table, window=window, part_windows=part_windows).collect()
    expected = collections.Counter(
        (r[0], n, tuple(runs), tuple(names)) for r in rows for n, runs, names in [brute_hits(r[1], items, window)])
    assert collections.Counter((g.id, g.n_words, tuple(map(tuple, g.runs)), tuple(g["items"])) for g in got) == expected


def test_contamination_columns(spark, docs, rows):
    items = benchmark(rows)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = collections.Counter(map(tuple, decontaminate.contamination(docs, table).collect()))
    expected = collections.Counter()
    for r in rows:
        n, runs, names = brute_hits(r[1], items, 10)
        expected[r[0], n, sum(b - a + 1 for a, b, *_ in runs), len(names), sha(",".join(names)), bool(runs)] += 1
    assert got == expected


def test_long_texts_and_items_are_scanned_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 7)
    monkeypatch.setattr(decontaminate, "STRETCH", 5)
    r = random.Random(5)
    text = " ".join(r.choice(["aa", "bé", "Cc"]) for _ in range(400))
    item = " ".join(text.split()[50:90])
    automaton = decontaminate.Windows([("q", " ".join(w for w, _, _ in found_words(item)))], 6)
    n, runs, names = automaton.scan(text.encode())
    assert (n, runs, names) == brute_hits(text, [("q", item)], 6)
    cut = decontaminate.item_stretches(spark.createDataFrame([(1, item), (2, "a b")], "i int, t string"), "i", "t", 6).collect()
    whole = [w for w, _, _ in found_words(item)]
    windows = collections.Counter(
        tuple(s.words.split()[k:k + 6]) for s in cut if s.id == "1" for k in range(len(s.words.split()) - 5))
    assert set(windows) == {tuple(whole[k:k + 6]) for k in range(35)} and max(s.n for s in cut) <= 5
    assert [s.words for s in cut if s.id == "2"] == ["a b"]


def test_no_items_and_no_documents(spark, docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(docs, none).collect()
    assert len(got) == len(rows) and not any(g.contaminated or g.n_items for g in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert decontaminate.contamination(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


# --- conversation trie -------------------------------------------------------

def brute_trie(turns):
    original = collections.defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            original[c].append((t is not None, t or 0, digest, role, text))
    original = {c: [x[3:] for x in sorted(own)] for c, own in original.items()}
    built = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = tuple(original.get(lead, [])[:h] + own[h:])
    members = collections.defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[own[:d]].append(c)
    children = collections.Counter(n[:-1] for n in members if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    return collections.Counter(
        (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), children[n], leaves[n], saved[n],
         sha(",".join(str(c) for c in sorted(m) if built[c] == n)))
        for n, m in members.items())


def chats(seed=2):
    """Conversations that share beginnings, long and short ones, repeats, NULLs, equal turn numbers."""
    r = random.Random(seed)
    turns = []
    for c in [*range(0, 40), *range(100, 112), *range(230, 240), -3, -150]:
        own = [(t, r.choice(["user", "assistant"]), r.choice(["hi", "yes", "né"])) for t in range(r.choice([1, 2, 5, 9]))]
        turns += [(c, *t) for t in own]
    long = [(t, "user", f"word {t % 3}") for t in range(150)]
    for c in (300, 301, 302, 303, 304):
        turns += [(c, *t) for t in long[:150 - 11 * (c - 300)]]
    turns += [(305, None, None, None), (305, 0, None, "x"), (305, 0, "", "x"), (306, 4, "a", None), (306, 4, "a", "b")]
    turns += [(None, 0, "user", "lost"), turns[0], (400, 0, "user", "a" * 70_000), (401, 0, "user", "a" * 70_000)]
    r.shuffle(turns)
    return turns


@pytest.mark.parametrize("width", [1, 2, 6])
def test_trie(spark, width):
    turns = chats()
    table = spark.createDataFrame([(*t, "x", 1) for t in turns], "conv_id long, turn long, role string, text string, node string, total int")
    got = prefix_trie.prefix_trie(table.repartition(6), width=width).collect()
    assert collections.Counter(map(tuple, got)) == brute_trie(turns)


def test_trie_of_copies_hashes_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    turns = [(c, 0, "user", "same") for c in range(1000, 3000)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    assert collections.Counter(map(tuple, prefix_trie.prefix_trie(table).collect())) == brute_trie(turns)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- filter audit ------------------------------------------------------------

def brute_audit(docs, labels):
    first = {}
    for id, text, _ in docs:
        key = (id is None, id or 0)
        first[text or ""] = min(first.get(text or "", key), key)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for id, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {f for f, x in zip("ABCDE", [
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t), first[t] < (id is None, id or 0)]) if x}
        fails.append((lang or "", bad, id is not None and id in good, id is not None and id in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [f for f in fails if f[0] == part]
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone), f]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = total[row[-1]]
    return collections.Counter((*k, *v) for k, v in out.items())


@pytest.mark.parametrize("stretch", [3, 65_536])
def test_audit(spark, rows, stretch):
    extra = [(900 + k, t, lang, None, None, None, None, None, None, None) for k, (t, lang) in enumerate([
        ("AB cd" * 40, "en"), ("a # b", "fr"), (" ".join(f"w{i}" for i in range(150)), "de"), (" ".join(f"w{i}" for i in range(150)), "de"),
        ("x" * 300_000, "de")])]
    all_rows = rows + extra
    labels = [(k, k % 3, k % 2) for k in range(0, 60, 2)] + [(4, None, 1), (4, 1, 0), (None, 1, 1), (903, 1, None), (5000, 1, 1)]
    table = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(frame(spark, all_rows).repartition(4), table, stretch=stretch).collect()
    assert collections.Counter(map(tuple, got)) == brute_audit([r[:3] for r in all_rows], labels)


def test_audit_of_a_hot_text_and_of_nothing(spark):
    docs = spark.createDataFrame([(k, "Same text" if k % 3 else f"own {k}", "en" if k % 5 else None) for k in range(3000)], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(docs, none).collect()}
    assert len(got) == 2 * 600
    assert sum(got[p, "EABCD", 1].removed for p in ("", "en")) == 1999 and got["en", "EABCD", 1].good_lost == 0
    assert filter_audit.audit(docs.limit(0), none).count() == 0


def test_union_and_shared_by_search():
    r = np.random.default_rng(1)
    for _ in range(50):
        a, b = (np.unique(r.integers(0, 60, r.integers(0, 40))) for _ in range(2))
        assert (filter_audit.union(a, b) == np.union1d(a, b)).all()
        assert filter_audit.shared(a, b) == len(np.intersect1d(a, b))
