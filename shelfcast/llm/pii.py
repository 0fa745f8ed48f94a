"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns (email, ip, card, phone) are searched with linear scans.  The field
works on windows of tokens around digits, ``@``, bracketed ``at``, and the word
``at`` before a dotted host or, within five words, ``dot``: every run
of up to LONGEST tokens is a candidate segment, and every maximal address of up to
SPELT tokens, blanks included; with features of the whole span
(shape, digits, checksum, number range, form of an address, neighbours), and dynamic programming
over segment ends chooses boundaries and kinds jointly.  Its weights are learned
by gradient steps on the conditional likelihood; the labels are the pattern
spans of a sample of windows drawn by hash, the one bounded sample: the bound
holds per kind, at most ``per_kind`` windows with a span of each kind and
``windows`` without any, so rare kinds are not crowded out by other numbers;
each is also shown in disguises (``at`` for ``@``, ``[.]`` for a dot, 00 for a
plus; addresses also shortened to letters) with the same labels.  A decoded segment is added when its posterior
probability is at least ``SURE`` and it overlaps no pattern span.

Defined results: a NULL text counts as empty: no spans.  Without any labelled
window nothing is added.  Whole texts are scanned in linear time; a window of
more than STRETCH tokens (a table of numbers) is decoded in overlapping
stretches of that size, which bounds the memory.  Repeated rows are scanned each.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.common import store

KINDS = ["email", "ip", "card", "phone"]
# The base patterns.  Possessive runs and the look-behind only save backtracking.
HOST = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Tokens of a segment, and of an address, which takes more when its marks are spelt out.
LONGEST, SPELT = 16, 48
# Tokens around a digit, and around a mark of an address, that the field sees.
REACH, ADDRESS_REACH = 16, 32
# Windows of more characters are decoded but not drawn for training.
LONGEST_DRAWN = 600
# Tokens decoded at a time, so that memory does not follow a long run of numbers.
STRETCH = 2048
# Windows without a span, and windows with a span of each kind, that the field learns from.
WINDOWS = 400
PER_KIND = 100
SURE = 0.9
FEATURES = 1 << 13
TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")
# Read alike by Python and Java.  Words have 63 letters at most, as host names do, so a look ahead is bounded.
DIGIT_OR_AT = r"[0-9@]|[(\[{]\s?at\s?[)\]}]"
SPOKEN = (
    r"(?<![A-Za-z0-9])[Aa][Tt](?=[\x20\t]{1,3}[A-Za-z0-9-]{1,63}\.[A-Za-z0-9]"
    r"|(?:[^A-Za-z0-9\n]{1,3}[A-Za-z0-9]{1,63}){1,4}[^A-Za-z0-9\n]{1,3}[Dd][Oo][Tt](?![A-Za-z0-9]))"
)
TRIGGER = re.compile(f"{DIGIT_OR_AT}|{SPOKEN}")

# An address, also with its marks in brackets or in words.
AT = r"(?:@|\s*[(\[{]\s?at\s?[)\]}]\s*|\s+at\s+)"
DOT = r"(?:\.|\s*[(\[{]\s?(?:dot|\.)\s?[)\]}]\s*|\s+dot\s+)"
ADDRESS = re.compile(rf"(?i)[a-z0-9_%+-]+(?:{DOT}[a-z0-9_%+-]+)*{AT}[a-z0-9-]+(?:{DOT}[a-z0-9-]+)+")
# The same, as much as there is of it, from the beginning of a word.  Possessive words and counted labels keep it linear.
WHOLE_ADDRESS = re.compile(
    rf"(?i)(?<![a-z0-9_%+-])[a-z0-9_%+-]++(?:{DOT}[a-z0-9_%+-]++){{0,8}}{AT}[a-z0-9-]++(?:{DOT}[a-z0-9-]++){{1,8}}")

Span = tuple[int, int, int]  # start, end, number of the kind


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches: each ``@`` with all the local part before it that is free."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL_END.match(text, start - 1):
            start -= 1
        found = HOST.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        # a character before a failed @ is never the local part of a later one
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind."""
    spans = []
    if "@" in text:
        spans += [(s, e, 0) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), m.end(), 2))
    if "+" in text:
        spans += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def windows_of(text: str) -> list[tuple[int, int]]:
    """Stretches of the text around triggers, in characters; they meet nothing that could be part of a segment outside."""
    tokens = [m.start() for m in TOKEN.finditer(text)] if TRIGGER.search(text) else []
    if not tokens:
        return []
    starts = np.array(tokens)
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        k = int(np.searchsorted(starts, m.start(), side="right")) - 1
        reach = REACH if m.group().isdecimal() else ADDRESS_REACH
        first = int(starts[max(0, k - reach)])
        last = int(starts[k + reach + 1]) if k + reach + 1 < len(starts) else len(text)
        # a wide reach may begin before windows that were separate so far
        while out and first <= out[-1][1]:
            a, b = out.pop()
            first, last = min(first, a), max(last, b)
        out.append([first, last])
    return [(a, b) for a, b in out]


def shape(text: str) -> str:
    """Digits runs with their length up to four, letters as ``a``, other characters as they are."""
    out = re.sub(r"[^\W\d_]+", "a", text)
    return re.sub(r"[0-9]+", lambda m: str(min(5, len(m.group()))), out)


def segment_features(text: str, before: str, after: str, tokens: int, whole: bool) -> list[int]:
    digits = digits_of(text)
    form = shape(text)
    numbers = re.findall(r"[0-9]+", text)
    loose = re.sub(r"[^0-9a]+", "_", form)
    facts = [
        "bias", f"form {form[:40]}", f"loose {loose[:40]}", f"digits {min(20, len(digits))}",
        f"before {shape(before)[-1:]}", f"after {shape(after)[:1]}", f"first {form[:1]}", f"last {form[-1:]}",
        f"at {'@' in text or bool(re.search(r'(?i)[^a-z]at[^a-z]', text))}", f"tokens {min(tokens, LONGEST)}",
        f"letters {bool(re.search('[A-Za-z]', text))}",
    ]
    if ADDRESS.fullmatch(text):
        facts += ["address", f"whole address {whole}"]
    if 14 <= len(digits) <= 19:
        facts.append(f"luhn {luhn(digits)} {'a' in form}")
    if len(numbers) == 4:
        facts.append(f"octets {all(len(n) <= 3 and int(n) <= 255 for n in numbers)} {'a' in form}")
    return [zlib.crc32(f.encode()) % FEATURES for f in facts]


class Lattice:
    """Candidate segments of one window: token ends, spans and feature numbers."""

    def __init__(self, text: str):
        self.marks = [m.start() for m in TOKEN.finditer(text)] + [len(text)]
        n = len(self.marks) - 1
        token = [text[a:b] for a, b in zip(self.marks, self.marks[1:])]
        busy = [bool(re.search(r"[0-9@]", t)) or t.lower() == "at" for t in token]
        place = {mark: k for k, mark in enumerate(self.marks)}
        addresses = {(place.get(m.start(), -1), place.get(m.end(), -1)) for m in WHOLE_ADDRESS.finditer(text)}
        self.segments: list[tuple[int, int]] = []
        features = []

        def add(s: int, e: int) -> None:
            self.segments.append((s, e))
            features.append(segment_features(
                text[self.marks[s]:self.marks[e]], token[s - 1] if s else "", token[e] if e < n else "", e - s, (s, e) in addresses))

        for s in range(n):
            if not (token[s].isalnum() or token[s] in "+("):
                continue
            seen = False
            for e in range(s + 1, min(n, s + LONGEST) + 1):
                if token[e - 1] == "\n":
                    break
                seen |= busy[e - 1]
                if seen and token[e - 1].isascii() and token[e - 1].isalnum() and (e - s > 1 or len(token[s]) > 5):
                    add(s, e)
        for s, e in sorted(addresses):
            if s >= 0 and LONGEST < e - s <= SPELT and "\n" not in token[s:e]:
                add(s, e)
        width = max(map(len, features), default=1)
        # short lists repeat an index that always weighs nothing
        self.features = np.array([f + [FEATURES] * (width - len(f)) for f in features], dtype=np.int64).reshape(-1, width)
        self.ends: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, e) in enumerate(self.segments):
            self.ends[e].append(k)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return weights[:, self.features].sum(2).T if self.segments else np.zeros((0, len(KINDS)))

    def posterior(self, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Probability of every (segment, kind), and the logarithm of the normaliser."""
        scores = self.scores(weights)
        n = len(self.ends) - 1
        total = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        for e in range(1, n + 1):
            alpha[e] = np.logaddexp.reduce([alpha[e - 1], *(alpha[self.segments[k][0]] + total[k] for k in self.ends[e])])
        beta[:] = -np.inf
        beta[n] = 0.0
        for e in range(n, 0, -1):
            beta[e - 1] = np.logaddexp(beta[e - 1], beta[e])
            for k in self.ends[e]:
                s = self.segments[k][0]
                beta[s] = np.logaddexp(beta[s], beta[e] + total[k])
        if not len(scores):
            return scores, float(alpha[n])
        s, e = np.array(self.segments).T
        return np.exp(np.minimum(0.0, alpha[s, None] + scores + beta[e, None] - alpha[n])), float(alpha[n])

    def best(self, weights: np.ndarray) -> list[tuple[int, int]]:
        """``(segment, kind)`` of the best segmentation."""
        scores = self.scores(weights)
        n = len(self.ends) - 1
        value, came = [0.0] * (n + 1), [-1] * (n + 1)
        top = scores.max(1) if len(scores) else scores
        for e in range(1, n + 1):
            value[e] = value[e - 1]
            for k in self.ends[e]:
                v = value[self.segments[k][0]] + float(top[k])
                if v > value[e]:
                    value[e], came[e] = v, k
        out, e = [], n
        while e > 0:
            if came[e] < 0:
                e -= 1
            else:
                out.append((came[e], int(scores[came[e]].argmax())))
                e = self.segments[came[e]][0]
        return out[::-1]


def short_address(own: str) -> str:
    """A name and a host of two labels, in letters alone, as in most addresses that are spelt out."""
    name, host = own.split("@")
    parts = [re.sub(r"[^A-Za-z]", "", p) or "a" for p in [name, *host.split(".")[-2:]]]
    return f"{parts[0]}@{parts[1]}.{parts[2]}"


def disguised(text: str, spans: list[Span], how: int) -> tuple[str, list[Span]]:
    """The window with its spans written another way, and where they are then; from 3 on with short addresses."""
    out, moved, done = "", [], 0
    short, how = how >= 3, how % 3
    for s, e, kind in spans:
        if s < done:
            continue
        own = text[s:e]
        if kind == 0:
            own = short_address(own) if short else own
            own = own.replace("@", [" at ", "(at)", "[at]"][how]).replace(".", [" dot ", ".", "[dot]"][how])
        elif kind == 1:
            own = own.replace(".", ["[.]", "(.)", " . "][how])
        elif kind == 3:
            own = [own.lstrip("+"), "00" + own.lstrip("+"), own.replace(" ", "/")][how]
        else:
            digits = digits_of(own)
            own = [".", "/", "  "][how].join(digits[k:k + 4] for k in range(0, len(digits), 4))
        out += text[done:s]
        moved.append((len(out), len(out) + len(own), kind))
        out, done = out + own, e
    return out + text[done:], moved


def ways(spans: list[Span]) -> int:
    return 6 if any(kind == 0 for *_, kind in spans) else 3 if spans else 0


def fit(samples: list[tuple[str, list[Span]]], epochs: int = 6, rate: float = 0.3, seed: int = 0) -> np.ndarray:
    """Weights ``(kind, feature)``, learned from windows and their spans."""
    weights = np.zeros((len(KINDS), FEATURES + 1))
    weights[:, zlib.crc32(b"bias") % FEATURES] = -4.0
    ready = []
    for text, spans in samples:
        for own, marked in [(text, spans), *(disguised(text, spans, how) for how in range(ways(spans)))]:
            lattice = Lattice(own)
            place = {mark: k for k, mark in enumerate(lattice.marks)}
            number = {seg: k for k, seg in enumerate(lattice.segments)}
            gold = [(number.get((place.get(s, -1), place.get(e, -1))), kind) for s, e, kind in marked]
            if lattice.segments and all(k is not None for k, _ in gold):
                ready.append((lattice, gold))
    random = np.random.default_rng(seed)
    for epoch in range(epochs):
        for k in random.permutation(len(ready)):
            lattice, gold = ready[k]
            error = -lattice.posterior(weights)[0]
            for segment, kind in gold:
                error[segment, kind] += 1.0
            busy = np.flatnonzero(np.abs(error).max(1) > 1e-3)
            step = rate / (1 + epoch)
            for kind in range(len(KINDS)):
                np.add.at(weights[kind], lattice.features[busy], step * error[busy, kind][:, None])
            weights[:, FEATURES] = 0.0
    return weights


def stretches(text: str, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
    """Lattices ``(start, end, first, last)`` of a window; each answers for the segments that begin in ``first .. last - 1``.

    A window of many tokens is decoded in stretches that overlap by more than
    the longest segment and its neighbours.
    """
    marks = [a + m.start() for m in TOKEN.finditer(text[a:b])]
    many, around = len(marks), 2 * (LONGEST + SPELT)
    if many <= STRETCH:
        yield a, b, a, b
        return
    marks.append(b)
    for k in range(0, many, STRETCH):
        last = min(many, k + STRETCH)
        yield marks[max(0, k - around)], marks[min(many, last + around)], marks[k], marks[last]


def added_spans(text: str, base: list[Span], weights: np.ndarray) -> list[Span]:
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, e, _ in base), max))
    out, done = [], 0
    for a, b in windows_of(text):
        for origin, stop, first, last in stretches(text, a, b):
            lattice = Lattice(text[origin:stop])
            chosen = lattice.best(weights) if lattice.segments else []
            if not chosen:
                continue
            sure = lattice.posterior(weights)[0]
            for k, kind in chosen:
                s, e = lattice.segments[k]
                start, end = origin + lattice.marks[s], origin + lattice.marks[e]
                if not (first <= start < last and start >= done and sure[k, kind] >= SURE):
                    continue
                before = bisect_left(starts, end)  # base spans that begin before the end
                if before == 0 or reach[before - 1] <= start:
                    out.append((start, end, kind))
                    done = end
    return out


def train(
    docs: DataFrame, id: str = "doc_id", text: str = "text", windows: int = WINDOWS, per_kind: int = PER_KIND
) -> np.ndarray:
    limits = [per_kind] * len(KINDS) + [windows]

    def labelled(batches):
        # the least hashes of a task hold those of all that it can add to the sample
        least: list[dict[str, tuple[int, list[Span]]]] = [{} for _ in limits]

        def cut(k: int) -> None:
            least[k] = dict(sorted(least[k].items(), key=lambda x: (x[1][0], x[0]))[:limits[k]])

        for frame in batches:
            for own in frame["text"]:
                for a, b in windows_of(own):
                    if b - a > LONGEST_DRAWN:
                        continue
                    part = own[a:b]
                    spans = base_spans(part)
                    order = int.from_bytes(hashlib.blake2b(part.encode("utf-8", "replace"), digest_size=8).digest(), signed=True)
                    for k in {kind for *_, kind in spans} or {len(KINDS)}:
                        least[k][part] = (order, spans)
                        if len(least[k]) > 2 * limits[k] + 100:
                            cut(k)
        rows = []
        for k in range(len(limits)):
            cut(k)
            rows += [(k, order, part, [list(s) for s in spans]) for part, (order, spans) in least[k].items()]
        yield pd.DataFrame(rows, columns=["stratum", "order", "text", "spans"])

    found = store(
        docs.select(F.col(text).alias("text")).filter(F.col("text").rlike(TRIGGER.pattern))
        .mapInPandas(labelled, "stratum int, order long, text string, spans array<array<int>>"),
        "pii-windows",
    )
    drawn = {}
    for k, limit in enumerate(limits):
        rows = found.filter(F.col("stratum") == k).dropDuplicates(["text"]).orderBy("order", "text").limit(limit)
        drawn |= {r["text"]: [tuple(s) for s in r["spans"]] for r in rows.collect()}
    return fit(sorted(drawn.items()))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def found(text: Column, weights: np.ndarray) -> Column:
    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for own in texts:
            base = base_spans(own) if own and TRIGGER.search(own) else []
            more = added_spans(own, base, weights) if own else []
            count = [sum(k == kind for _, _, k in base) for kind in range(len(KINDS))]
            every = sorted(base + more, key=lambda s: (s[0], s[2], s[1]))
            rows.append((*count, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return of(text)


def personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, counts of the base spans, ``base_sha256, spans``."""
    weights = train(docs, id, text)
    own = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.select("id", found(F.col("text"), weights).alias("p")).select(F.col("id").alias(id), "p.*")
