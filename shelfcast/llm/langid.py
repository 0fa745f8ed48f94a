"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

Subwords are the 1- to 4-byte pieces of the lower-cased text in UTF-8, with
everything but letters read as a space; each is hashed to a bucket with an
embedding.  A text is the mean of its embeddings, and a linear softmax gives the
languages.  Both are trained together by stochastic gradient descent in numpy.

Only documents whose ``crc32(id as text) % 4`` is not 2 and that have a
language are learned from, of those a sample of about ``per_language`` for each
language (all of a rarer one): the one bounded step, since a linear model of four languages
gains nothing from more.  The sample has about SAMPLE texts in all, so a corpus
of very many languages has fewer of each, and the LANGUAGES most frequent ones
are learned (of equally frequent ones the first by name).  The executors turn
sampled texts into bucket counts, packed as 2 bytes for a bucket and 4 for its
count, so the driver holds ``SAMPLE x BUCKETS x 6`` bytes at most, and as a rule
a tenth of that.  A fifth of the sample is kept from training and sets the
temperature of the softmax.  The rejection level is the one that a share
``loss`` of texts fall under with the score of their best language: counted over
all labelled texts outside the sample, in bins of the score; where these are
fewer than ``1 / loss``, taken from a normal law of the log-odds of that fifth.
Whole texts are predicted where they lie.  ``identified_once`` and
``keep_once`` learn, predict each text once into a table, and take the level
from that table.

Defined results: a NULL text and one without a letter give ``und``, score 0, and
are rejected.  A NULL id is read as an empty text for the fold.  Without any
labelled text everything is ``und``.  Repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.numeric import hashed_uniform
from shelfcast.llm.common import fresh, store

UNKNOWN = "und"
PER_LANGUAGE = 500
SAMPLE = 4000
LANGUAGES = 1000
BUCKETS = 1 << 14
WIDTH = 16
LOSS = 0.002
# Bins of the score when the level is counted.
BINS = 10_000
# A small sample is gone over more often.
LEAST_STEPS = 8000
# Bytes hashed at a time, so that memory does not follow the longest text.
CHUNK = 1 << 20
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket is hit by the subwords of the text."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split()) + b" ", np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.float32)
    for start in range(0, len(data), CHUNK):
        part = data[start:start + CHUNK + 3].astype(np.uint32)
        own = min(CHUNK, len(part))
        gram = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, 5):
            ends = len(part) - n + 1
            if ends <= 0:
                break
            gram = gram[:ends] * np.uint32(257) + part[n - 1:n - 1 + ends] + np.uint32(1)
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(2246822519)
            counts += np.bincount(mixed[:min(own, ends)] >> np.uint32(18), minlength=BUCKETS)
    return counts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True, initial=-np.inf))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Model:
    """Class scores are ``counts @ table / counts.sum() + bias``: the embeddings and the softmax multiplied out."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    level: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        logits = (counts @ self.table / max(1.0, counts.sum()) + self.bias) / self.temperature
        return softmax(logits)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, False
        p = self.probabilities(bucket_counts(text))
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] >= self.level)


def level_of(scores: np.ndarray, loss: float) -> float:
    """The score that a share ``loss`` of texts fall under; few texts do not show it, so their log-odds are taken as normal."""
    if len(scores) * loss >= 1:
        return float(np.sort(scores)[int(loss * len(scores))])
    p = np.clip(scores, 1e-9, 1 - 1e-9)
    odds = np.log(p / (1 - p))
    low = odds.mean() + NormalDist().inv_cdf(loss) * odds.std()
    return float(1 / (1 + np.exp(-low)))


def fit(
    samples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 0, epochs: int = 5, rate: float = 10.0,
    loss: float = LOSS,
) -> Model:
    """Trains on ``(language, buckets, counts)``, in the order given."""
    languages = sorted({s[0] for s in samples})
    label = [languages.index(s[0]) for s in samples]
    share = [(s[2] / max(1.0, s[2].sum())).astype(np.float32) for s in samples]
    random = np.random.default_rng(seed)
    embed = random.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    weight, bias = random.normal(0, 0.3, (WIDTH, len(languages))), np.zeros(len(languages))
    held = [i for i in range(len(samples)) if i % 5 == 4] if len(samples) >= 50 else []
    train = np.setdiff1d(np.arange(len(samples)), held)
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(train))))
    step, steps = 0, max(1, epochs * len(train))
    for _ in range(epochs):
        for i in random.permutation(train):
            at, own = samples[i][1], share[i]
            mean = own @ embed[at]
            error = softmax(mean @ weight + bias)
            error[label[i]] -= 1
            now = rate * (1 - step / steps)
            down = weight @ error
            weight -= 0.01 * now * np.outer(mean, error)
            bias -= 0.01 * now * error
            embed[at] -= (now * np.outer(own, down)).astype(np.float32)
            step += 1
    table = (embed @ weight).astype(np.float32)
    check = held or list(train)
    logits = np.array([share[i] @ table[samples[i][1]] + bias for i in check]).reshape(len(check), len(languages))
    true = np.array([label[i] for i in check], dtype=np.int64)
    rows = np.arange(len(check))
    # one pseudo-error among the texts, or perfect separation would make every answer certain
    slack = 1.0 / (len(check) + 1)
    best = (np.inf, 1.0)
    for t in np.geomspace(0.02, 50, 80):
        p = np.maximum(softmax(logits / t), 1e-12)
        wrong = np.log(p).sum(1) - np.log(p[rows, true])
        nll = -((1 - slack) * np.log(p[rows, true]) + slack * wrong / max(1, len(languages) - 1)).sum()
        best = min(best, (float(nll), float(t)))
    level = level_of(softmax(logits / best[1]).max(1), loss) if check else 0.0
    return Model(languages, table, bias, best[1], level)


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def drawn(id: Column, text: Column, seed: int) -> Column:
    return hashed_uniform(F.coalesce(id.cast("string"), F.lit("")), F.xxhash64(text), seed=seed)


def is_labelled(id: Column, text: Column, lang: Column) -> Column:
    return text.isNotNull() & lang.isNotNull() & ~held_out(id)


def language_rates(docs: DataFrame, id: str, text: str, lang: str, per_language: int) -> DataFrame:
    """``learned, rate``: the languages that are learned, LANGUAGES at most, and the share of their texts that is drawn."""
    sizes = docs.filter(is_labelled(F.col(id), F.col(text), F.col(lang))).groupBy(
        F.col(lang).cast("string").alias("learned")).agg(F.count(F.lit(1)).alias("n"))
    kept = store(sizes.orderBy(F.desc("n"), "learned").limit(LANGUAGES), "langid-sizes")
    each = max(1, min(per_language, SAMPLE // max(1, kept.count())))
    return kept.select("learned", (F.lit(float(each)) / F.col("n")).alias("rate"))


def featured(batches):
    """Sampled texts as packed bucket counts."""
    for frame in batches:
        rows = []
        for key, language, own in zip(frame["order"], frame["lang"], frame["text"]):
            if has_letter(own):
                counts = bucket_counts(own)
                at = np.flatnonzero(counts)
                rows.append((key, language, at.astype("<u2").tobytes(), counts[at].astype("<f4").tobytes()))
        yield pd.DataFrame(rows, columns=["order", "lang", "buckets", "counts"])


def fitted(docs: DataFrame, rates: DataFrame, id: str, text: str, lang: str, seed: int) -> Model:
    """The model, with the level of its own check fold."""
    own = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(
        is_labelled(F.col("id"), F.col("text"), F.col("lang")))
    # at most LANGUAGES rows, so the texts stay where they are
    sample = own.join(F.broadcast(rates), F.col("lang") == F.col("learned")).filter(
        drawn(F.col("id"), F.col("text"), seed) < F.col("rate"))
    rows = sample.select(F.xxhash64("id", "text").alias("order"), "lang", "text").mapInPandas(
        featured, "order long, lang string, buckets binary, counts binary")
    # collected in a fixed order, so that reruns train alike
    found = store(rows, "langid-sample").orderBy("order", "lang").drop("order").toArrow()
    unpack = lambda column, kind: [np.frombuffer(v.as_buffer(), kind) for v in found.column(column)]
    return fit(list(zip(found.column("lang").to_pylist(), unpack("buckets", "<u2"), unpack("counts", "<f4"))), seed)


def train(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE,
    seed: int = 0,
) -> Model:
    rates = language_rates(docs, id, text, lang, per_language)
    model = fitted(docs, rates, id, text, lang, seed)
    rest = docs.select(F.col(text).alias("text"), unseen(id, text, lang, seed).alias("labelled"), F.col(lang).cast("string").alias("learned"))
    scored = rest.filter("labelled IS NOT NULL").join(F.broadcast(rates), "learned").filter("labelled >= rate")
    return replace(model, level=counted_level(scored.select(predicted(F.col("text"), model).alias("p")), model, LOSS))


def unseen(id: str, text: str, lang: str, seed: int) -> Column:
    """A labelled text's draw, to be compared with its language's rate; NULL for the others."""
    return F.when(is_labelled(F.col(id), F.col(text), F.col(lang)), drawn(F.col(id), F.col(text), seed))


def counted_level(scored: DataFrame, model: Model, loss: float) -> float:
    """The level from the predictions (``p``) of texts that the model has not seen, or its own where they are few."""
    known = scored.filter(F.col("p.lang") != UNKNOWN)
    bins = known.groupBy(F.floor(F.col("p.score") * BINS).alias("bin")).count().collect()  # BINS rows at most
    below, total = 0, sum(r["count"] for r in bins)
    if total * loss < 1:
        return model.level
    for r in sorted(bins, key=lambda r: r["bin"]):
        below += r["count"]
        if below > loss * total:
            return r["bin"] / BINS
    return model.level


def predicted(text: Column, model: Model) -> Column:
    """A struct ``lang, score, accepted``."""

    @F.pandas_udf("lang string, score double, accepted boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score", "accepted"])

    return of(text)


def identified(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id, held_out, lang_pred, score, accepted``."""
    return docs.select(F.col(id), held_out(F.col(id)).alias("held_out"), predicted(F.col(text), model).alias("p")).select(
        id, "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.accepted").alias("accepted"),
    )


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents whose language is accepted, with all their columns."""
    name = fresh(docs.columns, "_language")
    return docs.withColumn(name, predicted(F.col(text), model)).filter(F.col(name)["accepted"]).select(*docs.columns)


def predicted_once(
    docs: DataFrame, columns: list[str], id: str, text: str, lang: str, seed: int,
) -> tuple[DataFrame, str, Column]:
    """Stored ``columns`` with each text's prediction; the name of that struct, and whether it is accepted."""
    rates = language_rates(docs, id, text, lang, PER_LANGUAGE)
    model = fitted(docs, rates, id, text, lang, seed)
    name, draw, spoken = (fresh(docs.columns, n) for n in ("_language", "_draw", "_spoken"))
    rows = store(
        docs.select(
            *[F.col(c) for c in columns], predicted(F.col(text), model).alias(name), unseen(id, text, lang, seed).alias(draw),
            F.col(lang).cast("string").alias(spoken)),
        "langid-scored",
    )
    rest = rows.select(F.col(name).alias("p"), F.col(draw).alias("draw"), F.col(spoken).alias("learned")).join(
        F.broadcast(rates), "learned").filter("draw >= rate")
    level = counted_level(rest, model, LOSS)
    return rows, name, (F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] >= level)


def identified_once(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0) -> DataFrame:
    """What ``identified`` gives with the model of ``train`` on the same documents, with one prediction per text."""
    rows, name, accepted = predicted_once(docs, [id], id, text, lang, seed)
    return rows.select(
        id, held_out(F.col(id)).alias("held_out"), F.col(name)["lang"].alias("lang_pred"), F.col(name)["score"].alias("score"),
        accepted.alias("accepted"),
    )


def keep_once(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", seed: int = 0) -> DataFrame:
    """What ``keep_identified`` gives with the model of ``train`` on the same documents, with one prediction per text."""
    rows, _, accepted = predicted_once(docs, docs.columns, id, text, lang, seed)
    return rows.filter(accepted).select(*docs.columns)
