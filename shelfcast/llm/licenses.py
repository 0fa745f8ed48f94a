"""Licence scan with a positional index of rare words, in DataFrame functions only.

Templates are short licence notices; their words are the licence words.  A first
pass keeps, per document, the number of words and the positions of its licence
words.  Document frequencies of those words give their IDF.  A document is
looked at further if it has the rarest mandatory word of some template, which no
alignment that counts can lack.  Its licence words
are looked up in the postings (word: template, position); a posting puts the
template at ``document position - template position``, and hits that agree on it
are added up.  An alignment counts when it holds every word of the template's
mandatory phrases; the score is the share of the template's IDF that it matches.
The base phrases are templates that are mandatory as a whole.

Defined results: a NULL text counts as empty.  Documents without a licence have
no labels (empty strings), score 0, and NULL first and last words.  Repeated
rows are scanned each.  An empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.common import fold_case, let, store

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Only the SQL has this bound on notices; the scan has none.
SEEDS = 4

# Base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Own notices: label, words, mandatory phrases.
NOTICES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", ["permission is hereby granted free of charge"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-nd", "licensed under cc by nd 4 0", ["cc by nd"]),
    ("cc0", "released under cc0 1 0 universal", ["cc0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["redistribution and use in source and binary forms"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", ["mozilla public license version 2 0"]),
]


def templates() -> list[tuple[int, bool, str, list[str], set[int]]]:
    """``(number, is_base, label, words, mandatory positions)``."""
    out = [(phrase, label, [phrase], True) for phrase, label in BASE]
    out += [(text, label, phrases, False) for label, text, phrases in NOTICES]
    rows = []
    for number, (text, label, phrases, is_base) in enumerate(out):
        words, must = text.split(), set()
        for phrase in phrases:
            part = phrase.split()
            at = next(k for k in range(len(words)) if words[k:k + len(part)] == part)
            must |= set(range(at, at + len(part)))
        rows.append((number, is_base, label, words, must))
    return rows


def licence_words(docs: DataFrame, id: str, text: str, vocabulary: list[str]) -> DataFrame:
    """Per row: ``_row, id, n_words, hits``, the positions of licence words; stored."""
    pieces = F.split(fold_case(F.coalesce(F.col(text), F.lit(""))), GAP)

    def scan(raw):
        # only the first and the last piece can be empty; an empty first one shifts the positions
        lead = (F.get(raw, F.lit(0)) == "").cast("int")
        tail = ((F.size(raw) > 1) & (F.get(raw, F.size(raw) - 1) == "")).cast("int")
        at = F.filter(F.sequence(F.lit(0), F.size(raw) - 1), lambda i: F.get(raw, i).isin(vocabulary))
        return F.struct(
            (F.size(raw) - lead - tail).cast("long").alias("n_words"),
            F.transform(at, lambda i: F.struct((i - lead).alias("at"), F.get(raw, i).alias("word"))).alias("hits"),
        )

    return store(
        docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id).alias("id"), let(pieces, scan).alias("s"))
        .select("_row", "id", "s.n_words", "s.hits"),
        "licence-words",
    )


def scan_licences(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    known = templates()
    vocabulary = sorted({w for _, _, _, words, _ in known for w in words})
    rows = licence_words(docs, id, text, vocabulary)
    total = rows.count()
    frequency = rows.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    seen = dict(frequency.collect())  # one number per licence word
    weight = {w: 1 + round(1e6 * math.log((total + 1) / (seen.get(w, 0) + 1))) for w in vocabulary}
    rare = sorted({min((words[k] for k in must), key=lambda w: (seen.get(w, 0), w)) for _, _, _, words, must in known})

    spark = docs.sparkSession
    postings = spark.createDataFrame(
        [(w, number, at, weight[w], at in must) for number, _, _, words, must in known for at, w in enumerate(words)],
        "word string, template int, template_at int, weight long, must boolean",
    )
    facts = spark.createDataFrame(
        [(n, base, label, sum(weight[w] for w in words), len(must)) for n, base, label, words, must in known],
        "template int, is_base boolean, label string, full long, needed int",
    )
    looked_at = (
        rows.filter(F.exists("hits", lambda h: h["word"].isin(rare)))
        .select("_row", F.explode("hits").alias("h"))
        .select("_row", "h.at", "h.word")
    )
    placed = (
        looked_at.join(F.broadcast(postings), "word")
        .groupBy("_row", "template", (F.col("at") - F.col("template_at")).alias("start"))
        .agg(F.sum("weight").alias("matched"), F.sum(F.col("must").cast("int")).alias("verified"))
        .join(F.broadcast(facts), "template")
        .filter(F.col("verified") == F.col("needed"))
    )
    base_start = F.when(F.col("is_base"), F.col("start"))
    found = placed.groupBy("_row").agg(
        F.count(base_start).alias("n_base"), F.min(base_start).alias("first_word"), F.max(base_start).alias("last_word"),
        F.collect_set(F.when(F.col("is_base"), F.col("label"))).alias("base_labels"),
        F.collect_set("label").alias("labels"), F.max(F.col("matched") / F.col("full")).alias("score"),
    )
    joined = lambda c: F.coalesce(F.array_join(F.sort_array(c), ","), F.lit(""))
    return rows.drop("hits").join(found, "_row", "left").select(
        F.col("id").alias(id), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        joined("base_labels").alias("base_labels"), joined("labels").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _values() -> tuple[str, str]:
    known = templates()
    postings = ", ".join(
        f"('{w}', {n}, {at}, {str(at in must).lower()})" for n, _, _, words, must in known for at, w in enumerate(words)
    )
    facts = ", ".join(f"({n}, {str(base).lower()}, '{label}', {len(must)})" for n, base, label, _, must in known)
    return postings, facts


POSTINGS_SQL, FACTS_SQL = _values()
SQL = rf"""
WITH postings(word, template, template_at, must) AS (VALUES {POSTINGS_SQL}),
facts(template, is_base, label, needed) AS (VALUES {FACTS_SQL}),
texts AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
    FROM documents
), docs AS MATERIALIZED (
    SELECT * FROM texts
), hits AS MATERIALIZED (
    SELECT r, word, pos FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM docs)
    WHERE word IN (SELECT word FROM postings)
), seen AS (
    SELECT word, count(DISTINCT r) AS n FROM hits GROUP BY word
), weights AS MATERIALIZED (
    SELECT word, coalesce(n, 0) AS n,
           1 + round(1e6 * ln(((SELECT count(*) FROM docs) + 1) / (coalesce(n, 0) + 1)))::BIGINT AS weight
    FROM (SELECT DISTINCT word FROM postings) LEFT JOIN seen USING (word)
), rare AS (
    SELECT DISTINCT word FROM (
        SELECT word, row_number() OVER (PARTITION BY template ORDER BY n, word) AS k FROM postings JOIN weights USING (word)
    ) WHERE k = 1
), seeds AS (
    SELECT r, word, row_number() OVER (PARTITION BY r ORDER BY weight DESC, word) <= {SEEDS} AS is_seed
    FROM (SELECT DISTINCT r, word FROM hits) JOIN weights USING (word)
), placed AS (
    SELECT r, template, pos - template_at AS start, sum(weight) AS matched, sum(must::INT) AS verified, bool_or(is_seed) AS seeded
    FROM hits JOIN postings USING (word) JOIN weights USING (word) JOIN seeds USING (r, word)
    WHERE r IN (SELECT r FROM hits WHERE word IN (SELECT word FROM rare))
    GROUP BY ALL
), good AS (
    SELECT r, start, is_base, label, matched::DOUBLE / (
        SELECT sum(weight) FROM postings p JOIN weights USING (word) WHERE p.template = placed.template)::DOUBLE AS score
    FROM placed JOIN facts USING (template) WHERE verified = needed AND (is_base OR seeded)
), found AS (
    SELECT r, count(*) FILTER (is_base) AS n_base, min(start) FILTER (is_base) AS first_word,
           max(start) FILTER (is_base) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (is_base) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM good GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (r)
"""
