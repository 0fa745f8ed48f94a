"""Small documents with every awkward case, and brute-force versions shared by the tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row string, size string, n string, copies int, keep_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def awkward(count: int = 60, seed: int = 1) -> list[tuple]:
    """Rows of SCHEMA: NULLs in every column, empty and long texts, ties, repeats, clashing extra columns."""
    r = random.Random(seed)
    vocabulary = ["the", "Of", "and", "être", "ñandú", "über", "house", "tree", "river", "stone", "cloud", "x" * 40]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 4, 6, 30, 120]))) for _ in range(count - 14)]
    texts += [None, None, "", "", " \t\n", texts[0], texts[0], texts[1].replace(" ", "\n\n "), "  " + texts[2], "é" * 3000]
    texts += [" ".join(r.choice(vocabulary) for _ in range(5000)), "a", "1234 5678", "Ω≈ 漢字"]
    rows = []
    for k, t in enumerate(texts):
        lang = r.choice(["en", "fr", None])
        rows.append((k, t, lang, r.choice(["s1", "s1", "s1", "s2", None, "Z", "é"]), 0, "x", None, "y", 1, "z"))
    rows.append((None, texts[3], "en", "s1", None, None, None, None, None, None))
    rows.append((None, "only without id", None, None, None, None, None, None, None, None))
    rows += [rows[4], rows[4], rows[5][:1] + ("another text under the same id",) + rows[5][2:]]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall(text or "")
