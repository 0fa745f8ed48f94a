"""The pipeline's stages on whole small tables and on awkward rows; queries against their SQL."""

import collections

import pytest
from helpers import SCHEMA, awkward, frame, words
from oracle_compare import compare, connect
from pyspark.sql import functions as F
from test_native import normal
from test_wide import brute_groups

import corpus_pipeline
from shelfcast.llm import langid, packing
from shelfcast.llm.common import store
from shelfcast.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, name):
    problem, _ = compare(QUERIES[name](spark, small), connect(small), ORACLES[name])
    assert problem is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op12_prefix_trie", "op13_filter_audit"}))
def test_query_has_a_row_per_document(spark, small, name):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert sorted(r.doc_id for r in QUERIES[name](spark, small).collect()) == sorted(r.doc_id for r in docs.collect())


def test_stages_against_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    known = store(stage["language"](spark, docs, small), "t")
    assert known.columns == docs.columns
    model = langid.train(docs)
    assert sorted(r.doc_id for r in known.collect()) == sorted(r.doc_id for r in docs.collect() if model.predict(r.text)[2])
    exact = store(stage["exact_dedup"](spark, known, small), "t")
    first = {}
    for r in sorted(known.collect(), key=lambda r: r.doc_id):
        first.setdefault(normal(r.text), r.doc_id)
    assert sorted(r.doc_id for r in exact.collect()) == sorted(first.values())
    near = store(stage["near_dedup"](spark, exact, small), "t")
    rows = sorted(exact.collect(), key=lambda r: r.doc_id)
    roots = brute_groups([r.text for r in rows])
    kept = {}
    for r, c in zip(rows, roots):
        kept.setdefault(c, r.doc_id)
    assert sorted(r.doc_id for r in near.collect()) == sorted(kept.values())
    mixed = store(stage["mixing"](spark, near, small), "t")
    assert mixed.columns == docs.columns
    times = collections.Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(kept.values()) and max(times.values()) <= 3
    total = sum(len(words(r.text)) for r in near.collect())
    assert abs(sum(len(words(r.text)) for r in mixed.collect()) / total - 1) < 0.1
    last = stage["packing"](spark, mixed, small)
    assert collections.Counter(r.doc_id for r in last.collect()) == times


def test_pipeline_on_awkward_and_empty_rows(spark, tmp_path):
    frame(spark, awkward()).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/a").count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_length_bins_hold_their_lengths(spark):
    rows = spark.range(1, 5000).select("id", packing.length_bin(F.col("id")).alias("b")).collect()
    assert all(r.b >= r.id and (r.b - r.id) <= max(0, r.id // 128) for r in rows)
    assert all(a.b <= b.b for a, b in zip(rows, rows[1:]))
