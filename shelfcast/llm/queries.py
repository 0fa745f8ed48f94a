"""One query per operator over the whole ``documents`` table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import (
    decontaminate, exact_dedup, filter_audit, langid, licenses, mixing, packing, pii, prefix_trie, ring_shards, simhash,
    suffix_dedup, syncmers,
)
from shelfcast.llm.common import documents, table


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_syncmers": lambda spark, sf_dir: syncmers.fingerprints(documents(spark, sf_dir)),
    "op2_exact_dedup": lambda spark, sf_dir: exact_dedup.exact_duplicates(documents(spark, sf_dir)),
    "op3_ring_shards": lambda spark, sf_dir: ring_shards.shard_rows(documents(spark, sf_dir)),
    "op4_simhash": lambda spark, sf_dir: simhash.near_duplicates(documents(spark, sf_dir)),
    "op5_mixing": lambda spark, sf_dir: mixing.mix(documents(spark, sf_dir)).drop("copies"),
    "op6_suffix_dedup": lambda spark, sf_dir: suffix_dedup.remove_repeats(documents(spark, sf_dir)),
    "op7_licenses": lambda spark, sf_dir: licenses.scan_licences(documents(spark, sf_dir)),
    "op8_packing": lambda spark, sf_dir: packing.packed(documents(spark, sf_dir)),
    "op9_language_id": lambda spark, sf_dir: langid.identified_once(documents(spark, sf_dir)),
    "op10_pii": lambda spark, sf_dir: pii.personal_data(documents(spark, sf_dir)),
    "op11_decontamination": lambda spark, sf_dir: decontaminate.contamination(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark")),
    "op12_prefix_trie": lambda spark, sf_dir: prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")),
    "op13_filter_audit": lambda spark, sf_dir: filter_audit.audit(
        documents(spark, sf_dir), table(spark, sf_dir, "labels")),
}

ORACLES: dict[str, str] = {
    "op7_licenses": licenses.SQL,
    "op11_decontamination": decontaminate.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_filter_audit": filter_audit.SQL,
    "op2_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM t WINDOW same AS (PARTITION BY text_sha256)
""",
    "op5_mixing": r"""
WITH RECURSIVE sizes AS MATERIALIZED (
    SELECT doc_id, (source IS NULL)::INT AS no_source, coalesce(source, '') AS source,
           len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS size
    FROM documents
), s AS MATERIALIZED (
    SELECT no_source, source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
           [5, 2, 1][((row_number() OVER (ORDER BY no_source, source) - 1) % 3 + 1)::INT] AS weight
    FROM sizes GROUP BY no_source, source
), rounds AS (  -- reshare the excess until no source is above its cap
    SELECT 0 AS round, *, false AS full_ FROM s
    UNION ALL
    SELECT round + 1, no_source, source, source_size, cap, weight,
           full_ OR cap::DOUBLE * sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ()
               < (sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ())::DOUBLE * weight
    FROM rounds WHERE round <= (SELECT count(*) FROM s)
), done AS (
    SELECT * FROM rounds WHERE round = (SELECT max(round) FROM rounds)
), targets AS MATERIALIZED (
    SELECT no_source, source, source_size,
           CASE WHEN full_ THEN cap::DOUBLE
                ELSE (sum(source_size) OVER () - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ())::BIGINT::DOUBLE * weight
                     / (sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
    FROM done
), walk AS (
    SELECT doc_id, size, source_size, target,
           row_number() OVER (PARTITION BY no_source, source ORDER BY size, doc_id) - 1 AS place,
           CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
           ('0x' || substr(md5(no_source || '|' || source || '|0'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS start
    FROM sizes JOIN targets USING (no_source, source)
)
SELECT doc_id, size, source_size, target,
       (floor((place + 1)::DOUBLE * rate + start) - floor(place::DOUBLE * rate + start))::BIGINT * size AS taken
FROM walk
""",
}
