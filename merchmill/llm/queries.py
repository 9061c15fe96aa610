"""The registered queries of the operators, each over its whole table, and the SQL that some must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchmill.llm import (clustering, exact_dedup, lm_scoring, minhash_dedup, packing, quality_classifier, quality_rules, suffix_dedup,
                           token_counts, token_store, unigram_pieces, warc, whitening)
from merchmill.llm.common import shared_path, table


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_unigram_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_pieces.encode_documents(table(spark, sf_dir, "documents"), digests=True)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents")).drop(*quality_rules.RATES)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), shared_path(spark, "token-store")).drop("copy", "shard")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("measured")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_lm_scoring, op2_exact_dedup, op3_best_fit_packing, op4_quality_classifier, op5_unigram_pieces, op6_suffix_dedup, op7_warc, op8_quality_rules, op9_minhash_near_dedup, op10_token_counts,
        op11_token_store, op12_embedding_whitening, op13_centroid_clustering)
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
f AS (SELECT html, min(page_id) AS first_id FROM p WHERE size >= 100 GROUP BY html)
SELECT page_id, size AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
""",
    "op8_quality_rules": quality_rules.SQL,
    "op13_centroid_clustering": clustering.SQL,
    "op9_minhash_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM c JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * both_ >= 85 * (p.n + q.n - both_)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       coalesce(component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN low ON w.doc_id = low.x
""",
}
