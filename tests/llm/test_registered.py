"""Registered queries against their SQL, and the pipeline against brute force, on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from merchmill.llm import queries
from merchmill.llm.common import stored

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    want = counted([d[0] for d in result.description], result.fetchall())
    df = queries.QUERIES[name](spark, SF)
    assert counted(df.columns, map(tuple, df.collect())) == want


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark):
    import __spark_entry__
    from test_exact_dedup import norm
    from test_minhash_dedup import expected as near
    from test_packing import fits
    from test_suffix_dedup import expected as cleaned

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF), "test-stage"))
    raw, good, once, apart, clean, packed = [k.collect() for k in kept]
    assert all(k.columns == columns for k in kept[1:-1])
    assert all(labels[r.doc_id] == 0 for r in set(raw) - set(good) if r.doc_id in labels)
    best = {}
    for r in good:
        best[norm(r.text)] = max(best.get(norm(r.text), r.doc_id), r.doc_id)
    assert {r.doc_id for r in once} == set(best.values())
    assert {r.doc_id for r in apart} == {i for i, _, _, k in near([(r.doc_id, r.text) for r in once], 5, 80) if k}
    want = cleaned([(r.doc_id, r.text) for r in apart])
    assert {r.doc_id: r.text for r in clean} == {i: v[4].decode("utf-8", "ignore") for i, v in want.items()}
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    assert fits(packed, 2048) <= sum(r.length for r in packed) / 2048 * 1.05 + 1
    assert corpus_pipeline.run(spark, SF).count() == len(packed)
