"""Inserts of batches that outweigh their table."""

from pyspark.sql import functions as F
from test_keyindex import DAY, big, in_table, indexed
from test_tables import D1, D2, frame

from merchmill.sources import storage, tables
from merchmill.sources.keyindex import find_index
from merchmill.sources.tables import append_table, insert_if_absent, read_table


def test_a_large_batch_passes_the_index_by(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "LARGE_BATCH", 1)
    path, source = f"{folder}/t", f"{folder}/source"
    append_table(big(spark, 50), path, DAY)
    big(spark).unionByName(big(spark).withColumn("v", F.col("v") + 10_000)).write.parquet(source)
    with monkeypatch.context() as no_index:
        no_index.setattr(tables, "_index", lambda *a: 1 / 0)
        assert insert_if_absent(spark.read.parquet(source), path, ["k"], ["v"], DAY) == 3_950
    assert {r.k: r.v for r in read_table(spark, path, DAY).collect()} == {f"k{i}": i for i in range(4_000)}
    # small batches use the index, which is built from what the table holds now
    monkeypatch.undo()
    assert insert_if_absent(frame(spark, ("k3999", 0, D1), ("new", 1, D2)), path, ["k"], ["v"], DAY) == 1
    assert indexed(spark, path) == in_table(spark, path) and len(in_table(spark, path)) == 4_001


def test_a_large_batch_leaves_no_index_that_lacks_its_keys(spark, folder, monkeypatch):
    path, source = f"{folder}/t", f"{folder}/source"
    append_table(big(spark, 50), path, DAY)
    insert_if_absent(frame(spark, ("first", 0, D1)), path, ["k"], ["v"], DAY)  # builds the index
    assert find_index(spark, path, ["k"]) is not None
    big(spark).write.parquet(source)
    monkeypatch.setattr(tables, "LARGE_BATCH", 1)
    assert insert_if_absent(spark.read.parquet(source), path, ["k"], None, DAY) == 3_950
    monkeypatch.undo()
    assert find_index(spark, path, ["k"]) is None and storage.exists(spark, f"{path}/_keys/_state")
    assert insert_if_absent(frame(spark, ("k3999", 0, D1)), path, ["k"], ["v"], DAY) == 0
    assert indexed(spark, path) == in_table(spark, path)
