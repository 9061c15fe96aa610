"""The stored key index of tables: what it reads, and that it never disagrees with its table."""

import json
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_tables import D1, D2, D3, content, frame, same

from merchmill.sources import keyindex, storage, tables
from merchmill.sources.keyindex import find_index
from merchmill.sources.tables import Layout, append_table, insert_if_absent, overwrite_table, read_table, replace_folders, upsert

DAY = Layout("d")


def state(spark, path):
    return json.loads(storage.read_text(spark, f"{tables.table_folder(spark, path)}/_keys/_state"))


def indexed(spark, path, keys=("k",)):
    """Key -> folder by the index, None where it doesn't fit the table."""
    index = find_index(spark, tables.table_folder(spark, path), list(keys))
    if index is None:
        return None
    whole = index.entries(read_table(spark, path, DAY).select(*keys))
    return {r[0]: r[1] for r in keyindex.latest(whole, list(keys)).collect()}


def in_table(spark, path):
    return {r.k: r.d for r in read_table(spark, path, DAY).collect()}


def big(spark, rows=4000):
    return spark.range(rows).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"),
                                    F.date_add(F.lit(D1), (F.col("id") % 5).cast("int")).alias("d"))


def scans(df):
    """The file scans of a plan that ran, as text."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    return [line for line in lines if "FileScan parquet" in line]


def test_a_small_batch_reads_only_its_buckets(spark, folder):
    path = f"{folder}/t"
    append_table(big(spark), path, DAY)
    assert insert_if_absent(frame(spark, ("k7", 0, D1), ("new", 1, D2)), path, ["k"], ["v"], DAY) == 1
    index = find_index(spark, path, ["k"])
    batch = frame(spark, ("k7", 0, D1))
    entries = index.entries(batch)
    assert [(r.k, r.key_folder) for r in entries.collect()] == [("k7", D1 + timedelta(days=2))]
    read = index.spark.read.parquet(index.path)
    one = batch.select(F.pmod(F.xxhash64("k"), F.lit(index.state["buckets"]))).first()[0]
    mine = read.where(F.col("key_bucket") == one)
    plan = [s for s in scans(entries) if "_keys" in s or "key_folder" in s]
    filters = plan[0].split("PartitionFilters: [")[1].split("]")[0]
    assert len(plan) == 1 and "key_bucket#" in filters and f"= {one})" in filters
    assert mine.count() < read.count() / 4


def test_the_table_is_not_scanned_for_a_later_batch(spark, folder, monkeypatch):
    path = f"{folder}/t"
    append_table(big(spark), path, DAY)
    insert_if_absent(frame(spark, ("first", 0, D1)), path, ["k"], ["v"], DAY)  # builds the index
    upsert(frame(spark, ("k1", 9, D1)), path, ["k"], DAY)
    monkeypatch.setattr(tables, "read_table", lambda *a, **k: 1 / 0)  # from here on any reading of the whole table fails
    assert insert_if_absent(frame(spark, ("k3", 0, D1), ("second", 1, D2)), path, ["k"], ["v"], DAY) == 1
    touched = upsert(frame(spark, ("k2", 5, D1), ("third", 6, D1)), path, ["k"], DAY)
    assert set(touched) == {D1, D1 + timedelta(days=2)}
    monkeypatch.undo()
    assert indexed(spark, path) == in_table(spark, path)
    assert {r.k: r.v for r in read_table(spark, path, DAY).where("k in ('k1', 'k2', 'k3', 'third')").collect()} == {"k1": 9, "k2": 5, "k3": 3, "third": 6}


def test_an_upsert_reads_only_the_folders_it_touches(spark, folder):
    path = f"{folder}/t"
    append_table(big(spark), path, DAY)
    upsert(frame(spark, ("x", 1, D1)), path, ["k"], DAY)
    rows = tables._read_folders(spark, path, DAY, [D1, date(1999, 1, 1)], ["k", "v", "d"])
    assert {f.split("/")[-2] for f in rows.inputFiles()} == {"d=2020-01-30"}
    assert tables._read_folders(spark, path, DAY, [date(1999, 1, 1)], ["k"]) is None


@pytest.mark.parametrize("stop", ["add", "commit"])
def test_a_failure_between_table_and_index_of_an_insert(spark, folder, monkeypatch, stop):
    path = f"{folder}/t"
    append_table(frame(spark, ("a", 1, D1)), path, DAY)
    insert_if_absent(frame(spark, ("b", 2, D2)), path, ["k"], ["v"], DAY)
    with monkeypatch.context() as broken:
        broken.setattr(keyindex.KeyIndex, stop, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            insert_if_absent(frame(spark, ("c", 3, D2)), path, ["k"], ["v"], DAY)
    assert indexed(spark, path) is None  # it doesn't fit any more, so the next one builds it anew
    assert insert_if_absent(frame(spark, ("c", 4, D3), ("d", 5, D3)), path, ["k"], ["v"], DAY) == 1
    assert content(spark, path, DAY) == same(("a", 1, D1), ("b", 2, D2), ("c", 3, D2), ("d", 5, D3))
    assert indexed(spark, path) == in_table(spark, path)


STEPS = ["begin", "note", "replace_folders", "half", "delete", "add", "commit", "cleanup"]


@pytest.mark.parametrize("stop", STEPS)
def test_an_upsert_that_stops_at_any_step_is_finished_in_table_and_index(spark, folder, monkeypatch, stop):
    path = f"{folder}/t"
    append_table(frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2)), path, DAY)
    insert_if_absent(frame(spark, ("i", 0, D1)), path, ["k"], ["v"], DAY)
    storage_delete, swap = tables.delete, tables.replace_folders

    def half(*args):
        swap(*args)
        storage_delete(spark, f"{path}/d=2020-01-30")  # the swap had taken away a folder that it was to rewrite
        raise ZeroDivisionError

    def cleanup(spark_, target):
        return 1 / 0 if target.endswith("_upsert") and storage.exists(spark_, f"{target}/name") else storage_delete(spark_, target)

    with monkeypatch.context() as broken:
        if stop in ("add", "commit", "begin"):
            broken.setattr(keyindex.KeyIndex, stop, lambda *a: 1 / 0)
        elif stop == "note":
            broken.setattr(tables, "note_folders", lambda *a: 1 / 0)
        elif stop == "delete":
            broken.setattr(tables, "folder_path", lambda *a: 1 / 0)
        elif stop in ("half", "cleanup"):
            broken.setattr(tables, {"half": "replace_folders", "cleanup": "delete"}[stop], {"half": half, "cleanup": cleanup}[stop])
        else:
            broken.setattr(tables, stop, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(frame(spark, ("a", 10, D1), ("c", 30, D3), ("n", 40, D1)), path, ["k"], DAY, f"{folder}/pending")
    upsert(frame(spark, ("z", 9, D3)), path, ["k"], DAY, f"{folder}/pending")
    done = [("a", 10, D1), ("c", 30, D3), ("n", 40, D1)] if stop != "begin" else [("a", 1, D1), ("c", 3, D2)]
    assert content(spark, path, DAY) == same(*done, ("b", 2, D1), ("i", 0, D1), ("z", 9, D3))
    assert indexed(spark, path) in (None, in_table(spark, path))
    # whether it was carried over or is built anew now: a known key is known, and lies where it was moved to
    assert insert_if_absent(frame(spark, ("c", 0, D1), ("b", 0, D1), ("y", 1, D1)), path, ["k"], ["v"], DAY) == 1
    assert indexed(spark, path) == in_table(spark, path)


def test_an_index_is_not_trusted_after_other_writes(spark, folder):
    path = f"{folder}/t"
    append_table(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, DAY)
    insert_if_absent(frame(spark, ("c", 3, D2)), path, ["k"], ["v"], DAY)
    assert indexed(spark, path) == in_table(spark, path)
    replace_folders(frame(spark, ("e", 1, D1)), path, DAY)  # as many files, and as many bytes
    assert indexed(spark, path) is None
    assert insert_if_absent(frame(spark, ("a", 9, D3), ("e", 9, D3)), path, ["k"], ["v"], DAY) == 1
    append_table(frame(spark, ("f", 4, D1)), path, DAY)
    assert insert_if_absent(frame(spark, ("f", 9, D3)), path, ["k"], ["v"], DAY) == 0
    storage.delete(spark, f"{path}/d=2020-01-31")  # by hand
    assert insert_if_absent(frame(spark, ("b", 7, D3)), path, ["k"], ["v"], DAY) == 1
    assert indexed(spark, path) == in_table(spark, path)


def test_other_keys_and_cut_off_states_get_a_new_index(spark, folder):
    path = f"{folder}/t"
    append_table(frame(spark, ("a", 1, D1)), path, DAY)
    insert_if_absent(frame(spark, ("b", 2, D2)), path, ["k"], ["v"], DAY)
    assert insert_if_absent(frame(spark, ("b", 3, D2)), path, ["k", "v"], ["d"], DAY) == 1
    assert state(spark, path)["keys"] == ["k", "v"]
    storage.write_text(spark, f"{path}/_keys/_state", '{"name": "cu')
    assert insert_if_absent(frame(spark, ("b", 3, D2), ("b", 4, D2)), path, ["k", "v"], ["d"], DAY) == 1
    assert len([p for p in Path(f"{path}/_keys").iterdir() if p.is_dir()]) == 1  # the older ones are gone


def test_many_writes_build_the_index_anew(spark, folder, monkeypatch):
    monkeypatch.setattr(keyindex, "REBUILD_AFTER", 3)
    path = f"{folder}/t"
    names = []
    for n in range(6):
        assert insert_if_absent(frame(spark, ("same", 0, D1), (f"k{n}", n, D2)), path, ["k"], ["v"], DAY) == (2 if n == 0 else 1)
        if n:
            names.append(state(spark, path)["name"])
    assert len(set(names)) == 2 and read_table(spark, path, DAY).count() == 7


def test_keys_named_like_the_columns_of_the_index_are_kept_apart(spark, folder):
    path = f"{folder}/t"
    rows = frame(spark, ("a", 1, D1), ("b", 2, D2)).withColumnRenamed("k", "bucket").withColumnRenamed("v", "folder")
    append_table(rows, path, DAY)
    again = rows.union(frame(spark, ("c", 1, D1)))
    assert insert_if_absent(again, path, ["bucket", "folder"], ["d"], DAY) == 1
    overwrite_table(again, path, DAY)
    assert insert_if_absent(again, path, ["bucket", "folder"], ["d"], DAY) == 0
