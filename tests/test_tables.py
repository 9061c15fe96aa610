from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from merchmill.sources import storage, tables
from merchmill.sources.tables import (
    Layout, append_table, insert_if_absent, overwrite_table, read_table, replace_folders, rows_between, upsert,
)

D1, D2, D3 = date(2020, 1, 30), date(2020, 1, 31), date(2020, 2, 1)
SCHEMA = "k string, v int, d date"
LAYOUTS = [Layout("d", "day"), Layout("d", "month"), Layout("d", "day", ("v",)), Layout("d", "month", ("v", "d"))]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def content(spark, path, layout):
    return sorted((repr((r.k, r.v, r.d)) for r in read_table(spark, path, layout).collect()))


def same(*rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_upsert_updates_inserts_moves_and_repeats(spark, folder, layout):
    path = f"{folder}/t"
    assert set(upsert(frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2), ("n", 4, None)), path, ["k"], layout))
    source = frame(spark, ("a", 10, D1), ("c", 30, D3), ("e", 50, D3), ("n", 40, D3))
    expected = same(("a", 10, D1), ("b", 2, D1), ("c", 30, D3), ("e", 50, D3), ("n", 40, D3))
    for _ in range(2):
        upsert(source, path, ["k"], layout)
        assert content(spark, path, layout) == expected
    names = {p.name for p in Path(path).iterdir()}
    assert not any("HIVE_DEFAULT" in n for n in names) and "_upsert" not in names
    if layout.grain == "day":
        assert "d=2020-01-31" not in names  # c was alone there and moved


@pytest.mark.parametrize("layout", LAYOUTS[:2])
def test_upsert_moves_rows_to_an_unknown_day(spark, folder, layout):
    path = f"{folder}/t"
    upsert(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, ["k"], layout)
    upsert(frame(spark, ("a", 5, None)), path, ["k"], layout)
    upsert(frame(spark, ("x", 6, None)), path, ["k"], layout)
    assert content(spark, path, layout) == same(("a", 5, None), ("b", 2, D2), ("x", 6, None))


def test_upsert_leaves_other_folders_alone(spark, folder):
    path, layout = f"{folder}/t", Layout("d")
    upsert(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, ["k"], layout)
    before = sorted(p.name for p in Path(f"{path}/d=2020-01-30").iterdir())
    assert upsert(frame(spark, ("b", 3, D2)), path, ["k"], layout) == [D2]
    assert sorted(p.name for p in Path(f"{path}/d=2020-01-30").iterdir()) == before


def test_upsert_refuses_repeated_keys(spark, folder):
    path, layout = f"{folder}/t", Layout("d")
    with pytest.raises(ValueError, match="repeats a key"):
        upsert(frame(spark, ("a", 1, D1), ("a", 2, D2)), path, ["k"], layout)


@pytest.mark.parametrize("fail_at", ["replace_folders", "delete"])
def test_upsert_that_failed_half_way_is_finished_by_the_next(spark, folder, monkeypatch, fail_at):
    path, layout = f"{folder}/t", Layout("d")
    upsert(frame(spark, ("a", 1, D1), ("b", 2, D1), ("c", 3, D2)), path, ["k"], layout)
    real = getattr(tables, fail_at)

    def failing(*args):
        if fail_at == "delete" and args[1].endswith("_upsert"):
            return real(*args)
        raise OSError("executor host lost")

    monkeypatch.setattr(tables, fail_at, failing)
    with pytest.raises(OSError):
        upsert(frame(spark, ("c", 30, D3)), path, ["k"], layout)
    monkeypatch.setattr(tables, fail_at, real)
    # the swap may have stopped with a rewritten folder already gone
    storage.delete(spark, f"{path}/d=2020-02-01")
    upsert(frame(spark, ("z", 9, D1)), path, ["k"], layout)
    assert content(spark, path, layout) == same(("a", 1, D1), ("b", 2, D1), ("c", 30, D3), ("z", 9, D1))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_insert_if_absent_keeps_what_is_there(spark, folder, layout):
    path = f"{folder}/t"
    batch = frame(spark, ("a", 2, D1), ("a", 1, D2), ("b", 5, None))
    assert insert_if_absent(batch, path, ["k"], ["v"], layout) == 2
    assert insert_if_absent(batch, path, ["k"], ["v"], layout) == 0
    assert insert_if_absent(frame(spark, ("b", 7, D3), ("c", 8, D3)), path, ["k"], ["v"], layout) == 1
    assert content(spark, path, layout) == same(("a", 1, D2), ("b", 5, None), ("c", 8, D3))


def test_empty_batches_and_tables(spark, folder):
    path, layout = f"{folder}/t", Layout("d")
    none = frame(spark).where("false")
    assert insert_if_absent(none, path, ["k"], ["v"], layout) == 0
    assert not storage.has_data(spark, path)
    assert insert_if_absent(frame(spark, ("a", 1, D1)), path, ["k"], ["v"], layout) == 1
    assert insert_if_absent(none, path, ["k"], ["v"], layout) == 0
    assert upsert(none, path, ["k"], layout) == []
    assert replace_folders(none, path, layout) == 0
    assert content(spark, path, layout) == same(("a", 1, D1))


def test_rows_without_a_key_are_left_out_and_told(spark, folder):
    path = f"{folder}/t"
    batch = frame(spark, ("a", 1, D1), (None, 2, D1), (None, 3, D2))
    for added in (1, 0, 0):
        with pytest.warns(UserWarning, match="2 rows without a key"):
            assert insert_if_absent(batch, path, ["k"], ["v"], Layout("d")) == added
    assert content(spark, path, Layout("d")) == same(("a", 1, D1))
    with pytest.raises(ValueError, match="NULL in its key"):
        upsert(batch, path, ["k"], Layout("d"))


def test_an_upsert_tells_the_folders_of_the_one_it_finishes(spark, folder, monkeypatch):
    from merchmill.sources import tables

    path, pending, layout = f"{folder}/t", f"{folder}/pending", Layout("d")
    overwrite_table(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, layout)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "replace_folders", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(frame(spark, ("a", 5, D3)), path, ["k"], layout, pending)
    assert set(tables.noted_folders(spark, pending)[0]) == {D1, D3}
    assert set(upsert(frame(spark, ("b", 7, D2)), path, ["k"], layout, pending)) == {D1, D2, D3}
    assert content(spark, path, layout) == same(("a", 5, D3), ("b", 7, D2))


@pytest.mark.parametrize("layout", LAYOUTS[:2])
def test_row_counts_and_folder_replacement(spark, folder, layout):
    path = f"{folder}/t"
    assert overwrite_table(frame(spark, ("a", 1, D1), ("b", 2, D3)), path, layout) == 2
    assert replace_folders(frame(spark, ("c", 3, D3)), path, layout) == 1
    assert content(spark, path, layout) == same(("a", 1, D1), ("c", 3, D3))
    assert append_table(frame(spark, ("d", 4, D3)), path, layout) == 1
    assert overwrite_table(frame(spark, ("e", 5, D2)), path, layout) == 1
    assert content(spark, path, layout) == same(("e", 5, D2))


@pytest.mark.parametrize("grain", ["day", "month"])
def test_date_range_reads_only_its_folders(spark, folder, grain):
    path, layout = f"{folder}/t", Layout("d", grain)
    overwrite_table(frame(spark, ("a", 1, D1), ("b", 2, D2), ("c", 3, D3)), path, layout)
    rows = rows_between(spark, path, layout, D2, D2)
    assert [(r.k, r.v, r.d) for r in rows.collect()] == [("b", 2, D2)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({layout.folder}#" in plan
    assert rows.columns == ["k", "v", "d"]


def test_a_hot_day_is_written_by_many_tasks(spark, folder):
    path, layout = f"{folder}/t", Layout("d")
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(0, 200_000, 1, 16).select(
            F.md5(F.col("id").cast("string")).alias("k"), F.col("id").cast("int").alias("v"),
            F.when(F.col("id") % 3 == 0, F.lit(D2)).otherwise(F.lit(D1)).alias("d"),
        )
        overwrite_table(hot, path, layout)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = [p for p in Path(f"{tables.table_folder(spark, path)}/d=2020-01-30").iterdir() if p.suffix == ".parquet"]
    assert len(files) > 8
    assert read_table(spark, path, layout).count() == 200_000


def test_files_of_a_hot_day_hold_different_ranges(spark, folder):
    """A filter on the clustering column reads a part of a hot day's files; small days share tasks."""
    path, layout = f"{folder}/t", Layout("d", cluster_by=("k",))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a small table would get one file
    try:
        rows = spark.range(0, 60_000, 1, 6).select(
            F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("k"), F.col("id").cast("int").alias("v"),
            F.when(F.col("id") % 10 > 0, F.lit(D1)).otherwise(F.date_add(F.lit(D2), (F.col("id") % 7).cast("int"))).alias("d"))
        overwrite_table(rows, path, layout)
        overwrite_table(rows.where("k = 's1'"), f"{path}-one", layout)
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)
    day = tables.rows_between(spark, path, layout, D1, D1)
    spans = [(r[1], r[2]) for r in day.groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).collect()]
    assert len(spans) >= 8 and sum(a <= "s2" <= b for a, b in spans) <= len(spans) / 2
    assert read_table(spark, path, layout).count() == 60_000
    same_key = tables.rows_between(spark, f"{path}-one", layout, D1, D1)
    assert len(same_key.inputFiles()) >= 8  # rows that are equal in the clustering are split as well


def test_small_batch_never_shuffles_the_target(spark, folder):
    from merchmill.operators import without_keys

    path = f"{folder}/t"
    spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v")).write.parquet(path)
    batch = spark.createDataFrame([("7", 1), ("x", 2)], "k string, v int").limit(2)
    fresh = without_keys(batch, read_table(spark, path), ["k"])
    assert [r.k for r in fresh.collect()] == ["x"]
    plan = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    scan = plan.index("FileScan parquet")
    assert "Exchange hashpartitioning" not in plan[:scan].split("LeftSemi")[-1]


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = storage.scratch_path(spark, "probe")
    if shared:
        assert path.startswith(shared.rstrip("/") + "/merchmill-probe-")
    assert storage.scratch_path(spark, "probe") != path


def test_materialise_keeps_schema_of_no_rows(spark):
    df = frame(spark).where("false")
    stored = storage.materialise(df, "none")
    assert stored.schema.names == ["k", "v", "d"] and stored.count() == 0


# --- whole replacement -----------------------------------------------------------------------

@pytest.mark.parametrize("layout", LAYOUTS[:2])
@pytest.mark.parametrize("first", [append_table, overwrite_table])
def test_an_overwrite_that_fails_keeps_the_old_rows(spark, folder, layout, first):
    path = f"{folder}/t"
    first(frame(spark, ("a", 1, D1), ("b", 2, D3)), path, layout)
    fails = frame(spark, ("c", 3, D1)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        overwrite_table(fails, path, layout)
    assert content(spark, path, layout) == same(("a", 1, D1), ("b", 2, D3))
    assert overwrite_table(frame(spark, ("d", 4, D2)), path, layout) == 1
    assert content(spark, path, layout) == same(("d", 4, D2))


@pytest.mark.parametrize("at", ["write_text", "delete"])
def test_an_overwrite_that_stops_at_the_switch(spark, folder, monkeypatch, at):
    """Before the pointer is written the old rows are read, after it the new ones, whatever is left behind."""
    path, layout = f"{folder}/t", Layout("d")
    overwrite_table(frame(spark, ("a", 1, D1)), path, layout)
    with monkeypatch.context() as broken:
        broken.setattr(tables, at, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            overwrite_table(frame(spark, ("b", 2, D2)), path, layout)
    assert content(spark, path, layout) == same(("a", 1, D1) if at == "write_text" else ("b", 2, D2))
    overwrite_table(frame(spark, ("c", 3, D3)), path, layout)
    assert content(spark, path, layout) == same(("c", 3, D3))
    assert {p.name for p in Path(path).iterdir()} == {"_live", "_data"}
    assert len([p for p in Path(f"{path}/_data").iterdir() if p.is_dir()]) == 1  # older versions are gone
    assert len([p for p in Path(f"{path}/_live").iterdir() if p.name.isdigit()]) == 1


def test_a_table_may_be_rebuilt_from_itself(spark, folder):
    path, layout = f"{folder}/t", Layout("d", "month")
    append_table(frame(spark, ("a", 1, D1), ("b", 2, D3)), path, layout)
    for n in range(3):
        overwrite_table(read_table(spark, path, layout).withColumn("v", F.col("v") + 10), path, layout)
    append_table(frame(spark, ("c", 3, D3)), path, layout)
    replace_folders(frame(spark, ("z", 9, D1)), path, layout)
    assert content(spark, path, layout) == same(("z", 9, D1), ("b", 32, D3), ("c", 3, D3))


def test_what_hangs_on_a_replaced_table_goes_with_it(spark, folder, monkeypatch):
    """An upsert that stopped half way and the key index belong to the rows they were made for."""
    path, layout = f"{folder}/t", Layout("d")
    overwrite_table(frame(spark, ("a", 1, D1), ("b", 2, D2)), path, layout)
    with monkeypatch.context() as broken:
        broken.setattr(tables, "replace_folders", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            upsert(frame(spark, ("a", 5, D3)), path, ["k"], layout)
    overwrite_table(frame(spark, ("x", 7, D1)), path, layout)
    upsert(frame(spark, ("y", 8, D1)), path, ["k"], layout)
    assert content(spark, path, layout) == same(("x", 7, D1), ("y", 8, D1))
    assert insert_if_absent(frame(spark, ("a", 1, D1), ("x", 0, D1)), path, ["k"], ["v"], layout) == 1
