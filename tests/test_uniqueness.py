"""Repeated values counted from what changed, against a full pass over the table."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from test_tables import D1, D2, D3, frame

from merchmill.plans import uniqueness
from merchmill.plans.uniqueness import Repeated, repeated_values
from merchmill.sources import storage
from merchmill.sources.tables import Layout, append_table, folder_path, overwrite_table, read_table, replace_folders

def kept():
    return F.col("v") > 0


def full(spark, path, layout):
    df = read_table(spark, path, layout).where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.count_if(kept()).alias("m"))
    return Repeated(df.where("n > 1").count(), df.where("m > 1").count())


@pytest.mark.parametrize("grain", ["day", "month"])
def test_planted_repeats_across_days(spark, folder, monkeypatch, grain):
    path, store, layout = f"{folder}/t", f"{folder}/store", Layout("d", grain)
    far = date(2021, 5, 5)

    def agree():
        found = repeated_values(spark, path, layout, "k", store, kept())
        assert found == full(spark, path, layout)
        return found

    append_table(frame(spark, ("a", 1, D1), ("b", 1, D1), ("c", 0, D2), ("x", 1, far), (None, 1, D1), (None, 1, far)), path, layout)
    assert agree() == Repeated(0, 0)
    append_table(frame(spark, ("a", 1, far), ("c", 1, far), ("y", 1, None)), path, layout)  # repeats of other days, one not kept
    assert agree() == Repeated(2, 1)
    append_table(frame(spark, ("y", 1, far), ("z", 1, D3), ("z", 1, D3)), path, layout)
    assert agree() == Repeated(4, 3)
    replace_folders(frame(spark, ("n", 1, far)), path, layout)  # the repeats of that day go with it
    assert agree() == Repeated(1, 1)
    replace_folders(frame(spark, ("a", 5, far), ("a", 0, far), ("b", 0, far)), path, layout)
    assert agree() == Repeated(3, 2)
    storage.delete(spark, folder_path(spark, path, layout, layout.folder_value(far)))
    assert agree() == Repeated(1, 1)
    overwrite_table(frame(spark, ("q", 1, D1), ("q", 1, D3), ("a", 1, D1)), path, layout)  # another version of the table
    assert agree() == Repeated(1, 1)
    monkeypatch.setattr(uniqueness, "REBUILD_AFTER", 1)
    append_table(frame(spark, ("a", 1, far)), path, layout)
    assert agree() == Repeated(2, 2)


def test_only_changed_folders_are_read(spark, folder, monkeypatch):
    path, store, layout = f"{folder}/t", f"{folder}/store", Layout("d")
    days = [D1 + timedelta(days=n) for n in range(6)]
    append_table(frame(spark, *[(f"k{n}", n, d) for n, d in enumerate(days)], ("k0", 1, days[5])), path, layout)
    assert repeated_values(spark, path, layout, "k", store).values == 1
    counted, read = uniqueness._counts, []
    monkeypatch.setattr(uniqueness, "_counts", lambda s, live, names, *a: read.append(sorted(names)) or counted(s, live, names, *a))
    assert repeated_values(spark, path, layout, "k", store).values == 1 and read == []  # nothing changed: no job at all
    append_table(frame(spark, ("k1", 9, days[2]), ("new", 9, days[2])), path, layout)
    assert repeated_values(spark, path, layout, "k", store).values == 2 and read == [["d=2020-02-01"]]
    rows = read_table(spark, path, layout).where(F.col("d") == F.lit(days[2]))
    replace_folders(storage.materialise(rows, "same"), path, layout)  # other files, the same values
    totals = uniqueness._new_totals
    monkeypatch.setattr(uniqueness, "_new_totals", lambda *a: 1 / 0)
    assert repeated_values(spark, path, layout, "k", store).values == 2
    monkeypatch.setattr(uniqueness, "_new_totals", totals)
    replace_folders(frame(spark, ("k5", 9, days[2])), path, layout)
    assert repeated_values(spark, path, layout, "k", store) == Repeated(2, 2)


def test_a_check_that_failed_leaves_nothing_that_counts(spark, folder, monkeypatch):
    path, store, layout = f"{folder}/t", f"{folder}/store", Layout("d")
    append_table(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, layout)
    repeated_values(spark, path, layout, "k", store)
    append_table(frame(spark, ("a", 1, D2)), path, layout)
    with monkeypatch.context() as broken:
        broken.setattr(uniqueness, "write_text", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            repeated_values(spark, path, layout, "k", store)
    replace_folders(frame(spark, ("b", 1, D2)), path, layout)
    append_table(frame(spark, ("c", 1, D3)), path, layout)
    assert repeated_values(spark, path, layout, "k", store) == Repeated(0, 0)
    append_table(frame(spark, ("b", 1, D3)), path, layout)
    assert repeated_values(spark, path, layout, "k", store) == Repeated(1, 1)
