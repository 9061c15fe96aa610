"""Parquet tables: partitioned writes, whole replacement, insert-if-absent and upsert.

Every write can be repeated with the same input and leaves the same table. Parquet has no conflict
detection, so a table has one writer at a time.

A table's rows lie in its folder until it is replaced as a whole. The new rows are then written to a version
folder, ``_data/1``, ``_data/2`` and so on, and a pointer file of that number in ``_live`` makes it the one that
readers see. A replacement that fails before that leaves the old table as it was. Read tables by ``read_table``,
which follows the pointer; what hangs on the rows (an unfinished upsert, the key index) lies beside them.
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from merchmill.operators.keys import first_per_key
from merchmill.sources.keyindex import FOLDER, KeyIndex, find_index, open_index
from merchmill.sources.storage import COMPRESSION, child_names, data_summary, delete, exists, file_bytes, has_data, materialise, read_text, write_text


@dataclass(frozen=True)
class Layout:
    """How a table is split into folders by its date column, and sorted inside them.

    ``grain="day"`` makes the date column itself the folder; ``grain="month"`` adds a folder column
    holding the first day of the month, which suits many years of small days.
    """

    date_column: str | None = None
    grain: str = "day"
    cluster_by: tuple[str, ...] = ()

    @property
    def folder(self) -> str | None:
        if self.date_column is None or self.grain == "day":
            return self.date_column
        return f"{self.date_column}_month"

    def folder_of(self, day: Column) -> Column:
        return day if self.grain == "day" else F.trunc(day, "month")

    def folder_value(self, day: date | None) -> date | None:
        return day if day is None or self.grain == "day" else day.replace(day=1)

    def arrange(self, df: DataFrame) -> DataFrame:
        """Bring each folder's rows together for the write, and put them in order for min/max skipping.

        Without clustering the rebalance is adaptive: a day that holds much of the table is split over many
        tasks and files, and small days share a task. With clustering the split is by sampled ranges of folder
        and cluster columns, so that the files of such a day hold different ranges and a filter skips most of
        them; rows that are equal there are told apart by a hash, so they are split too.
        """
        if self.folder is None:
            return df.sortWithinPartitions(*self.cluster_by) if self.cluster_by else df
        if self.folder != self.date_column:
            df = df.withColumn(self.folder, self.folder_of(F.col(self.date_column)))
        if not self.cluster_by:
            return df.hint("rebalance", F.col(self.folder))
        order = [self.folder, *(c for c in self.cluster_by if c != self.folder)]
        return df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)

    def in_folders(self, df: DataFrame, folders: Sequence[date | None]) -> DataFrame:
        """Rows of the listed folders; a plain partition filter, so other folders are not read."""
        known = [f for f in folders if f is not None]
        wanted = F.col(self.folder).isin(*known) if known else F.lit(False)
        return df.where(wanted | F.col(self.folder).isNull()) if None in folders else df.where(wanted)


PLAIN = Layout()
#: bytes of the files behind a batch from which an insert may pass the key index by
LARGE_BATCH = 32 << 20


def _pointers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in child_names(spark, f"{path}/_live") if n.isdigit())


def table_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's rows now."""
    numbers = _pointers(spark, path)
    return f"{path}/_data/{numbers[-1]}" if numbers else path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table holds committed data."""
    return has_data(spark, table_folder(spark, path))


def _make_live(spark: SparkSession, path: str, number: int) -> None:
    """Switch readers to a version folder, then remove what was live before and what failed writes left."""
    write_text(spark, f"{path}/_live/{number}", "", replace=False)
    for name in child_names(spark, f"{path}/_data"):
        if name != str(number):
            delete(spark, f"{path}/_data/{name}")
    for name in child_names(spark, path):
        if name not in ("_live", "_data"):
            delete(spark, f"{path}/{name}")
    for old in _pointers(spark, path)[:-1]:
        delete(spark, f"{path}/_live/{old}")


def read_table(spark: SparkSession, path: str, layout: Layout = PLAIN, keep_folder: bool = False) -> DataFrame:
    return _typed(spark.read.parquet(table_folder(spark, path)), layout, keep_folder)


def _typed(df: DataFrame, layout: Layout, keep_folder: bool) -> DataFrame:
    if layout.folder is not None:
        df = df.withColumn(layout.folder, F.col(layout.folder).cast("date"))
        if layout.folder != layout.date_column and not keep_folder:
            df = df.drop(layout.folder)
    return df


def rows_between(spark: SparkSession, path: str, layout: Layout, first: date | None, last: date | None) -> DataFrame:
    """Rows with a date in the range; the folder column is filtered too, so only those folders are read."""
    df = read_table(spark, path, layout, keep_folder=True)
    for bound, compare in ((first, "__ge__"), (last, "__le__")):
        if bound is not None:
            df = df.where(getattr(F.col(layout.date_column), compare)(F.lit(bound)))
            df = df.where(getattr(F.col(layout.folder), compare)(F.lit(layout.folder_value(bound))))
    return df if layout.folder == layout.date_column else df.drop(layout.folder)


def _write(df: DataFrame, path: str, layout: Layout, mode: str, overwrite: str = "static") -> int:
    """Write and return the row count, which the same job observes in its last stage."""
    seen = Observation()
    writer = layout.arrange(df).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).option("compression", COMPRESSION)
    if layout.folder is not None:
        writer = writer.partitionBy(layout.folder).option("partitionOverwriteMode", overwrite)
    writer.parquet(path)
    return seen.get["rows"]


def overwrite_table(df: DataFrame, path: str, layout: Layout = PLAIN) -> int:
    """Replace the whole table; ``df`` may read from it. Readers see the old rows until all new ones are written.

    Frames planned on the old rows can't be read after the switch, as these are removed.
    """
    spark = df.sparkSession
    number = (_pointers(spark, path) or [0])[-1] + 1
    written = _write(df, f"{path}/_data/{number}", layout, "overwrite")
    _make_live(spark, path, number)
    return written


def write_folder(df: DataFrame, path: str, layout: Layout = PLAIN) -> int:
    """Write a plain folder of Parquet files, in place of what was there, for readers that know no tables."""
    return _write(df, path, layout, "overwrite")


def append_table(df: DataFrame, path: str, layout: Layout = PLAIN) -> int:
    return _write(df, table_folder(df.sparkSession, path), layout, "append")


def replace_folders(df: DataFrame, path: str, layout: Layout) -> int:
    """Replace the folders that occur in ``df``; others stay. ``df`` must not read from the table."""
    return _write(df, table_folder(df.sparkSession, path), layout, "overwrite", overwrite="dynamic")


def _observed(seen: Observation, name: str) -> int:
    """An observed count; 0 where Spark knew beforehand that there are no rows, and so observed none."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        return 0


def insert_if_absent(
    batch: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str | Column] | None, layout: Layout = PLAIN
) -> int:
    """Append the rows whose key the table lacks; of equal keys in the batch the first in order counts.

    ``order_by=None`` says that the batch is known to hold each key once. A row with a NULL in its key has
    none to be known by again: such rows are left out, and a warning says how many there were. The batch is
    evaluated once. A batch from more bytes than the table has meets the table's keys in one join; looking most of
    them up in the key index, and adding them to it, would shuffle both several times. The index then no longer
    fits and is built anew when a small batch needs it.
    """
    spark, keys = batch.sparkSession, list(keys)
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    seen = Observation()
    counted = batch.observe(seen, F.count_if(keyless).alias("keyless")).where(~keyless)
    fresh = counted if order_by is None else first_per_key(counted, keys, order_by)
    if not table_exists(spark, path):
        written = append_table(fresh, path, layout)
    elif _outweighs(batch, path):
        written = append_table(fresh.join(read_table(spark, path, layout).select(*keys), keys, "left_anti"), path, layout)
    else:
        index = _index(spark, path, keys, layout)
        fresh = materialise(fresh, "insert-batch")
        fresh = fresh.join(index.entries(fresh).select(*keys), keys, "left_anti")
        written = append_table(fresh, path, layout)
        index.add(_with_folder(fresh, layout))
        index.commit()
    left_out = _observed(seen, "keyless")
    if left_out:
        warnings.warn(f"{left_out} rows without a key were left out of {path}", stacklevel=2)
    return written


def _outweighs(batch: DataFrame, path: str) -> bool:
    """Whether the files behind a batch are large, and larger than the table's. Only file sizes are looked at."""
    spark = batch.sparkSession
    size = file_bytes(spark, batch)
    return size >= LARGE_BATCH and size >= data_summary(spark, table_folder(spark, path))[1]


def _index(spark: SparkSession, path: str, keys: Sequence[str], layout: Layout) -> KeyIndex:
    """The key index of a table that exists."""
    return open_index(spark, table_folder(spark, path), keys, layout.folder, lambda: read_table(spark, path, layout, keep_folder=True))


def _with_folder(df: DataFrame, layout: Layout) -> DataFrame:
    day = F.lit(None).cast("date") if layout.folder is None else layout.folder_of(F.col(layout.date_column))
    return df.withColumn(FOLDER, day)


def _folder_name(layout: Layout, folder: date | None) -> str:
    value = "__HIVE_DEFAULT_PARTITION__" if folder is None else f"{folder:%Y-%m-%d}"
    return f"{layout.folder}={value}"


def folder_path(spark: SparkSession, path: str, layout: Layout, folder: date | None) -> str:
    return f"{table_folder(spark, path)}/{_folder_name(layout, folder)}"


def _read_folders(
    spark: SparkSession, path: str, layout: Layout, folders: Sequence[date | None], columns: Sequence[str]
) -> DataFrame | None:
    """Rows of the listed folders, of which the others aren't even listed; None where there are none of them."""
    live = table_folder(spark, path)
    there = set(child_names(spark, live))
    paths = [f"{live}/{n}" for n in (_folder_name(layout, f) for f in folders) if n in there]
    if not paths:
        return None
    return _typed(spark.read.option("basePath", live).parquet(*paths), layout, keep_folder=True).select(*columns)


def _folders(df: DataFrame, layout: Layout) -> list[date | None]:
    """Distinct folders of ``df``. One value per calendar day at most, so the list stays small."""
    day = layout.folder_of(F.col(layout.date_column))
    return [row[0] for row in df.select(day.alias("folder")).distinct().collect()]


def note_folders(spark: SparkSession, pending: str, folders: Sequence[date | None], whole: bool = False) -> None:
    """Add folders to the list of those whose followers are still to be refreshed; ``whole`` stands for all."""
    noted = [(f, False) for f in folders] + ([(None, True)] if whole else [])
    spark.createDataFrame(noted, "folder date, whole boolean").coalesce(1).write.mode("append").parquet(pending)


def noted_folders(spark: SparkSession, pending: str) -> tuple[list[date | None], bool]:
    """(folders noted, whether all are)."""
    if not has_data(spark, pending):
        return [], False
    rows = spark.read.schema("folder date, whole boolean").parquet(pending).distinct().collect()
    return [r["folder"] for r in rows if not r["whole"]], any(r["whole"] for r in rows)


def _redo(
    spark: SparkSession, path: str, keys: Sequence[str], layout: Layout, pending: str | None = None
) -> list[date | None]:
    """Carry a prepared upsert into table and key index: swap the rewritten folders, drop the emptied ones.

    All inputs are in the table's ``_upsert`` folder, so this gives the same result when it is run again after
    a failure at any point. The folders are noted in ``pending`` before the first of them changes. The index
    is told before that, and gets the keys after it; adding them a second time changes nothing.
    """
    prepared = f"{table_folder(spark, path)}/_upsert"
    rows = spark.read.parquet(f"{prepared}/rows")
    touched = [f and date.fromisoformat(f) for f in json.loads(read_text(spark, f"{prepared}/touched"))]
    if pending is not None:
        note_folders(spark, pending, touched)
    # an index that doesn't know of this upsert is left as it is: it no longer fits the table then, and is built anew
    index = find_index(spark, table_folder(spark, path), keys, upsert=read_text(spark, f"{prepared}/name"))
    replace_folders(rows, path, layout)
    kept = set(_folders(rows, layout))
    for folder in touched:
        # a folder whose last row moved away is not part of the overwrite, so it is removed here
        if folder not in kept:
            delete(spark, folder_path(spark, path, layout, folder))
    if index is not None:
        index.add(spark.read.parquet(f"{prepared}/keys"))
        index.commit()
    delete(spark, prepared)
    return touched


def upsert(
    source: DataFrame, path: str, keys: Sequence[str], layout: Layout, pending: str | None = None
) -> list[date | None]:
    """Update the rows whose key the table has, insert the others. Returns the folders written, together
    with those of an earlier upsert that this one had to finish; ``pending`` keeps a list of them.

    Only folders that the source touches are read and rewritten: those of its own dates, and those in which
    its keys sit now, as a row may move to another date. The stored key index tells the latter, so the table
    isn't scanned for them. The rewritten rows are first stored whole under ``_upsert`` beside the table's
    rows; a run that fails later is finished by the next one, in the table and in the index.

    Fails, like a database merge, when the source repeats a key, and when a key has a NULL in it.
    """
    spark, keys = source.sparkSession, list(keys)
    keyless = " OR ".join(f"`{k}` IS NULL" for k in keys)
    found = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(f"_rows > 1 OR {keyless}").head(1)
    if found:
        problem = "has a NULL in" if any(found[0][k] is None for k in keys) else "repeats"
        raise ValueError(f"source of the upsert {problem} {'its' if 'NULL' in problem else 'a'} key {keys}")
    prepared = f"{table_folder(spark, path)}/_upsert"
    recovered = _redo(spark, path, keys, layout, pending) if exists(spark, f"{prepared}/name") else []
    if not table_exists(spark, path):
        if pending is not None:
            note_folders(spark, pending, [], whole=True)
        append_table(source, path, layout)
        return list({*recovered, *_folders(source, layout)})
    index = _index(spark, path, keys, layout)
    sits = index.folders(source).select(FOLDER).distinct().collect()  # one row per folder
    touched = set(_folders(source, layout)) | {r[0] for r in sits}
    delete(spark, prepared)
    there = _read_folders(spark, path, layout, list(touched), source.columns)
    rows = source if there is None else there.join(source.select(*keys), keys, "left_anti").select(*source.columns).unionByName(source)
    write_text(spark, f"{prepared}/touched", json.dumps([f and f.isoformat() for f in touched]))
    _with_folder(source, layout).select(*keys, FOLDER).write.parquet(f"{prepared}/keys")
    rows.write.option("compression", COMPRESSION).parquet(f"{prepared}/rows")
    name = uuid.uuid4().hex
    index.begin(name)
    # from here on the upsert will be carried out, by this run or by the next one
    write_text(spark, f"{prepared}/name", name)
    return list({*recovered, *_redo(spark, path, keys, layout, pending)})
