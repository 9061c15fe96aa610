"""A stored index of a table's keys: a narrow table key -> folder, in buckets by a hash of the key.

It lies beside the rows, under ``_keys`` of the table's folder, so it goes when the table is replaced. A few
keys are looked up by reading their buckets only, and the table itself isn't scanned. Entries are only ever
added; of several for one key the latest says where its row is. The index is built when it is first asked for.

Its state names what the table held when the two were last brought together: number and bytes of its files.
A write that fails between table and index, or one that doesn't know the index, leaves them apart, and the
next look-up builds the index anew from the table's key columns.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from merchmill.sources.buckets import bucket_count, read_buckets, write_buckets
from merchmill.sources.storage import child_names, data_summary, delete, read_text, write_text

#: keys of a bucket on average when an index is built, and the writes after which it is built anew, so that its
#: small files don't pile up and its buckets follow the table's size
KEYS_PER_BUCKET, REBUILD_AFTER = 1 << 18, 64

FOLDER, WRITE = "key_folder", "key_write"


@dataclass
class KeyIndex:
    spark: SparkSession
    folder: str
    keys: list[str]
    schema: T.StructType
    state: dict

    @property
    def path(self) -> str:
        return f"{self.folder}/_keys/{self.state['name']}"

    def entries(self, batch: DataFrame) -> DataFrame:
        """Entries of the batch's keys. ``batch`` should be cheap to read; only its buckets of the index are."""
        return read_buckets(self.spark, self.path, self.schema, self.keys, self.state["buckets"], batch)

    def folders(self, batch: DataFrame) -> DataFrame:
        """Where the rows of the batch's keys lie now: the keys and their folder, as ``key_folder``."""
        return latest(self.entries(batch), self.keys)

    def add(self, entries: DataFrame) -> None:
        """Add the keys of rows and their folder, a column ``key_folder``. Adding them again changes nothing."""
        number = F.lit(self.state["writes"] + 1).cast("long").alias(WRITE)
        write_buckets(entries.select(*self.keys, FOLDER, number), self.path, self.keys, self.state["buckets"])

    def commit(self) -> None:
        """Say that table and index agree as they are now."""
        self.state = {**self.state, "writes": self.state["writes"] + 1, "table": data_summary(self.spark, self.folder), "upsert": None}
        self._save()

    def begin(self, upsert: str) -> None:
        """Note that the table is about to be changed by an upsert that will add its keys here when it is done."""
        self.state = {**self.state, "upsert": upsert}
        self._save()

    def _save(self) -> None:
        write_text(self.spark, f"{self.folder}/_keys/_state", json.dumps(self.state))


def latest(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    return entries.groupBy(*keys).agg(F.max_by(FOLDER, WRITE).alias(FOLDER))


def _stored_state(spark: SparkSession, folder: str) -> dict | None:
    text = read_text(spark, f"{folder}/_keys/_state")
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None  # cut off while it was written


def find_index(spark: SparkSession, folder: str, keys: Sequence[str], upsert: str | None = None) -> KeyIndex | None:
    """The index of a table folder if there is one that fits; no data is read.

    ``upsert`` names an upsert that is being finished: the table may then be half changed, and the index
    fits if that upsert was noted there.
    """
    state = _stored_state(spark, folder)
    if not state or state["keys"] != list(keys) or state["writes"] >= REBUILD_AFTER:
        return None
    if state["upsert"] != upsert if upsert else state["table"] != data_summary(spark, folder):
        return None
    return KeyIndex(spark, folder, list(keys), T.StructType.fromJson(state["schema"]), state)


def open_index(
    spark: SparkSession, folder: str, keys: Sequence[str], folder_column: str | None, table: Callable[[], DataFrame]
) -> KeyIndex:
    """The index of the table in ``folder``, built from ``table()`` (with its folder column) where none fits."""
    return find_index(spark, folder, keys) or _build(spark, folder, list(keys), folder_column, table())


def _build(spark: SparkSession, folder: str, keys: list[str], folder_column: str | None, table: DataFrame) -> KeyIndex:
    day = table.schema[folder_column].dataType if folder_column else T.DateType()
    schema = T.StructType([*(T.StructField(k, table.schema[k].dataType) for k in keys), T.StructField(FOLDER, day),
                           T.StructField(WRITE, T.LongType())])
    index = KeyIndex(spark, folder, keys, schema, {
        "name": uuid.uuid4().hex, "keys": keys, "schema": schema.jsonValue(), "buckets": bucket_count(table.count(), KEYS_PER_BUCKET),
        "writes": 0, "table": data_summary(spark, folder), "upsert": None})
    place = F.col(folder_column) if folder_column else F.lit(None).cast("date")
    old = [n for n in child_names(spark, f"{folder}/_keys") if n != "_state"]
    entries = table.select(*keys, place.alias(FOLDER), F.lit(0).cast("long").alias(WRITE))
    write_buckets(entries, index.path, keys, index.state["buckets"])
    index._save()
    for name in old:
        delete(spark, f"{folder}/_keys/{name}")
    return index
