"""The landing zone between staging and warehouse: one folder per table and run date."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from merchmill.config import ShopConfig
from merchmill.schemas import LOAD_SCHEMAS, REQUIRED_COLUMNS
from merchmill.sources.ledger import Ledger, digest_of, rows_of_digest
from merchmill.sources.storage import data_summary, delete, exists, materialise
from merchmill.sources.tables import (
    PLAIN, Layout, append_table, folder_path, overwrite_table, read_table, replace_folders, table_exists, table_folder,
    write_folder,
)

LANDED_COLUMNS = {name: schema.names for name, schema in LOAD_SCHEMAS.items()}


def valid_rows(staged: DataFrame, table: str, order_day: date | None = None) -> DataFrame:
    """What goes to the landing zone: valid rows, and for orders those of one day (all when None)."""
    rows = staged.where("is_valid")
    if table == "orders" and order_day is not None:
        rows = rows.where(F.col("order_date") == F.lit(order_day))
    return rows.select(*LANDED_COLUMNS[table])


def export_table(rows: DataFrame, config: ShopConfig, table: str, run_date: date) -> str | None:
    """Write the landing folder of one table and day. No rows, no folder: returns None.

    The write itself counts the rows. A folder that an earlier run left for the day goes as well.
    """
    path = config.landing_path(table, run_date)
    if write_folder(rows, path):
        return path
    delete(rows.sparkSession, path)
    return None


def declared(rows: DataFrame, table: str) -> DataFrame:
    """Rows under the warehouse's declared types; the load fails on a NULL in a required column."""
    columns = []
    for field in LOAD_SCHEMAS[table]:
        value = F.col(field.name).cast(field.dataType)
        if field.name in REQUIRED_COLUMNS[table]:
            problem = F.raise_error(F.lit(f"required column {table}.{field.name} is NULL"))
            value = F.when(value.isNull(), problem.cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def warehouse_layout(config: ShopConfig, table: str) -> Layout:
    return Layout("order_date", config.partition_by) if table == "orders" else PLAIN


def load_ledger(spark: SparkSession, config: ShopConfig) -> Ledger:
    """The order batches that the warehouse has taken."""
    return Ledger(spark, config.path("raw", "orders_loads"))


def load_table(spark: SparkSession, config: ShopConfig, table: str, run_date: date) -> int | None:
    """Load one landing folder into the warehouse; returns the rows loaded, None if there is no folder.

    Customers and products replace the table. Orders replace the partitions they cover, so loading a
    day again does not repeat its rows; where that was the last load and nothing has touched the table since, by
    its files' number, bytes and times, nothing is written. ``load_mode="append"`` adds them instead, and adds a batch once: its
    rows are known by a digest in the ledger of loads, and what a load that failed has added is removed first.
    """
    source = config.landing_path(table, run_date)
    if not exists(spark, source):
        return None
    rows = declared(spark.read.parquet(source), table)
    target, layout = config.path("raw", table), warehouse_layout(config, table)
    if table != "orders":
        return overwrite_table(rows, target, layout)
    ledger, batch = load_ledger(spark, config), f"{run_date:%Y-%m-%d}"
    ledger.undo_open()
    digest, days = digest_of(rows)
    if config.load_mode == "append":
        if any((e.batch, e.digest) == (batch, digest) for e in ledger.entries()):
            return 0
        folders = {layout.folder_value(d) for d in days}
        number = ledger.begin([folder_path(spark, target, layout, f) for f in folders])
        written = append_table(rows, target, layout)
        ledger.finish(number, batch, digest, days)
    else:
        last, live = ledger.entries()[-1:], table_folder(spark, target)
        if last and (last[0].batch, last[0].digest) == (batch, digest) and last[0].table == data_summary(spark, live):
            return rows_of_digest(digest)
        number = ledger.begin([])  # a replacement that failed needs no undoing: the next one replaces the same days
        written = (replace_folders if config.partition_by == "day" else partial(_replace_days, spark))(rows, target, layout)
        ledger.finish(number, batch, digest, days, data_summary(spark, live))
    return written


def _replace_days(spark: SparkSession, rows: DataFrame, target: str, layout: Layout) -> int:
    """Day-wise replacement inside wider folders: keep the folder's other days, then swap the folder."""
    if not table_exists(spark, target):
        return append_table(rows, target, layout)
    days = rows.select("order_date").distinct()
    folders = [r[0] for r in days.select(layout.folder_of(F.col("order_date")).alias("f")).distinct().collect()]
    stored = layout.in_folders(read_table(spark, target, layout, keep_folder=True), folders)
    stay = stored.select(*rows.columns).alias("s").join(
        days.alias("d"), F.col("s.order_date").eqNullSafe(F.col("d.order_date")), "left_anti"
    )
    fresh = F.lit(True).alias("_fresh")
    merged = materialise(stay.withColumn("_fresh", F.lit(False)).unionByName(rows.select("*", fresh)), "load-orders")
    replace_folders(merged.drop("_fresh"), target, layout)
    return merged.where("_fresh").count()
