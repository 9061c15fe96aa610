"""Setting aside what can't be used of a source file, with its place and a reason, instead of losing it.

A cell that can't be read is NULL in its row, and is told of; a row without its key, and a record that is broken
(a quote that stays open at the end of its line, a wrong number of cells) is told of and left out. Each line of a
file is parsed once; the same job counts the faults of each kind.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from merchmill import values
from merchmill.functions import timestamp_or
from merchmill.sources.files import CSV_FORM, RAW_RECORD, cells_of, file_position, header_names, open_quote, typed
from merchmill.sources.storage import fingerprint, has_data

NOT_A_VALUE, NOT_A_TIME, NO_KEY, OPEN_QUOTE, CELL_COUNT = (
    "unreadable value", "unreadable time", "no key", "open quote", "wrong number of cells")
REASONS = (NOT_A_VALUE, NOT_A_TIME, NO_KEY, OPEN_QUOTE, CELL_COUNT)
#: with these a row can't be used at all
LEFT_OUT = (NO_KEY, OPEN_QUOTE, CELL_COUNT)
FAULT = "struct<column_name: string, value: string, reason: string>"


def scan_checked(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (), times: Sequence[str] = (),
    missing: Iterable[str] = values.MISSING_TEXTS,
) -> DataFrame:
    """The declared columns of every line of a header CSV, ``file_position``, and the ``faults`` found in the line.

    ``keys`` are columns a row can't do without, ``times`` text columns that should hold a wall-clock time. Lines
    are taken one by one: of a record with line breaks inside quotes the first and the last line are told of, and
    the lines between them unless they happen to have the right number of cells.
    """
    names = header_names(spark, path)
    text = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, RAW_RECORD])
    options = {**CSV_FORM, "columnNameOfCorruptRecord": RAW_RECORD}
    lines = spark.read.text(path).where(F.trim("value") != "").select(
        F.col("value"), file_position().alias("file_position"), F.from_csv("value", text, options).alias("c"))
    # the header stands at the start of each file
    is_header = reduce(Column.__and__, [F.col(f"c.`{n}`").eqNullSafe(F.lit(n)) for n in names])
    lines = lines.where(~is_header)
    cells = cells_of(names, schema, path, missing, lambda name: F.col(f"c.`{name}`"))
    whole = F.col(f"c.`{RAW_RECORD}`").isNull()
    broken = F.when(open_quote(F.col("value")), F.lit(OPEN_QUOTE)).when(~whole, F.lit(CELL_COUNT))

    def fault(wrong: Column, name: str, reason: str) -> Column:
        return F.when(wrong, F.struct(F.lit(name).alias("column_name"), cells[name].alias("value"), F.lit(reason).alias("reason")))

    found = [F.when(broken.isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), F.col("value").alias("value"), broken.alias("reason")))]
    for field in schema:
        cell = cells[field.name]
        if not isinstance(field.dataType, T.StringType):
            found.append(fault(broken.isNull() & cell.isNotNull() & typed(cell, field.dataType).isNull(), field.name, NOT_A_VALUE))
        if field.name in times:
            found.append(fault(broken.isNull() & cell.isNotNull() & timestamp_or(cell, None).isNull(), field.name, NOT_A_TIME))
        if field.name in keys:
            found.append(fault(broken.isNull() & typed(cell, field.dataType).isNull(), field.name, NO_KEY))
    return lines.select(
        *[typed(cells[f.name], f.dataType).alias(f.name) for f in schema], "file_position",
        F.array_compact(F.array(*found)).cast(f"array<{FAULT}>").alias("faults"),
    )


def store_checked(checked: DataFrame, path: str) -> dict[str, int]:
    """Write the rows of ``scan_checked`` once; returns how many faults of each kind the write counted."""
    seen = Observation()
    reasons = F.transform("faults", lambda f: f["reason"])
    counts = [F.sum(F.size(reasons) - F.size(F.array_remove(reasons, k))).alias(f"n{i}") for i, k in enumerate(REASONS)]
    checked.observe(seen, *counts).write.mode("overwrite").parquet(path)
    return {reason: seen.get[f"n{i}"] or 0 for i, reason in enumerate(REASONS)}


def usable_rows(stored: DataFrame) -> DataFrame:
    """The rows that can be used, without their faults."""
    out = F.exists("faults", lambda f: f["reason"].isin(*LEFT_OUT))
    return stored.where(~out).drop("faults")


def rejected(stored: DataFrame) -> DataFrame:
    """file, split, line (ascending in the split), column_name, value, reason of everything that was set aside."""
    place = F.col("file_position")
    return stored.where(F.size("faults") > 0).select(
        place["file"].alias("file"), place["split"].alias("split"), place["row"].alias("line"), F.inline("faults"))


def checked_source(
    spark: SparkSession, path: str, schema: T.StructType, store: str, keys: Sequence[str] = (), times: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected) of a source file, which is parsed when it is new or has changed and read from ``store``."""
    checked = scan_checked(spark, path, schema, keys, times)
    folder = f"{store}/{fingerprint(spark, {'file': spark.read.text(path)})}"
    if not has_data(spark, folder):
        store_checked(checked, folder)
    stored = spark.read.schema(checked.schema).parquet(folder)
    return usable_rows(stored), rejected(stored)
