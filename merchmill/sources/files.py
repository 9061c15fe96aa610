"""CSV input files and relational scans."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from merchmill import values
from merchmill.config import ShopConfig
from merchmill.schemas import SOURCE_SCHEMAS
from merchmill.sources.storage import exists

#: column that keeps file order where the first of several rows counts
FILE_POSITION = "file_position"
#: files a run may do without
OPTIONAL_FILES = ("order_payments",)


def source_path(config: ShopConfig, name: str) -> str:
    return f"{config.source_dir.rstrip('/')}/{config.source_files[name]}"


def check_sources(spark: SparkSession, config: ShopConfig, optional: Iterable[str] = OPTIONAL_FILES) -> None:
    """Fail before any work when the source folder or a needed file is absent; names all that are."""
    if not exists(spark, config.source_dir):
        raise FileNotFoundError(f"source folder not found: {config.source_dir}")
    missing = [
        file for name, file in config.source_files.items()
        if name not in optional and not exists(spark, source_path(config, name))
    ]
    if missing:
        raise FileNotFoundError(f"missing source files in {config.source_dir}: {', '.join(missing)}")


#: how the files are written, for the reader and for single lines
CSV_FORM = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
RAW_RECORD = "_raw_record"


def header_names(spark: SparkSession, path: str, **options) -> list[str]:
    """The columns of a header CSV as they are written."""
    return spark.read.options(header=True, inferSchema=False, **CSV_FORM).options(**options).csv(path).columns


def cells_of(
    names: Iterable[str], schema: T.StructType, path: str, missing: Iterable[str], cell: Callable[[str], Column]
) -> dict[str, Column]:
    """The text of each declared column, found by name; the usual texts for "missing" are NULL."""
    present = {name.strip().lstrip("\ufeff"): name for name in names}
    absent = [field.name for field in schema if field.name not in present]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    missing = list(missing)
    texts = {field.name: cell(present[field.name]) for field in schema}
    return {name: F.when(~text.isin(*missing), text) if missing else text for name, text in texts.items()}


def typed(text: Column, kind: T.DataType) -> Column:
    """A cell's value; NULL where it can't be read."""
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def open_quote(line: Column) -> Column:
    """Whether a quote that a line opens stays open at its end: it holds an odd number of quotes."""
    return F.length(line) % 2 != F.length(F.replace(line, F.lit('"'))) % 2


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType, missing: Iterable[str] = values.MISSING_TEXTS,
    multiline: bool = False, position: str | None = None, **options,
) -> DataFrame:
    """Header CSV with a declared schema; columns go by name, so files may hold more of them.

    Blanks around a cell are kept, a doubled quote is a quote, and the usual texts for "missing" are
    NULL. ``multiline`` allows line breaks inside quotes, at the price of one task per file. Without it a record
    that goes on in the next line stops the read with an error that names the file; only where the header has a
    single column can't it be told. A record with too few cells has NULL in the others.
    ``position`` names a column to add that sorts rows as they stand in the file.
    """
    # all cells are read as text and matched by name: a declared schema alone would go by position
    names = header_names(spark, path, multiLine=multiline, **options)
    whole = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RAW_RECORD]])
    # with all columns parsed, a record that was cut in two is seen by its number of cells in one half at least
    text = (
        spark.read.schema(whole).options(header=True, multiLine=multiline, columnPruning=multiline, **CSV_FORM)
        .option("columnNameOfCorruptRecord", RAW_RECORD).options(**options).csv(path)
    )
    if not multiline and len(names) > 1:
        problem = F.concat(
            F.lit("a quoted cell holds a line break, read this file with multiline: "), F.col("_metadata.file_path"),
            F.lit(", at "), F.col(RAW_RECORD), F.coalesce(F.left(f"`{names[0]}`", F.lit(0)), F.lit("")),
        )
        text = text.where(F.when(open_quote(F.col(RAW_RECORD)), F.raise_error(problem).cast("boolean")).otherwise(True))
    cells = cells_of(names, schema, path, missing, lambda name: F.col(f"`{name}`"))
    columns = [typed(cells[field.name], field.dataType).alias(field.name) for field in schema]
    if position is not None:
        columns.append(file_position().alias(position))
    return text.select(*columns)


def file_position() -> Column:
    """Sorts rows as they stand in a file: the running id only has to order those of one split, read by one task."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def scan_source(spark: SparkSession, config: ShopConfig, name: str) -> DataFrame:
    position = FILE_POSITION if name == "customers" else None
    return scan_csv(spark, source_path(config, name), SOURCE_SCHEMAS[name], multiline=name in config.multiline_files,
                    position=position)


def scan_query(spark: SparkSession, query: str, jdbc: dict[str, str] | None = None, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL query: over DataFrames named in it as ``{name}``, or over a JDBC database.

    For a large JDBC result pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` with ``dbtable`` in ``jdbc`` so that executors read slices side by side.
    """
    if jdbc is None:
        return spark.sql(query, **tables)
    reader = spark.read.format("jdbc").options(**jdbc)
    return (reader if "dbtable" in jdbc else reader.option("query", query)).load()
