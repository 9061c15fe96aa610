"""WARC archives: a writer in DataFrame operations and a Python data source that reads them.

``spark.read.format("warc").load(path)`` plans one partition per run of files, parses a record's header
first and reads its block only when the header passes the pushed filters and the payload is wanted
(``option("payload", "false")`` skips all blocks); other blocks are stepped over by their length.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringStartsWith)

EOL = b"\r\n"
SCHEMA = ("record_id string, record_type string, target_uri string, date string, content_type string, content_length long, "
          "payload_digest string, refers_to string, http_content_length long, payload binary")
#: Column -> the header it comes from, in lower case.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date",
           "content_type": "content-type", "content_length": "content-length", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
#: Bytes of archives that one partition reads, unless a single file has more.
PARTITION_BYTES = 64 << 20


def _test(f: Filter):
    """A test of a header's value for a filter that this source can answer, else None."""
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in HEADERS:
        return None
    made = {EqualTo: lambda v: v == f.value, In: lambda v: v in f.value, GreaterThan: lambda v: v > f.value, LessThan: lambda v: v < f.value,
            GreaterThanOrEqual: lambda v: v >= f.value, LessThanOrEqual: lambda v: v <= f.value,
            StringStartsWith: lambda v: v.startswith(f.value), StringContains: lambda v: f.value in v}
    if isinstance(f, IsNull):
        return column, lambda v: v is None
    if isinstance(f, IsNotNull):
        return column, lambda v: v is not None
    test = made.get(type(f))
    return test and (column, lambda v: v is not None and test(v))


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.payload = options["path"], options.get("payload", "true").lower() != "false"
        self.bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.filters: list[Filter] = []

    def _store(self):
        from pyarrow import fs

        if self.path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + self.path[5:].lstrip("/")
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _test(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = self._store()
        found = store.get_file_info(fs.FileSelector(path, recursive=True)) if store.get_file_info(path).type == fs.FileType.Directory else [store.get_file_info(path)]
        files = sorted((x for x in found if x.type == fs.FileType.File and x.size and not x.base_name.startswith(("_", "."))), key=lambda x: x.path)
        planned, size = [[]], 0
        for x in files:
            if planned[-1] and size + x.size > self.bytes:
                planned.append([])
                size = 0
            planned[-1].append(x.path)
            size += x.size
        return [Files(x) for x in planned if x] or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        tests = [_test(f) for f in self.filters]
        store, _ = self._store()
        for path in partition.value:
            compressed = path.endswith(".gz")
            with store.open_input_stream(path, compression="gzip") if compressed else store.open_input_file(path) as raw:
                yield from self._records(raw if compressed else io.BufferedReader(raw, 1 << 20), compressed, tests)

    def _records(self, source, compressed: bool, tests: list) -> Iterator[tuple]:
        if compressed:
            source = io.BufferedReader(source, 1 << 20)
        while line := source.readline():
            if not line.strip():
                continue  # between records
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record starts with {line[:40]!r}")
            headers = _header_lines(source)
            row = {c: headers.get(h) for c, h in HEADERS.items()}
            size = row["content_length"] = int(row["content_length"])
            row |= {c: row[c].strip("<>") for c in ("record_id", "refers_to") if row[c]}
            if not all(test(row[c]) for c, test in tests):
                source.read(size) if compressed else source.seek(size, 1)
                continue
            http_length = payload = None
            if not (row["content_type"] or "").startswith("application/http"):
                payload = source.read(size) if self.payload else source.seek(size, 1) and None
            elif not self.payload and row["record_type"] != "revisit":
                source.seek(size, 1) if not compressed else source.read(size)
            else:
                block = io.BytesIO(source.read(size))
                block.readline()
                length = _header_lines(block).get("content-length")
                http_length = int(length) if length else None
                payload = block.read() if row["record_type"] != "revisit" and self.payload else None
            yield (*row.values(), http_length, payload)


def _header_lines(source) -> dict[str, str]:
    headers: dict[str, str] = {}
    while (line := source.readline().rstrip(EOL)):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers.setdefault(name.strip().lower(), value.strip())
    return headers


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark hand filters to Python data sources."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def warc_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 100) -> DataFrame:
    """One column ``record``: the WARC record of each row of ``pages`` (page_id, url, html).

    Of equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id is a response
    with its payload, the others are revisits without one; smaller payloads are always responses. Null
    html is empty, a null url writes no target URI, a null page_id is written as ``null`` and is smallest
    only among its like. Rows that repeat the smallest page_id are all responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.regexp_replace("url", r"[\r\n]+", " ").alias("url"), F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
    first = rows.where(F.col("size") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"))
    # the left side keeps its pages where they are when first is small; else a hot digest is split as a skewed join
    known = rows.join(first, "digest", "left")
    revisit = F.coalesce(F.col("first_id") != F.col("page_id"), F.col("page_id").isNull() & F.col("first_id").isNotNull())
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    return known.withColumn("block", body).select(F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn("first_id")), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block")).alias("record"))


def write_warc(pages: DataFrame, path: str, compression: str = "gzip", **settings) -> None:
    """Write ``warc_records`` as archives: Spark's own text writer, with the blank lines after a record as line end.

    ``compression``: "gzip" for a whole archive, or "none", which lets a reader step over blocks unread.
    """
    warc_records(pages, **settings).write.options(lineSep="\r\n\r\n", compression=compression).text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archives under ``path``.

    A response's size and digest are taken from the payload that was read, a revisit's from its headers.
    """
    register(spark)
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS bigint)")
    response = F.col("record_type") == "response"
    return spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("http_content_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", number("refers_to").alias("refers_to"))
