import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from merchmill.llm import warc

LONG = "<p>" + "long page é " * 20 + "</p>"
ROWS = [(5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (1, "http://b\r\nX: y", "small"), (2, "u", "small"), (4, "u", None), (6, "u", ""),
        (7, "u", "WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n" * 10), (8, "u", "\r\n\r\n" * 60 + "tail"), (None, "u", LONG + "!"), (10, "u", LONG + "!"),
        (11, "u", "z" * 300_000), (12, "u", "x" * 100), (13, "u", "x" * 100), (14, "u", "y" * 99), (15, "u", "y" * 99)]
FIRST = {LONG: 3, LONG + "!": 10, "x" * 100: 12}


@pytest.fixture(params=["none", "gzip"])
def archives(spark, folder, request):
    pages = spark.createDataFrame([(*r, "d", 1) for r in ROWS], "page_id long, url string, html string, digest string, size int").repartition(3)
    warc.write_warc(pages, f"file://{folder}/w", compression=request.param)
    return f"file://{folder}/w"


def test_round_trip(spark, archives):
    got = {r[0]: tuple(r)[1:] for r in warc.read_pages(spark, archives).collect()}
    assert len(got) == len(ROWS)
    for page, _, html in ROWS:
        raw = (html or "").encode()
        first = FIRST.get(html)
        revisit = first is not None and first != page
        assert got[page] == (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None)


def test_files_are_warc(spark, archives):
    raw = b"".join(gzip.open(f).read() if f.endswith(".gz") else open(f, "rb").read() for f in sorted(glob.glob(archives[7:] + "/part-*")))
    assert raw.startswith(b"WARC/1.0\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")
    assert raw.count(b"WARC-Record-ID: <urn:page:") == len(ROWS) and b"\r\nX: y" not in raw.replace(b"http://b X: y", b"")


def test_filters_reach_the_reader(spark, archives):
    warc.register(spark)
    records = spark.read.format("warc").load(archives)
    revisits = records.where((F.col("record_type") == "revisit") & F.col("target_uri").isNotNull())
    assert {r.record_id for r in revisits.collect()} == {"urn:page:5", "urn:page:13", "urn:page:null"}
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" in plan and "Filter (" not in plan.split("BatchScan")[0]
    ids = records.where(F.col("record_id").isin("urn:page:1", "urn:page:2")).select("record_id", "payload").collect()
    assert sorted((r.record_id, bytes(r.payload)) for r in ids) == [("urn:page:1", b"small"), ("urn:page:2", b"small")]
    assert records.where("content_length > 100000").count() == 1
    assert records.where("length(record_type) = 7").count() == len([1 for p, _, h in ROWS if FIRST.get(h, p) != p])


def test_payloads_can_be_left_out(spark, archives):
    warc.register(spark)
    bare = spark.read.format("warc").option("payload", "false").option("partitionBytes", "1").load(archives)
    assert bare.where("payload IS NOT NULL").count() == 0 and bare.count() == len(ROWS)


def test_no_pages(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(pages, f"file://{folder}/none")
    assert warc.read_pages(spark, f"file://{folder}/none").count() == 0
