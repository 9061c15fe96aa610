"""The stored history: the draw order, price counts and persons that a day reads a few folders of."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import FIRST, NOW, shop, write_sources  # noqa: F401

from merchmill.operators import exact_median, top_up
from merchmill.plans import history, ingest, jobs
from merchmill.schemas import SOURCE_SCHEMAS


@pytest.fixture
def stored(spark, shop, folder, monkeypatch):  # noqa: F811
    """Some 1,800 lines in 16 draw folders and 8 buckets."""
    monkeypatch.setattr(history, "LINES_PER_DRAW_FOLDER", 100)
    write_sources(folder, orders=900, days=40)
    config = shop()
    src = jobs.read_sources(spark, config)
    return config, src, history.stored_history(spark, config, src)


def folders(df, name):
    return {f.split(f"{name}=")[1].split("/")[0] for f in df.inputFiles() if f"{name}=" in f}


def read_files(df):
    """Files that the scans of a plan that ran have opened, and rows that they gave out."""
    df.collect()
    found = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            found.append((node.relation().location().rootPaths().mkString(), metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()))
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))
        return None

    visit(df._jdf.queryExecution().executedPlan())
    return found


def test_a_top_up_reads_a_bounded_number_of_files(spark, stored):
    config, src, kept = stored
    assert kept.draw_bits == 5 and kept.lines == spark.read.parquet(f"{kept.path}/draws").count()
    all_files = len(spark.read.parquet(f"{kept.path}/draws").inputFiles())
    assert all_files >= 32
    few = history.lines_before(spark, kept, 0.04)
    [(_, files, rows)] = read_files(few)
    assert files <= 4 and rows < kept.lines / 8
    assert 0 < few.count() < kept.lines / 8
    values = [r.draw for r in spark.read.parquet(f"{kept.path}/draws").select("draw").collect()]
    assert sorted(r.draw for r in few.collect()) == sorted(v for v in values if v < f"{int(0.04 * 2**32):08x}")


@pytest.mark.parametrize("count", [1, 40, 700, 100_000])
def test_a_top_up_draws_the_same_lines_as_over_all_of_them(spark, stored, count):
    config, src, kept = stored
    day = FIRST + timedelta(days=3)
    lines = ingest.build_orders(src["orders"], src["order_items"], src["customers"], NOW)
    want = top_up(lines, day, count, config.seed, ingest.LINE_KEY)
    got = history.drawn_lines(spark, kept, day, NOW, count)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_files_of_the_draw_do_not_overlap(spark, stored):
    kept = stored[2]
    spans = sorted((r[1], r[2]) for r in spark.read.parquet(f"{kept.path}/draws").groupBy(F.input_file_name()).agg(F.min("draw"), F.max("draw")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_the_store_of_lines_is_written_without_a_sample(spark, stored):
    config, src, kept = stored
    draws = spark.read.parquet(f"{kept.path}/draws")
    assert len(draws.inputFiles()) == len(folders(draws, "draw_folder")) == 32  # a task for each folder, no cut inside one
    days = spark.read.parquet(f"{kept.path}/days")
    assert "draw" not in days.columns and draws.drop("draw", "draw_folder").exceptAll(days.select(draws.columns[:-2])).isEmpty()
    # a range split would run the joins of the lines a second time for its sample
    plan = history.history_layout(config).arrange(days)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan and "REBALANCE" in plan.upper()


def test_prices_of_a_batch_come_from_its_buckets(spark, stored):
    config, src, kept = stored
    want = {r.product_id: r.median_price for r in exact_median(src["order_items"], "product_id", "price", "median_price").collect()}
    assert {r.product_id: r.median_price for r in history.median_prices(spark, kept).collect()} == want
    batch = spark.createDataFrame([("p4",), ("none",), (None,)], "product_id string")
    some = history.median_prices(spark, kept, batch)
    assert {r.product_id: r.median_price for r in some.collect()} == {"p4": want["p4"]}
    scans = [s for s in read_files(some) if "/prices" in s[0]]
    assert scans and max(rows for _, _, rows in scans) < spark.read.parquet(f"{kept.path}/prices").count()


def test_price_counts_add_up_over_batches(spark, stored):
    config, src, kept = stored
    before = src["order_items"]
    more = spark.createDataFrame([("x", "p1", "3.00"), ("x", "p1", "3.00"), ("y", "p1", None), ("y", "new", "7.25"), ("z", None, "1.00")],
                                 "order_id string, product_id string, price string").select(
        "order_id", "product_id", F.col("price").cast(SOURCE_SCHEMAS["order_items"]["price"].dataType))
    history.add_prices(more, kept)
    whole = before.select(more.columns).union(more)
    want = {r.product_id: r.median_price for r in exact_median(whole, "product_id", "price", "median_price").collect()}
    assert {r.product_id: r.median_price for r in history.median_prices(spark, kept).collect()} == want and "new" in want


def test_persons_of_a_batch_are_the_first_rows_of_theirs(spark, stored):
    config, src, kept = stored
    want = {r.customer_id: r.city for r in ingest.build_customers(src["customers"], NOW).collect()}
    batch = spark.createDataFrame([("person03",), ("nobody",), ("person03",)], "customer_unique_id string")
    assert {r.customer_id: r.city for r in ingest.customer_rows(history.people(spark, kept), NOW).collect()} == want
    assert [(r.customer_unique_id) for r in history.people(spark, kept, batch).collect()] == ["person03"]


def test_a_store_that_was_not_finished_is_built_again(spark, shop, monkeypatch):  # noqa: F811
    config = shop()
    src = jobs.read_sources(spark, config)
    with monkeypatch.context() as broken:
        broken.setattr(history, "add_prices", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            history.stored_history(spark, config, src)
    kept = history.stored_history(spark, config, src)
    assert history.median_prices(spark, kept).count() == 11
    assert jobs.ingest_day(spark, config, FIRST, datetime(2018, 4, 10))["orders"] == 30
