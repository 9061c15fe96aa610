"""Steps that the large tables made slow: how often they read and shuffle, beside what they give."""

from datetime import date

from pyspark.sql import functions as F
from test_tables import D1, D2, D3, frame

from checks import fixtures, spark_queries
from merchmill.config import ShopConfig
from merchmill.plans import uniqueness
from merchmill.plans.uniqueness import Repeated, repeated_values
from merchmill.sources import landing
from merchmill.sources.storage import child_names
from merchmill.sources.tables import Layout, append_table, read_table, replace_folders

SF = "/root/testdata/sf0.001"


def test_order_lines_are_shuffled_once_and_stay_with_their_order(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixtures.fixture(spark, SF, "raw_orders")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1 and plan.count("Exchange ") == 2  # the other: the orders


def test_the_report_makes_the_order_lines_and_product_days_once(spark, monkeypatch):
    made, stored = [], []
    monkeypatch.setattr(spark_queries, "fixture", lambda s, sf, name: made.append(name) or fixtures.fixture(s, sf, name))
    monkeypatch.setattr(spark_queries, "materialise", lambda df, name: stored.append(name) or df)
    spark_queries.dq_report(spark, SF)
    assert made.count("raw_orders") == 1 and "dq-product-days" in stored


def test_the_batch_of_a_merge_is_stored_before_it(spark, monkeypatch):
    batches = []
    monkeypatch.setattr(spark_queries, "overwrite_table", lambda *a: None)
    monkeypatch.setattr(spark_queries, "upsert", lambda df, *a: batches.append(df.inputFiles()))
    monkeypatch.setattr(spark_queries, "read_table", lambda s, *a: s.range(1))
    spark_queries.fct_orders_merge(spark, SF)
    assert len(batches) == 2 and all("merge-batch" in f for files in batches for f in files)


def test_a_check_of_much_that_changed_looks_no_values_up(spark, folder, monkeypatch):
    path, store, layout = f"{folder}/t", f"{folder}/store", Layout("d")
    monkeypatch.setattr(uniqueness, "materialise", lambda *a: 1 / 0)
    append_table(frame(spark, ("a", 1, D1), ("b", 0, D1), ("b", 1, D1), ("c", 1, D2)), path, layout)
    assert repeated_values(spark, path, layout, "k", store, F.col("v") > 0) == Repeated(1, 0)
    append_table(frame(spark, ("a", 1, D3), ("c", 0, D3), ("e", 1, D3)), path, layout)
    assert repeated_values(spark, path, layout, "k", store, F.col("v") > 0) == Repeated(3, 1)
    replace_folders(frame(spark, ("c", 1, D3), ("b", 1, D3), ("b", 1, D3)), path, layout)
    assert repeated_values(spark, path, layout, "k", store, F.col("v") > 0) == Repeated(2, 2)


def test_loading_an_unchanged_batch_again_writes_nothing(spark, folder, monkeypatch):
    config, day, other = ShopConfig(root=folder), date(2020, 1, 1), date(2020, 1, 2)
    path, layout = config.path("raw", "orders"), landing.warehouse_layout(config, "orders")

    def land(run_date, *keys):
        rows = spark.createDataFrame([(k, "c", "p", 1, 2.5, 2.5, "completed", d) for k, d in keys],
                                     "order_id string, customer_id string, product_id string, quantity bigint, unit_price double, "
                                     "total_amount double, status string, order_date date")
        landing.export_table(rows, config, "orders", run_date)

    def held():
        return sorted((r.order_id, r.order_date) for r in read_table(spark, path, layout).collect())

    land(day, ("a", day), ("b", other))
    assert landing.load_table(spark, config, "orders", day) == 2
    with monkeypatch.context() as no_write:
        no_write.setattr(landing, "replace_folders", lambda *a: 1 / 0)
        assert landing.load_table(spark, config, "orders", day) == 2
    assert held() == [("a", day), ("b", other)] and len(landing.load_ledger(spark, config).entries()) == 1
    # another load, or a change beside the loads, comes between: the batch is loaded in full
    land(other, ("x", other))
    assert landing.load_table(spark, config, "orders", other) == 1 and held() == [("a", day), ("x", other)]
    assert landing.load_table(spark, config, "orders", day) == 2 and held() == [("a", day), ("b", other)]
    append_table(read_table(spark, path, layout).where("order_id = 'a'"), path, layout)
    assert landing.load_table(spark, config, "orders", day) == 2 and held() == [("a", day), ("b", other)]
    # as does a batch with other rows
    land(day, ("a2", day), ("b", other))
    assert landing.load_table(spark, config, "orders", day) == 2 and held() == [("a2", day), ("b", other)]
    assert [n for n in child_names(spark, path) if n.startswith("order_date=")] != []


def test_late_orders_stage_each_table_once(spark, monkeypatch):
    stored, read = [], []
    monkeypatch.setattr(spark_queries, "materialise", lambda df, name: stored.append(name) or df.sparkSession.createDataFrame([], df.schema))
    monkeypatch.setattr(landing, "export_table", lambda rows, config, table, day: read.append((table, rows.inputFiles())))
    monkeypatch.setattr(spark_queries.jobs, "load_day", lambda *a: None)
    monkeypatch.setattr(spark_queries.jobs, "build_fact", lambda *a: None)
    monkeypatch.setattr(spark_queries, "read_table", lambda s, *a: s.range(1))
    spark_queries.fct_orders_late(spark, SF)
    assert sorted(stored) == ["late-staged-customers", "late-staged-orders", "late-staged-products"]
    # two days land all three tables from what was stored, none of them from the test tables again
    assert sorted(t for t, _ in read) == sorted(["customers", "orders", "products"] * 2) and not any(files for _, files in read)
