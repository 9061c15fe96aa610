from datetime import date
from decimal import Decimal

import pytest

from merchmill import values
from merchmill.config import ShopConfig
from merchmill.schemas import LOAD_SCHEMAS, SOURCE_SCHEMAS
from merchmill.sources import landing, quarantine
from merchmill.sources.files import check_sources, scan_csv, scan_query
from merchmill.sources.tables import read_table

DAY = date(2020, 1, 1)


def write(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(text)
    return f"{folder}/{name}"


def test_csv_goes_by_column_name_and_keeps_text(spark, folder):
    path = write(folder, "c.csv", "\ufeffzip,customer_city,customer_unique_id,customer_id\n"
                 '1," são, ""x"" paulo ",u1,c1\n2,NA,u2,c2\n3,,u3,\n4,null,u4,c4\n')
    rows = scan_csv(spark, path, SOURCE_SCHEMAS["customers"]).collect()
    assert [tuple(r) for r in rows] == [
        ("c1", "u1", ' são, "x" paulo '), ("c2", "u2", None), (None, "u3", None), ("c4", "u4", None),
    ]


def test_csv_prices_and_bad_numbers(spark, folder):
    path = write(folder, "i.csv", "order_id,product_id,price\no,p,58.9\no,p,7\no,p,x\no,p,\no,p,0.005\n")
    got = [r.price for r in scan_csv(spark, path, SOURCE_SCHEMAS["order_items"]).collect()]
    assert got == [Decimal("58.90"), Decimal("7.00"), None, None, Decimal("0.01")]


def test_csv_line_breaks_in_quotes(spark, folder):
    path = write(folder, "p.csv", 'product_id,product_category_name\np1,"two\nlines"\n')
    rows = scan_csv(spark, path, SOURCE_SCHEMAS["products"], multiline=True).collect()
    assert [tuple(r) for r in rows] == [("p1", "two\nlines")]


def test_csv_without_a_needed_column(spark, folder):
    path = write(folder, "p.csv", "product_id\np1\n")
    with pytest.raises(ValueError, match="product_category_name"):
        scan_csv(spark, path, SOURCE_SCHEMAS["products"])


def test_csv_position_follows_the_file_over_many_splits(spark, folder):
    path = write(folder, "p.csv", "product_id,product_category_name\n" + "".join(f"p{i},c\n" for i in range(20_000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scan_csv(spark, path, SOURCE_SCHEMAS["products"], position="at")
        assert df.rdd.getNumPartitions() > 4
        got = [r.product_id for r in df.orderBy("at").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == [f"p{i}" for i in range(20_000)]


def test_missing_sources_are_all_named(spark, folder):
    config = ShopConfig(root=folder, source_dir=f"{folder}/none")
    with pytest.raises(FileNotFoundError, match="source folder"):
        check_sources(spark, config)
    config = ShopConfig(root=folder, source_dir=folder)
    for name in ("customers", "order_items", "translation"):
        write(folder, values.SOURCE_FILES[name], "x\n")
    with pytest.raises(FileNotFoundError) as missing:
        check_sources(spark, config)
    assert values.SOURCE_FILES["orders"] in str(missing.value)
    assert values.SOURCE_FILES["products"] in str(missing.value)
    assert values.SOURCE_FILES["order_payments"] not in str(missing.value)
    with pytest.raises(FileNotFoundError, match="payments"):
        check_sources(spark, config, optional=())


def test_query_scan_over_tables(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "k int, is_valid boolean")
    assert [r.k for r in scan_query(spark, "SELECT k FROM {t} WHERE is_valid", t=df).collect()] == [1]


def staged_orders(spark, *rows):
    schema = ("order_id string, customer_id string, product_id string, quantity bigint, unit_price decimal(18,2), "
              "total_amount decimal(18,2), status string, order_date date, is_valid boolean, invalid_reason string")
    return spark.createDataFrame(
        [(o, "c", "p", 1, Decimal("2.50"), Decimal("2.50"), "completed", d, ok, None) for o, d, ok in rows], schema
    )


def test_landing_of_an_empty_day_writes_nothing_and_the_load_skips_it(spark, folder):
    config = ShopConfig(root=folder)
    rows = landing.valid_rows(staged_orders(spark, ("a", DAY, False)), "orders", DAY)
    assert landing.export_table(rows, config, "orders", DAY) is None
    assert landing.load_table(spark, config, "orders", DAY) is None


@pytest.mark.parametrize("grain", ["day", "month"])
def test_loading_a_day_again_replaces_it_and_append_takes_a_batch_once(spark, folder, grain):
    other = date(2020, 1, 2)
    config = ShopConfig(root=folder, partition_by=grain)
    for day in (DAY, other, other):
        rows = landing.valid_rows(staged_orders(spark, ("a", DAY, True), ("b", other, True)), "orders", day)
        landing.export_table(rows, config, "orders", day)
        assert landing.load_table(spark, config, "orders", day) == 1
    layout = landing.warehouse_layout(config, "orders")
    loaded = read_table(spark, config.path("raw", "orders"), layout)
    assert sorted(r.order_id for r in loaded.collect()) == ["a", "b"]
    assert [(f.name, f.dataType) for f in loaded.schema] == [(f.name, f.dataType) for f in LOAD_SCHEMAS["orders"]]
    append = ShopConfig(root=folder, partition_by=grain, load_mode="append")
    assert landing.load_table(spark, append, "orders", other) == 0
    more = landing.valid_rows(staged_orders(spark, ("c", other, True), ("c2", DAY, True), ("n", None, True)), "orders")
    landing.export_table(more, config, "orders", date(2020, 1, 9))
    assert [landing.load_table(spark, append, "orders", date(2020, 1, 9)) for _ in range(3)] == [3, 0, 0]
    found = {r.order_id: r.order_date for r in read_table(spark, config.path("raw", "orders"), layout).collect()}
    assert found == {"a": DAY, "b": other, "c": other, "c2": DAY, "n": None}
    assert set(landing.load_ledger(spark, config).entries()[-1].days) == {DAY, other, None}


@pytest.mark.parametrize("stop", ["append_table", "finish"])
@pytest.mark.parametrize("grain", ["day", "month"])
def test_an_append_that_failed_is_undone_and_taken_once(spark, folder, monkeypatch, grain, stop):
    config = ShopConfig(root=folder, partition_by=grain, load_mode="append")
    layout = landing.warehouse_layout(config, "orders")

    def load(day, *rows):
        landing.export_table(landing.valid_rows(staged_orders(spark, *rows), "orders"), config, "orders", day)
        return landing.load_table(spark, config, "orders", day)

    load(DAY, ("a", DAY, True))
    append, late = landing.append_table, date(2020, 1, 5)

    def half(rows, target, table_layout):
        append(rows.limit(1), target, table_layout)
        raise ZeroDivisionError

    with monkeypatch.context() as broken:
        broken.setattr(*((landing, stop, half) if stop == "append_table" else (landing.Ledger, stop, lambda *a: 1 / 0)))
        with pytest.raises(ZeroDivisionError):
            load(late, ("b", DAY, True), ("c", late, True))
    assert landing.load_table(spark, config, "orders", late) == 2
    assert landing.load_table(spark, config, "orders", late) == 0
    assert sorted(r.order_id for r in read_table(spark, config.path("raw", "orders"), layout).collect()) == ["a", "b", "c"]
    assert [e.number for e in landing.load_ledger(spark, config).entries()] == [1, 2]


def test_load_refuses_null_in_a_required_column(spark, folder):
    config = ShopConfig(root=folder)
    landing.export_table(landing.valid_rows(staged_orders(spark, (None, DAY, True)), "orders"), config, "orders", DAY)
    with pytest.raises(Exception, match="required column orders.order_id"):
        landing.load_table(spark, config, "orders", DAY)


def test_broken_landing_files_are_not_skipped(spark, folder):
    import os

    config = ShopConfig(root=folder)
    os.makedirs(config.landing_path("orders", DAY))
    write(config.landing_path("orders", DAY), "part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        landing.load_table(spark, config, "orders", DAY)


def test_config_checks_and_paths(monkeypatch):
    with pytest.raises(ValueError):
        ShopConfig(root="x", grain="item")
    with pytest.raises(ValueError):
        ShopConfig(root="x", partition_by="week")
    with pytest.raises(ValueError):
        ShopConfig(root="x", load_mode="merge")
    with pytest.raises(ValueError):
        ShopConfig(root="x", daily_orders=0)
    monkeypatch.setenv("SHOP_ROOT", "s3a://shop/")
    monkeypatch.setenv("RANDOM_SEED", "7")
    config = ShopConfig.from_env(target="prod")
    assert config.path("raw", "orders") == "s3a://shop/prod/raw/orders" and config.seed == 7
    assert config.landing_path("orders", DAY) == "s3a://shop/prod/landing/orders/date=2020-01-01"


# --- records with line breaks, and what is set aside ------------------------------------------

ORDERS = SOURCE_SCHEMAS["orders"]
FAULTY = "\n".join([
    "order_id,customer_id,order_status,order_purchase_timestamp,more",
    'o1,c1,delivered,2018-01-01 10:00:00,"a ""quoted"" cell, with a comma"',
    'o2,c2,"on', 'hold",2018-01-01,x',
    "o3,c3,shipped,soon,y",
    ",c4,shipped,2018-01-02,z",
    "NA,c5,shipped,NaN,z",
    "o6,c6",
    "",
    "o7,c7,created,,w",
]) + "\n"


def put(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return f"{folder}/{name}"


@pytest.mark.parametrize("text", [
    'product_id,product_category_name\np1,"a\nb"\n', 'product_category_name,product_id\n"a\nb",p1\n',
    'product_id,x,product_category_name\np0,1,c\np1,"\n\n",d\n'])
def test_a_record_with_a_line_break_is_refused_or_read_whole(spark, folder, text):
    path = put(folder, "products.csv", text)
    with pytest.raises(Exception, match="read this file with multiline"):
        scan_csv(spark, path, SOURCE_SCHEMAS["products"]).collect()
    with pytest.raises(Exception, match="products.csv"):
        scan_csv(spark, path, SOURCE_SCHEMAS["products"]).count()
    rows = scan_csv(spark, path, SOURCE_SCHEMAS["products"], multiline=True).where("product_id = 'p1'").collect()
    assert [r.product_category_name for r in rows] in (["a\nb"], ["d"])


def test_short_records_and_quotes_inside_cells_are_read(spark, folder):
    path = put(folder, "p.csv", 'product_id,product_category_name,x\np1,"say ""hi"", you",1\np2\n')
    rows = scan_csv(spark, path, SOURCE_SCHEMAS["products"]).collect()
    assert sorted((r.product_id, r.product_category_name) for r in rows) == [("p1", 'say "hi", you'), ("p2", None)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_faults_are_set_aside_with_place_and_reason(spark, folder, end):
    path = put(folder, "orders.csv", FAULTY.replace("\n", end))
    rows, rejected = quarantine.checked_source(spark, path, ORDERS, f"{folder}/checked", ["order_id"], ["order_purchase_timestamp"])
    assert sorted((r.order_id, r.order_purchase_timestamp) for r in rows.collect()) == [("o1", "2018-01-01 10:00:00"), ("o3", "soon"), ("o7", None)]
    found = sorted(rejected.collect(), key=lambda r: (r.split, r.line))
    assert [(r.column_name, r.value, r.reason) for r in found] == [
        (None, 'o2,c2,"on', "open quote"), (None, 'hold",2018-01-01,x', "open quote"),
        ("order_purchase_timestamp", "soon", "unreadable time"), ("order_id", None, "no key"), ("order_id", None, "no key"),
        (None, "o6,c6", "wrong number of cells")]
    assert all(r.file.endswith("orders.csv") for r in found)


def test_faults_are_counted_by_the_job_that_stores_them(spark, folder):
    path = put(folder, "items.csv", "order_id,product_id,price\no1,p1,3.5\no1,p2,free\n,p3,12\n,,cheap\n")
    checked = quarantine.scan_checked(spark, path, SOURCE_SCHEMAS["order_items"], ["order_id", "product_id"])
    counts = quarantine.store_checked(checked, f"{folder}/stored")
    assert counts == {"unreadable value": 2, "unreadable time": 0, "no key": 3, "open quote": 0, "wrong number of cells": 0}
    empty = put(folder, "none.csv", "order_id,product_id,price\n")
    checked = quarantine.scan_checked(spark, empty, SOURCE_SCHEMAS["order_items"])
    assert set(quarantine.store_checked(checked, f"{folder}/none").values()) == {0}


def test_a_source_is_parsed_again_when_it_changes(spark, folder, monkeypatch):
    path = put(folder, "orders.csv", FAULTY)
    args = (spark, path, ORDERS, f"{folder}/checked", ["order_id"])
    first = quarantine.checked_source(*args)[0].count()
    with monkeypatch.context() as broken:
        broken.setattr(quarantine, "store_checked", lambda *a: 1 / 0)
        assert quarantine.checked_source(*args)[0].count() == first
    put(folder, "orders.csv", FAULTY + "o9,c9,created,2018-01-01,v\n")
    assert quarantine.checked_source(*args)[0].count() == first + 1
