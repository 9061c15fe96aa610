import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from merchmill import values
from merchmill.__main__ import config_from, main, parse
from merchmill.config import ShopConfig
from merchmill.plans import jobs, models
from merchmill.sources.storage import has_data
from merchmill.sources.tables import table_folder
from merchmill.sources.tables import read_table

FIRST = date(2018, 3, 30)
NOW = datetime(2018, 4, 10, 8)


def write_sources(folder, orders=60, days=5):
    """Some days of orders over a month's end; every order has two products, one of them twice."""
    def put(name, header, lines):
        with open(f"{folder}/{values.SOURCE_FILES[name]}", "w", encoding="utf-8") as out:
            out.write("\n".join([header, *lines]) + "\n")

    ids = range(orders)
    put("customers", "customer_id,customer_unique_id,customer_zip,customer_city",
        [f"c{i},person{i % 17:02d},1,cidade d'{i % 5}" for i in ids if i % 19])
    put("orders", "order_id,customer_id,order_status,order_purchase_timestamp,x",
        [f"o{i:03d},c{i},{('delivered', 'shipped', 'canceled', 'created')[i % 4]},"
         f"{datetime(2018, 3, 30, 12) + timedelta(days=i % days) if i % 23 else 'soon'},1" for i in ids])
    put("order_items", "order_id,item,product_id,price",
        [f"o{i:03d},{n},p{(i + (n == 3)) % 11},{10 + i + n / 4}" for i in ids for n in (1, 2, 3)])
    put("products", "product_id,product_category_name", [f"p{i},{'' if i == 3 else 'cat' + str(i % 3)}" for i in range(12)])
    put("translation", "product_category_name,product_category_name_english", ["cat0,electronics", "cat1,health_beauty"])


@pytest.fixture
def shop(folder):
    write_sources(folder)
    return lambda **settings: ShopConfig(root=f"{folder}/lake", source_dir=folder, **{"daily_orders": 30, **settings})


def table(spark, config, layer, name):
    layout = {"raw": jobs.order_layout, "ingest": jobs.order_layout, "staged": jobs.order_layout,
              "warehouse": jobs.fact_layout}.get(layer)
    layout = layout(config) if layout else jobs.mart_layout(config, name)
    return read_table(spark, config.path(layer, name), layout)


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("grain, partition_by", [("order", "day"), ("line", "month")])
def test_two_days_then_the_same_day_again(spark, shop, grain, partition_by):
    config = shop(grain=grain, partition_by=partition_by)
    days = [FIRST + timedelta(days=n) for n in (1, 2)]
    done = [jobs.run_day(spark, config, day, NOW) for day in days]
    assert done[0]["ingested"]["orders"] == 30
    assert done[0]["loaded"]["orders"] and all(t["passed"] for t in done[1]["tests"])
    assert (len(done[1]["tests"])) == (21 if grain == "order" else 18)
    fact = table(spark, config, "warehouse", "fct_orders").drop("loaded_at")
    assert {r.order_date for r in fact.select("order_date").distinct().collect()} == set(days)
    per_order = fact.groupBy("order_id").count().where("count > 1").count()
    assert (per_order == 0) if grain == "order" else (per_order > 0)
    before = {"fact": rows(fact), **{m: rows(table(spark, config, "marts", m)) for m in models.MARTS}}
    again = jobs.run_day(spark, config, days[1], NOW)
    assert again["ingested"] == {"customers": 0, "products": 0, "orders": 0}
    assert again["staged"] == {"customers": 0, "products": 0, "orders": 0}
    after = {"fact": rows(table(spark, config, "warehouse", "fct_orders").drop("loaded_at")),
             **{m: rows(table(spark, config, "marts", m)) for m in models.MARTS}}
    assert after == before
    if grain == "order":  # marts refreshed for touched days equal a full rebuild
        jobs.build_marts(spark, config)
        assert {m: rows(table(spark, config, "marts", m)) for m in models.MARTS} == {m: before[m] for m in models.MARTS}


def test_whole_day_without_limit_adds_nothing(spark, shop):
    config = shop(daily_orders=None)
    src = jobs.read_sources(spark, config)
    done = jobs.ingest_day(spark, config, FIRST, NOW, src)
    assert done["orders"] == 2 * len([i for i in range(60) if i % 5 == 0 and i % 23])
    stored = table(spark, config, "ingest", "orders")
    assert {r.order_date for r in stored.collect()} == {FIRST}
    people = read_table(spark, config.path("ingest", "customers"))
    known = {r.customer_id for r in stored.select("customer_id").collect()}
    assert {r.customer_id for r in people.collect()} == {c for c in known if c.startswith("person")}


def test_empty_day_is_skipped_by_every_step(spark, shop):
    config = shop(daily_orders=None)
    done = jobs.run_day(spark, config, date(2001, 1, 1), NOW)
    assert done["ingested"]["orders"] == 0 and done["landed"] == {} and "tests" not in done
    assert set(done["loaded"].values()) == {None}
    assert jobs.run_day(spark, config, FIRST, NOW)["loaded"]["orders"] > 0
    quiet = jobs.run_day(spark, config, date(2001, 1, 1), NOW)
    assert "orders" not in quiet["landed"] and quiet["loaded"]["orders"] is None
    assert all(t["passed"] for t in quiet["tests"])


def test_history_equals_day_by_day(spark, shop, folder):
    write_sources(folder, days=2)
    config = shop(daily_orders=None)
    done = jobs.run_history(spark, config, FIRST, NOW)
    assert done["ingested"]["orders"] == 120 and all(t["passed"] for t in done["tests"])
    whole = rows(table(spark, config, "warehouse", "fct_orders").drop("loaded_at"))
    day_folder = f"{table_folder(spark, config.path('warehouse', 'fct_orders'))}/order_date=2018-03-31"
    status = [r.status for r in spark.read.parquet(day_folder).coalesce(1).collect()]
    assert len(set(status)) > 1 and status == sorted(status)  # clustered inside the day
    assert jobs.seed_history(spark, config, NOW) == {"customers": 0, "products": 0, "orders": 0}
    daily = ShopConfig(root=config.root, source_dir=config.source_dir, target="prod", daily_orders=None)
    for n in range(2):
        jobs.run_day(spark, daily, FIRST + timedelta(days=n), NOW)
    jobs.run_day(spark, daily, NOW.date(), NOW)  # orders without a readable time count for the day of the run
    assert rows(table(spark, daily, "warehouse", "fct_orders").drop("loaded_at")) == whole


@pytest.mark.parametrize("broken_mart", list(models.MARTS))
def test_marts_catch_up_after_a_run_that_stopped(spark, shop, monkeypatch, broken_mart):
    config = shop(daily_orders=None)
    days = [FIRST + timedelta(days=n) for n in (1, 2)]
    for day in days:
        jobs.run_day(spark, config, day, NOW)
    moved = table(spark, config, "warehouse", "fct_orders").limit(1).withColumn("order_date", F.lit(days[0]))
    jobs.upsert(moved, config.path("warehouse", "fct_orders"), ["order_id"], jobs.fact_layout(config), jobs.pending_path(config))
    write, path = jobs.replace_folders, config.path("marts", broken_mart)

    def stop(df, target, layout):
        return 1 / 0 if target == path else write(df, target, layout)

    with monkeypatch.context() as broken:
        broken.setattr(jobs, "replace_folders", stop)
        with pytest.raises(ZeroDivisionError):
            jobs.build_marts(spark, config, [])
    jobs.build_marts(spark, config, [])
    found = {m: rows(table(spark, config, "marts", m)) for m in models.MARTS}
    jobs.build_marts(spark, config)
    assert found == {m: rows(table(spark, config, "marts", m)) for m in models.MARTS}
    assert not has_data(spark, jobs.pending_path(config))


def test_a_later_day_reads_only_its_folder_of_the_stored_history(spark, shop, folder):
    config = shop()
    src = jobs.read_sources(spark, config)
    history = jobs.stored_history(spark, config, src)
    assert jobs.stored_history(spark, config, jobs.read_sources(spark, config)) == history
    lines = jobs.day_lines(spark, config, history, FIRST + timedelta(days=1), NOW)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(order_date#" in plan
    write_sources(folder, orders=70)
    assert jobs.stored_history(spark, config, jobs.read_sources(spark, config)) != history


def test_a_day_without_rows_leaves_no_landing_folder(spark, shop):
    from merchmill.sources import landing

    config = shop()
    landed = spark.createDataFrame([("c1", "n", "e@x", "city", 30, "26-35")], "customer_id string, full_name string, email string, city string, age int, age_group string")
    assert landing.export_table(landed, config, "customers", FIRST)
    assert landing.export_table(landed.where("false"), config, "customers", FIRST) is None
    assert landing.load_table(spark, config, "customers", FIRST) is None


def test_steps_run_alone(shop, monkeypatch, capsys):
    config = shop()
    monkeypatch.setenv("SHOP_ROOT", config.root)
    monkeypatch.setenv("SHOP_SOURCE_DIR", config.source_dir)
    args = ["--date", "2018-03-31", "--limit", "5", "--load-mode", "append", "--lookback-days", "9", "--threads", "2"]
    assert config_from(parse(args)).lookback_days == 9 and config_from(parse(args)).load_mode == "append"
    done = {step: main([*args, "--step", step])[step] for step in ("ingest", "stage", "export", "load", "fact", "marts", "test")}
    assert done["ingest"]["orders"] == 5 and all(t["passed"] for t in done["test"])


def test_late_orders_need_a_full_refresh(spark, shop):
    config = shop(daily_orders=None)
    last = FIRST + timedelta(days=4)
    jobs.run_day(spark, config, last, NOW)
    jobs.ingest_day(spark, config, FIRST, NOW)
    jobs.stage_day(spark, config, FIRST, NOW.date())
    jobs.export_day(spark, config, FIRST)
    jobs.load_day(spark, config, FIRST)
    jobs.build_fact(spark, config, last)
    fact = table(spark, config, "warehouse", "fct_orders")
    assert FIRST not in {r.order_date for r in fact.collect()}  # loaded, but older than the look-back
    jobs.build_fact(spark, config, last, full_refresh=True)
    assert FIRST in {r.order_date for r in table(spark, config, "warehouse", "fct_orders").collect()}


def test_the_ledger_brings_late_orders_and_takes_up_after_a_failure(spark, shop, monkeypatch):
    config = shop(daily_orders=None, increment="ledger", load_mode="append")
    last = FIRST + timedelta(days=4)
    jobs.run_day(spark, config, last, NOW)
    for day in (FIRST, FIRST + timedelta(days=1)):
        jobs.ingest_day(spark, config, day, NOW)
        jobs.stage_day(spark, config, day, NOW.date())
        jobs.export_day(spark, config, day)
        jobs.load_day(spark, config, day)
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "upsert", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.build_fact(spark, config, last)
    assert set(jobs.build_fact(spark, config, last)) == {FIRST, FIRST + timedelta(days=1)}
    assert jobs.build_fact(spark, config, last) == []  # nothing was loaded since
    fact = rows(table(spark, config, "warehouse", "fct_orders").drop("loaded_at"))
    jobs.build_fact(spark, config, last, full_refresh=True)
    assert rows(table(spark, config, "warehouse", "fct_orders").drop("loaded_at")) == fact


def test_a_day_from_files_with_faults(spark, shop, folder):
    """With quarantine a run goes on without the lines that can't be used, and says which they are."""
    config = shop(daily_orders=None, quarantine=True)
    with open(f"{folder}/{values.SOURCE_FILES['orders']}", "a", encoding="utf-8") as out:
        out.write('o900,c1,"on\nhold",2018-03-31 10:00:00,1\n,c2,delivered,2018-03-31 10:00:00,1\n')
    done = jobs.run_day(spark, config, FIRST, NOW)
    found = {(r.source, r.column_name, r.reason) for r in jobs.quarantined(spark, config).collect()}
    assert {("orders", None, "open quote"), ("orders", "order_id", "no key"), ("orders", "order_purchase_timestamp", "unreadable time")} <= found
    assert all(t["passed"] for t in done["tests"])
    with pytest.raises(Exception, match="multiline"):
        jobs.run_day(spark, shop(daily_orders=None, target="prod"), FIRST, NOW)


def test_arguments(spark, shop, capsys, monkeypatch):
    args = parse(["--date", "2018-03-31", "--limit", "0", "--grain", "line"])
    assert args.date == date(2018, 3, 31) and config_from(args).daily_orders is None
    assert config_from(args).grain == "line"
    assert config_from(parse([])).daily_orders == 250
    config = shop()
    monkeypatch.setenv("SHOP_ROOT", config.root)
    monkeypatch.setenv("SHOP_SOURCE_DIR", config.source_dir)
    main(["--date", "2018-03-31", "--limit", "5"])
    shown = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert shown["ingested"]["orders"] == 5 and len(shown["tests"]) == 21
    assert main(["--seed", "--date", "2018-03-31"])["ingested"]["orders"] == 115
    assert main(["--ingest-only", "--date", "2018-03-31"])["ingested"]["orders"] == 0
    with pytest.raises(SystemExit):
        parse(["--date", "31/03/2018"])


def test_missing_sources_stop_the_run(spark, folder):
    config = ShopConfig(root=f"{folder}/lake", source_dir=folder)
    with pytest.raises(FileNotFoundError):
        jobs.run_day(spark, config, FIRST, NOW)
    assert not has_data(spark, config.path("ingest", "orders"))
