"""The registered queries: each takes (spark, sf_dir) and runs over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.fixtures import AS_OF, NEXT_DATE, NOW, RUN_DATE, SEED, fixture
from merchmill.config import ShopConfig
from merchmill.functions import age_group, category_group, derived_age, order_status, timestamp_or, title_words
from merchmill.operators import day_rows, exact_median, head_rows, take_batch, top_up
from merchmill.plans import ingest, jobs, models, quality, staging
from merchmill.plans.uniqueness import repeated_values
from merchmill.schemas import SOURCE_SCHEMAS
from merchmill.sources import landing
from merchmill.sources.files import scan_csv
from merchmill.sources.quarantine import checked_source
from merchmill.sources.storage import materialise, scratch_path, side_by_side
from merchmill.sources.tables import (
    Layout, append_table, insert_if_absent, overwrite_table, read_table, replace_folders, rows_between, upsert,
)

BATCH, HEAD, LARGE = 250, 50, 20_000
Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: money as double, times as text."""
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            value = value.cast("string")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def scratch_config(spark: SparkSession, name: str, **settings) -> ShopConfig:
    """A deployment in fresh scratch. Months as partitions: the tables hold years of tiny days."""
    return ShopConfig(root=scratch_path(spark, name), **{"partition_by": "month", **settings})


# --- shared steps ----------------------------------------------------------------------------

def _stored(tables: dict[str, DataFrame], prefix: str) -> dict[str, DataFrame]:
    """The tables in scratch, written at the same time: some are small files that one task reads."""
    return side_by_side(len(tables), {n: partial(materialise, df, f"{prefix}-{n}") for n, df in tables.items()})


def built_orders(spark, sf):
    return ingest.build_orders(
        fixture(spark, sf, "csv_orders"), fixture(spark, sf, "csv_order_items"),
        fixture(spark, sf, "csv_customers"), NOW,
    )


def built_customers(spark, sf):
    return ingest.build_customers(fixture(spark, sf, "csv_customers"), NOW, SEED)


def built_products(spark, sf):
    return ingest.build_products(
        fixture(spark, sf, "csv_products"), fixture(spark, sf, "csv_order_items"),
        fixture(spark, sf, "csv_translation"), NOW,
    )


def batch(spark, sf):
    return take_batch(built_orders(spark, sf), RUN_DATE, BATCH, SEED, ingest.LINE_KEY)


def staged_customers(spark, sf):
    return staging.stage_customers(fixture(spark, sf, "raw_customers"))


def staged_products(spark, sf):
    return staging.stage_products(fixture(spark, sf, "raw_products"))


def staged_orders(spark, sf, lines: DataFrame | None = None):
    """From ``lines`` where the raw order lines are stored already."""
    raw = fixture(spark, sf, "raw_orders") if lines is None else lines
    return staging.stage_orders(raw, *[fixture(spark, sf, f"raw_{t}") for t in ("customers", "products")])


def warehouse(spark, sf, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    staged = {
        "orders": staged_orders(spark, sf, lines), "customers": staged_customers(spark, sf), "products": staged_products(spark, sf),
    }
    return {name: landing.declared(landing.valid_rows(rows, name), name) for name, rows in staged.items()}


def views(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_orders": models.stg_orders(raw["orders"]),
        "stg_customers": models.stg_customers(raw["customers"]),
        "stg_products": models.stg_products(raw["products"]),
    }


def fact(spark, sf, as_of: date | None = None):
    view = views(warehouse(spark, sf))
    orders = view["stg_orders"] if as_of is None else models.recent(view["stg_orders"], as_of)
    return models.fct_orders(orders, view["stg_customers"], view["stg_products"]).drop("loaded_at")


# --- ingest ----------------------------------------------------------------------------------

def _csv_round_trip(spark, sf, name: str, source: str) -> DataFrame:
    path = scratch_path(spark, f"csv-{source}")
    df = fixture(spark, sf, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return scan_csv(spark, path, SOURCE_SCHEMAS[source])


def csv_scan(spark, sf):
    return plain(_csv_round_trip(spark, sf, "csv_order_items", "order_items"))


def csv_scan_multiline(spark, sf):
    """Line breaks inside quoted cells."""
    path = scratch_path(spark, "csv-lines")
    cities = fixture(spark, sf, "csv_customers").withColumn("customer_city", F.replace("customer_city", F.lit(" "), F.lit("\n")))
    cities.write.option("header", True).option("escape", '"').csv(path)
    return plain(scan_csv(spark, path, SOURCE_SCHEMAS["customers"], multiline=True))


def csv_scan_text(spark, sf):
    return plain(_csv_round_trip(spark, sf, "csv_customers", "customers"))


def quarantine_faults(spark, sf):
    """What is set aside of orders and items written with unreadable times and prices, open quotes and missing keys."""
    folder = scratch_path(spark, "faulty-files")
    number = F.col("order_id").cast("bigint")
    orders = fixture(spark, sf, "csv_orders").withColumn(
        "order_status", F.when(number % 157 == 0, F.lit("on\nhold")).otherwise(F.col("order_status"))
    ).withColumn("order_id", F.when(number % 151 != 0, F.col("order_id")))
    items = fixture(spark, sf, "csv_order_items").withColumn(
        "price", F.when(number % 149 == 0, F.lit("free")).otherwise(F.col("price").cast("string")))
    files = {"orders": "orders", "order_items": "items"}
    found = []
    for name, rows in (("orders", orders), ("order_items", items)):
        rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{files[name]}")
        _, rejected = checked_source(
            spark, f"{folder}/{files[name]}", SOURCE_SCHEMAS[name], f"{folder}/checked-{name}",
            jobs.SOURCE_KEYS[name], jobs.SOURCE_TIMES.get(name, ()))
        found.append(rejected.select(F.lit(name).alias("source"), "column_name", "value", "reason"))
    return found[0].unionByName(found[1])


def customers_dedup(spark, sf):
    rows = ingest.dedupe_people(fixture(spark, sf, "csv_customers"), ["customer_id"])
    return rows.select("customer_unique_id", "customer_id", "customer_city")


def customers_build(spark, sf):
    return plain(built_customers(spark, sf).drop("created_at"))


def median_price(spark, sf):
    return plain(exact_median(fixture(spark, sf, "csv_order_items"), "product_id", "price", "median_price"))


def products_build(spark, sf):
    return plain(built_products(spark, sf).drop("created_at"))


def order_items_agg(spark, sf):
    return plain(ingest.order_lines(fixture(spark, sf, "csv_order_items")))


def customer_id_map(spark, sf):
    orders = fixture(spark, sf, "csv_orders").select("order_id", "customer_id")
    people = ingest.customer_people(fixture(spark, sf, "csv_customers"))
    return orders.join(people, "customer_id", "left").select(
        "order_id", F.coalesce("customer_unique_id", "customer_id").alias("customer_id")
    )


def orders_build(spark, sf):
    return plain(built_orders(spark, sf))


def status_map(spark, sf):
    return fixture(spark, sf, "csv_orders").select(
        "order_id", "order_status", order_status(F.col("order_status")).alias("status")
    )


def category_map(spark, sf):
    english = F.col("product_category_name_english")
    return (
        fixture(spark, sf, "csv_products")
        .join(fixture(spark, sf, "csv_translation"), "product_category_name", "left")
        .select("product_id", english.alias("eng_name"), category_group(english).alias("category"))
    )


def title_case(spark, sf):
    return fixture(spark, sf, "csv_customers").select(
        "customer_id", title_words(F.col("customer_city")).alias("city")
    )


def derive_age(spark, sf):
    return fixture(spark, sf, "csv_customers").select(
        "customer_id", derived_age(F.col("customer_unique_id"), SEED).alias("age")
    )


def parse_timestamp(spark, sf):
    return plain(fixture(spark, sf, "csv_orders").select(
        "order_id", timestamp_or(F.col("order_purchase_timestamp"), NOW).alias("created_at")
    ))


# --- daily batch -----------------------------------------------------------------------------

def daily_orders(spark, sf):
    return plain(ingest.build_orders(
        fixture(spark, sf, "csv_orders"), fixture(spark, sf, "csv_order_items"),
        fixture(spark, sf, "csv_customers"), NOW, only_day=RUN_DATE,
    ))


def daily_head(spark, sf):
    return plain(head_rows(day_rows(built_orders(spark, sf), RUN_DATE), HEAD, ingest.LINE_KEY))


def daily_head_large(spark, sf):
    return plain(head_rows(built_orders(spark, sf), LARGE, ingest.LINE_KEY))


def daily_topup_large(spark, sf):
    return plain(top_up(built_orders(spark, sf), RUN_DATE, LARGE, SEED, ingest.LINE_KEY))


def daily_topup(spark, sf):
    return plain(top_up(built_orders(spark, sf), RUN_DATE, BATCH, SEED, ingest.LINE_KEY))


def daily_batch(spark, sf):
    return plain(batch(spark, sf))


def batch_customers(spark, sf):
    rows = ingest.batch_customers(built_customers(spark, sf), batch(spark, sf))
    return plain(rows.drop("created_at"))


def batch_products(spark, sf):
    rows = ingest.batch_products(built_products(spark, sf), batch(spark, sf))
    return plain(rows.drop("created_at"))


# --- staging ---------------------------------------------------------------------------------

def age_bands(spark, sf):
    return fixture(spark, sf, "raw_customers").select(
        "customer_id", "age", age_group(F.col("age")).alias("age_group")
    )


def validate_customers(spark, sf):
    return staged_customers(spark, sf).select("customer_id", "is_valid", "invalid_reason")


def validate_products(spark, sf):
    return staged_products(spark, sf).select("product_id", "is_valid", "invalid_reason")


def validate_orders(spark, sf):
    checked = staging.check_orders(
        *[fixture(spark, sf, f"raw_{t}") for t in ("orders", "customers", "products")]
    )
    return checked.select("order_id", "product_id", "is_valid", "invalid_reason")


def stage_customers(spark, sf):
    return plain(staged_customers(spark, sf))


def stage_products(spark, sf):
    return plain(staged_products(spark, sf))


def stage_orders(spark, sf):
    return plain(staged_orders(spark, sf))


def stage_first_per_order(spark, sf):
    """Staged into a table in two runs: one day first, then all days."""
    raw = [fixture(spark, sf, f"raw_{t}") for t in ("orders", "customers", "products")]
    path, layout = scratch_path(spark, "staged-orders"), Layout("order_date", "month")
    for day in (RUN_DATE, None):
        rows = staging.check_orders(*raw, run_date=day)
        insert_if_absent(rows, path, ["order_id"], ["product_id"], layout)
    return plain(read_table(spark, path, layout))


# --- table writes ----------------------------------------------------------------------------

def insert_if_absent_customers(spark, sf):
    """The first day's customers, then all of them with another city: known ones keep theirs."""
    rows = fixture(spark, sf, "raw_customers")
    path = scratch_path(spark, "insert-customers")
    first_day = rows.where(F.to_date("created_at") == F.lit(date(1995, 1, 1)))
    insert_if_absent(first_day, path, ["customer_id"], ["created_at"])
    insert_if_absent(rows.withColumn("city", F.lit("moved")), path, ["customer_id"], ["created_at"])
    return plain(read_table(spark, path))


def insert_if_absent_products(spark, sf):
    rows = fixture(spark, sf, "raw_products")
    path = scratch_path(spark, "insert-products")
    first_day = rows.where(F.to_date("created_at") == F.lit(date(1995, 1, 1)))
    insert_if_absent(first_day, path, ["product_id"], ["created_at"])
    insert_if_absent(rows.withColumn("category", F.lit("other")), path, ["product_id"], ["created_at"])
    return plain(read_table(spark, path))


def insert_if_absent_orders(spark, sf):
    """Completed lines, then all lines twice with changed quantities: of equal keys the first counts."""
    rows = fixture(spark, sf, "raw_orders").drop("created_at")
    path, layout = scratch_path(spark, "insert-orders"), Layout("order_date", "month")
    again = rows.withColumn("quantity", F.coalesce("quantity", F.lit(0)) + 10)
    later = rows.withColumn("quantity", F.coalesce("quantity", F.lit(0)) + 20)
    insert_if_absent(rows.where("status = 'completed'"), path, ingest.LINE_KEY, ["quantity"], layout)
    insert_if_absent(again.unionByName(later), path, ingest.LINE_KEY, ["quantity"], layout)
    return plain(read_table(spark, path, layout))


def _landed(spark, sf, table: str, staged: DataFrame, order_day: date | None = None) -> DataFrame:
    config = scratch_config(spark, f"landing-{table}")
    rows = landing.valid_rows(staged, table, order_day)
    path = landing.export_table(rows, config, table, RUN_DATE)
    # without valid rows no folder is written
    return plain(rows.limit(0) if path is None else spark.read.parquet(path))


def landing_orders(spark, sf):
    return _landed(spark, sf, "orders", staged_orders(spark, sf))


def landing_orders_day(spark, sf):
    return _landed(spark, sf, "orders", staged_orders(spark, sf), RUN_DATE)


def landing_customers(spark, sf):
    return _landed(spark, sf, "customers", staged_customers(spark, sf))


def landing_products(spark, sf):
    return _landed(spark, sf, "products", staged_products(spark, sf))


def _loaded(spark, sf, table: str, staged: DataFrame, **settings) -> DataFrame:
    """Landed once, loaded twice: the second load changes nothing."""
    config = scratch_config(spark, f"load-{table}", **settings)
    landing.export_table(landing.valid_rows(staged, table), config, table, RUN_DATE)
    for _ in range(2):
        landing.load_table(spark, config, table, RUN_DATE)
    return plain(read_table(spark, config.path("raw", table), landing.warehouse_layout(config, table)))


def load_orders(spark, sf):
    return _loaded(spark, sf, "orders", staged_orders(spark, sf))


def load_orders_day(spark, sf):
    """With a folder for each day, as a deployment has it."""
    return _loaded(spark, sf, "orders", staged_orders(spark, sf), partition_by="day")


def load_customers(spark, sf):
    return _loaded(spark, sf, "customers", staged_customers(spark, sf))


def load_products(spark, sf):
    return _loaded(spark, sf, "products", staged_products(spark, sf))


def row_counts(spark, sf):
    """Row counts that the writes of the staged tables observe on the way."""
    staged = {"customers": staged_customers, "products": staged_products, "orders": staged_orders}
    counts = [
        (name, append_table(rows(spark, sf), scratch_path(spark, f"counted-{name}")))
        for name, rows in staged.items()
    ]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


# --- models ----------------------------------------------------------------------------------

def stg_customers(spark, sf):
    return plain(views(warehouse(spark, sf))["stg_customers"])


def stg_orders(spark, sf):
    return plain(views(warehouse(spark, sf))["stg_orders"])


def stg_products(spark, sf):
    return plain(views(warehouse(spark, sf))["stg_products"])


def fct_orders(spark, sf):
    return plain(fact(spark, sf))


def fct_orders_incremental(spark, sf):
    """From stored tables, as the job does: only the look-back's folders of the orders are read."""
    raw = warehouse(spark, sf)
    path, layout = scratch_path(spark, "raw-orders"), Layout("order_date", "month")
    append_table(raw["orders"], path, layout)
    first = date.fromordinal(AS_OF.toordinal() - models.values.DEFAULT_LOOKBACK_DAYS)
    orders = models.recent(models.stg_orders(rows_between(spark, path, layout, first, None)), AS_OF)
    view = {n: materialise(df, n) for n, df in views(raw).items() if n != "stg_orders"}
    return plain(models.fct_orders(orders, view["stg_customers"], view["stg_products"], few=True).drop("loaded_at"))


def fct_orders_late(spark, sf):
    """Orders of one month that arrive, and are loaded twice, after the fact was built from all others."""
    config = scratch_config(spark, "late", load_mode="append", increment="ledger")
    staged = _stored(
        {"orders": staged_orders(spark, sf), "customers": staged_customers(spark, sf), "products": staged_products(spark, sf)},
        "late-staged",
    )
    late = F.coalesce(F.trunc("order_date", "month") == F.lit(RUN_DATE.replace(day=1)), F.lit(False))
    for day, rows in ((RUN_DATE, staged["orders"].where(~late)), (AS_OF, staged["orders"].where(late))):
        side_by_side(config.threads, {
            table: partial(landing.export_table, landing.valid_rows(of_table, table), config, table, day)
            for table, of_table in {**staged, "orders": rows}.items()
        })
        for _ in range(2):
            jobs.load_day(spark, config, day)
        jobs.build_fact(spark, config, day)
    facts = read_table(spark, config.path("warehouse", "fct_orders"), jobs.fact_layout(config))
    return plain(facts.drop("loaded_at"))


def _merged(spark, sf, grain: str) -> DataFrame:
    """All facts but the cancelled ones of the last 60 days, then those days' facts merged twice.

    In the batch pending orders are completed one day later, and cancelled ones are new.
    """
    whole = materialise(fact(spark, sf), "merge-fact")
    path = scratch_path(spark, "merge-target")
    layout = Layout("order_date", grain, cluster_by=("status", "order_date"))
    recent = F.col("order_date") >= F.date_sub(F.lit(AS_OF), 60)
    held = ~(recent & (F.col("status") == "cancelled"))
    overwrite_table(whole.where(F.coalesce(held, F.lit(True))), path, layout)
    pending = F.col("status") == "pending"
    late = whole.where(recent).withColumns({
        "status": F.when(pending, "completed").otherwise(F.col("status")),
        "order_date": F.when(pending, F.date_add("order_date", 1)).otherwise(F.col("order_date")),
    })
    late = materialise(late, "merge-batch")  # as the job does: a merge reads its batch several times
    for _ in range(2):
        upsert(late, path, ["order_id"], layout)
    return plain(read_table(spark, path, layout))


def fct_orders_merge(spark, sf):
    return _merged(spark, sf, "month")


def fct_orders_merge_day(spark, sf):
    """With a folder for each day, as a deployment has it."""
    return _merged(spark, sf, "day")


def mart_daily_revenue(spark, sf):
    return plain(models.mart_daily_revenue(fact(spark, sf)))


def mart_product_performance(spark, sf):
    return plain(models.mart_product_performance(fact(spark, sf)))


def mart_customer_segments(spark, sf):
    return plain(models.mart_customer_segments(fact(spark, sf)))


def segment_customers_approx(spark, sf):
    """Customers of each city and age group over all days, from stored daily sketches, beside the exact number."""
    facts = materialise(fact(spark, sf), "sketch-fact")
    path, layout = scratch_path(spark, "sketches"), Layout("report_date", "month")
    overwrite_table(models.segment_sketches(facts), path, layout)
    about = models.segment_customers(read_table(spark, path, layout)).select(
        F.col("city").alias("c"), F.col("age_group").alias("a"), F.col("total_customers").alias("about"))
    exact = facts.groupBy("city", "age_group").agg(F.countDistinct("customer_id").alias("total_customers"))
    both = exact.join(about, F.col("city").eqNullSafe(F.col("c")) & F.col("age_group").eqNullSafe(F.col("a")), "left")
    # three standard errors of the sketch, and one customer where there are few
    near = F.abs(F.col("about") - F.col("total_customers")) <= 1 + 0.05 * F.col("total_customers")
    return both.select("city", "age_group", "total_customers", F.coalesce(near, F.lit(False)).alias("within_bound"))


def unmatched_orders(spark, sf):
    return models.unmatched_orders(fact(spark, sf))


# --- data tests ------------------------------------------------------------------------------

def dq_not_null(spark, sf):
    rows = quality.null_rows(fixture(spark, sf, "raw_orders"), "quantity")
    return rows.select("order_id", "product_id", "status")


def dq_unique(spark, sf):
    return quality.repeated_values(fixture(spark, sf, "raw_orders"), "order_id")


def dq_unique_days(spark, sf):
    """Repeated order ids as months arrive, one of them is replaced and all are checked after each step."""
    lines = materialise(fixture(spark, sf, "raw_orders"), "unique-lines")
    path, store, layout = scratch_path(spark, "unique"), scratch_path(spark, "unique-store"), Layout("order_date", "month")
    parts = [F.year("order_date") % 2 == 0, F.coalesce(F.year("order_date") % 2 != 0, F.lit(True))]
    for part in parts:
        append_table(lines.where(part), path, layout)
        found = repeated_values(spark, path, layout, "order_id", store, models.usable_order())
    again = materialise(lines.where(F.trunc("order_date", "month") == F.lit(RUN_DATE.replace(day=1))), "unique-month")
    for rows in (again.dropDuplicates(["order_id"]), again):
        replace_folders(rows, path, layout)
        found = repeated_values(spark, path, layout, "order_id", store, models.usable_order())
    return spark.createDataFrame([(found.values, found.kept)], "n_repeated bigint, n_repeated_usable bigint")


def dq_accepted_values(spark, sf):
    return quality.unlisted_values(
        fixture(spark, sf, "raw_orders"), "status", ("completed", "pending", "cancelled")
    )


def dq_report(spark, sf):
    """All tests over stored tables; the raw orders are the unchecked lines, so some tests fail."""
    lines = materialise(fixture(spark, sf, "raw_orders"), "dq-lines")
    raw = _stored(warehouse(spark, sf, lines), "dq")
    view = views(raw)
    facts = materialise(
        models.fct_orders(view["stg_orders"], view["stg_customers"], view["stg_products"]), "dq-fact"
    )

    def products() -> DataFrame:
        return materialise(models.ranked_products(materialise(models.product_days(facts), "dq-product-days")), "dq-products")

    marts = {name: partial(materialise, build(facts), f"dq-{name}") for name, build in models.MARTS.items()}
    tables = {
        "raw_orders": lines,
        "raw_customers": raw["customers"],
        "raw_products": raw["products"],
        **view,
        "fct_orders": facts,
        **side_by_side(len(marts), {**marts, "mart_product_performance": products}),
    }
    return quality.report(tables)


# --- whole jobs ------------------------------------------------------------------------------

def _sources(spark, sf) -> dict[str, DataFrame]:
    return _stored({name: fixture(spark, sf, f"csv_{name}") for name in jobs.SOURCES}, "source")


def run_two_days(spark, sf):
    """Two daily runs with top-up from the whole history; returns the product mart."""
    config = scratch_config(spark, "two-days", daily_orders=BATCH, seed=SEED)
    sources = _sources(spark, sf)
    for day in (RUN_DATE, NEXT_DATE):
        jobs.run_day(spark, config, day, NOW, sources=sources)
    mart = "mart_product_performance"
    return plain(read_table(spark, config.path("marts", mart), jobs.mart_layout(config, mart)))


def run_history(spark, sf):
    """One run over all history; returns the daily mart."""
    config = scratch_config(spark, "history", seed=SEED)
    jobs.run_history(spark, config, AS_OF, NOW, sources=_sources(spark, sf))
    mart = "mart_daily_revenue"
    return plain(read_table(spark, config.path("marts", mart), jobs.mart_layout(config, mart)))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_scan_text": csv_scan_text,
    "csv_scan_multiline": csv_scan_multiline,
    "quarantine_faults": quarantine_faults,
    "customers_dedup": customers_dedup,
    "customers_build": customers_build,
    "median_price": median_price,
    "products_build": products_build,
    "order_items_agg": order_items_agg,
    "customer_id_map": customer_id_map,
    "orders_build": orders_build,
    "status_map": status_map,
    "category_map": category_map,
    "title_case": title_case,
    "derive_age": derive_age,
    "parse_timestamp": parse_timestamp,
    "daily_orders": daily_orders,
    "daily_head": daily_head,
    "daily_topup": daily_topup,
    "daily_head_large": daily_head_large,
    "daily_topup_large": daily_topup_large,
    "daily_batch": daily_batch,
    "batch_customers": batch_customers,
    "batch_products": batch_products,
    "age_group": age_bands,
    "validate_customers": validate_customers,
    "validate_products": validate_products,
    "validate_orders": validate_orders,
    "stage_customers": stage_customers,
    "stage_products": stage_products,
    "stage_orders": stage_orders,
    "stage_first_per_order": stage_first_per_order,
    "insert_if_absent_customers": insert_if_absent_customers,
    "insert_if_absent_products": insert_if_absent_products,
    "insert_if_absent_orders": insert_if_absent_orders,
    "landing_orders": landing_orders,
    "landing_orders_day": landing_orders_day,
    "landing_customers": landing_customers,
    "landing_products": landing_products,
    "load_orders": load_orders,
    "load_orders_day": load_orders_day,
    "load_customers": load_customers,
    "load_products": load_products,
    "row_counts": row_counts,
    "stg_customers": stg_customers,
    "stg_orders": stg_orders,
    "stg_products": stg_products,
    "fct_orders": fct_orders,
    "fct_orders_incremental": fct_orders_incremental,
    "fct_orders_merge": fct_orders_merge,
    "fct_orders_merge_day": fct_orders_merge_day,
    "fct_orders_late": fct_orders_late,
    "mart_daily_revenue": mart_daily_revenue,
    "mart_product_performance": mart_product_performance,
    "mart_customer_segments": mart_customer_segments,
    "segment_customers_approx": segment_customers_approx,
    "unmatched_orders": unmatched_orders,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_unique_days": dq_unique_days,
    "dq_accepted_values": dq_accepted_values,
    "dq_report": dq_report,
    "run_two_days": run_two_days,
    "run_history": run_history,
}
