"""The daily job and its steps, each a plain function that can be run again for the same day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from merchmill.config import ShopConfig
from merchmill.operators import head_rows
from merchmill.plans import ingest, models, quality, staging
from merchmill.plans.history import (
    History, day_lines, drawn_lines, median_prices, people, stored_history,
)
from merchmill.plans.uniqueness import repeated_values
from merchmill.schemas import SOURCE_SCHEMAS
from merchmill.sources import landing
from merchmill.sources.files import FILE_POSITION, check_sources, scan_source, source_path
from merchmill.sources.ledger import Entry
from merchmill.sources.quarantine import checked_source
from merchmill.sources.storage import delete, has_data, materialise, own_scratch, read_text, side_by_side, write_text
from merchmill.sources.tables import (
    PLAIN, Layout, folder_path, insert_if_absent, note_folders, noted_folders, overwrite_table, read_table,
    replace_folders, rows_between, table_exists, upsert,
)

TABLES = ("orders", "customers", "products")
SOURCES = ("customers", "orders", "order_items", "products", "translation")
MART_CLUSTERS = {
    "mart_daily_revenue": (),
    "mart_product_performance": ("category",),
    "mart_customer_segments": ("city", "age_group"),
}


# --- layouts ---------------------------------------------------------------------------------

def order_layout(config: ShopConfig) -> Layout:
    return Layout("order_date", config.partition_by)


def fact_layout(config: ShopConfig) -> Layout:
    return Layout("order_date", config.partition_by, cluster_by=("status", "order_date"))


def mart_layout(config: ShopConfig, mart: str) -> Layout:
    return Layout("report_date", config.partition_by, cluster_by=MART_CLUSTERS[mart])


# --- ingest ----------------------------------------------------------------------------------

#: columns that a row of a source file can't do without, and those that hold times
SOURCE_KEYS = {
    "customers": ("customer_id", "customer_unique_id"), "orders": ("order_id",), "order_items": ("order_id", "product_id"),
    "products": ("product_id",), "translation": ("product_category_name",),
}
SOURCE_TIMES = {"orders": ("order_purchase_timestamp",)}


def read_sources(spark: SparkSession, config: ShopConfig) -> dict[str, DataFrame]:
    """The source files; with ``config.quarantine`` those rows of them that can be used, see ``quarantined``."""
    check_sources(spark, config)
    if config.quarantine:
        return {name: _checked(spark, config, name)[0] for name in SOURCES}
    return {name: scan_source(spark, config, name) for name in SOURCES}


def _checked(spark: SparkSession, config: ShopConfig, name: str) -> tuple[DataFrame, DataFrame]:
    rows, faults = checked_source(spark, source_path(config, name), SOURCE_SCHEMAS[name], config.path("checked", name),
                                  SOURCE_KEYS[name], SOURCE_TIMES.get(name, ()))
    return (rows if name == "customers" else rows.drop(FILE_POSITION)), faults


def quarantined(spark: SparkSession, config: ShopConfig) -> DataFrame:
    """What was set aside of all source files: source, file, split, line, column_name, value, reason."""
    found = [_checked(spark, config, name)[1].select(F.lit(name).alias("source"), "*") for name in SOURCES]
    return reduce(DataFrame.unionByName, found)


def insert_raw(
    config: ShopConfig, customers: DataFrame, products: DataFrame, orders: DataFrame, lines_once: bool = False
) -> dict[str, int]:
    """Add new customers, products and order lines to the ingest tables; known keys are left as they are.

    ``lines_once`` says that ``orders`` holds each line key once.
    """
    return side_by_side(config.threads, {
        # the customer build already keeps one row per id
        "customers": partial(
            insert_if_absent, customers.select(*ingest.CUSTOMER_COLUMNS), config.path("ingest", "customers"),
            ["customer_id"], None,
        ),
        "products": partial(
            insert_if_absent, products.select(*ingest.PRODUCT_COLUMNS), config.path("ingest", "products"),
            ["product_id"], ["name", "category"],
        ),
        "orders": partial(
            insert_if_absent, orders.select(*ingest.ORDER_COLUMNS, "order_date"), config.path("ingest", "orders"),
            ingest.LINE_KEY, None if lines_once else ingest.ORDER_OF_EQUAL_LINES, order_layout(config),
        ),
    })


def seed_history(
    spark: SparkSession, config: ShopConfig, now: datetime, sources: dict[str, DataFrame] | None = None
) -> dict[str, int]:
    """Ingest everything the source files hold. Meant to run once, and harmless when repeated.

    All of it is read once, so it comes from the source files; the store that days read is left to the first day.
    """
    src = sources or read_sources(spark, config)
    return insert_raw(
        config,
        ingest.build_customers(src["customers"], now, config.seed),
        ingest.build_products(src["products"], src["order_items"], src["translation"], now),
        ingest.whole_history(src["orders"], src["order_items"], src["customers"], now),
        lines_once=True,
    )


def select_day(spark: SparkSession, config: ShopConfig, history: History, run_date: date, now: datetime) -> DataFrame:
    """Order lines of one day, capped and topped up to ``config.daily_orders``.

    A day reads its own folder, and a top-up the first folders of the draw.
    """
    own = materialise(day_lines(spark, config, history, run_date, now), "day-orders")
    limit = config.daily_orders
    if limit is None:
        return own
    missing = limit - own.count()
    if missing <= 0:
        return materialise(head_rows(own, limit, ingest.LINE_KEY), "day-batch")
    return materialise(own.unionByName(drawn_lines(spark, history, run_date, now, missing)), "day-batch")


def ingest_day(
    spark: SparkSession, config: ShopConfig, run_date: date, now: datetime,
    sources: dict[str, DataFrame] | None = None,
) -> dict[str, int]:
    """Ingest one day's batch with the customers and products it mentions.

    The history is built once for its sources. Persons and prices are read from the buckets that hold the
    batch's; of the source files only the products are scanned.
    """
    src = sources or read_sources(spark, config)
    history = stored_history(spark, config, src)
    batch = select_day(spark, config, history, run_date, now)
    persons = batch.select(F.col("customer_id").alias("customer_unique_id"))
    goods = ingest.product_rows(
        ingest.batch_products(src["products"], batch), median_prices(spark, history, batch), src["translation"], now
    )
    return insert_raw(config, ingest.customer_rows(people(spark, history, persons), now, config.seed), goods, batch)


# --- staging, landing, load ------------------------------------------------------------------

def stage_day(spark: SparkSession, config: ShopConfig, run_date: date | None, stamped: date | None = None) -> dict[str, int]:
    """Validate what was ingested for a day into the staged tables; ``None`` takes all days.

    Customers and products carry the time of the run that ingested them. ``stamped`` is that day when
    it is not ``run_date``, as in a back-dated run.
    """
    paths = {t: config.path("ingest", t) for t in TABLES}
    if not all(table_exists(spark, p) for p in paths.values()):
        return {}
    customers, products = (read_table(spark, paths[t]) for t in ("customers", "products"))
    layout = order_layout(config)
    orders = rows_between(spark, paths["orders"], layout, run_date, run_date)
    staged = {
        "customers": (staging.stage_customers(customers, stamped or run_date), ["customer_id"], PLAIN),
        "products": (staging.stage_products(products, stamped or run_date), ["product_id"], PLAIN),
        "orders": (
            staging.stage_orders(orders, customers, products, None, config.order_key, few=run_date is not None),
            config.order_key, layout,
        ),
    }
    # keys are unique here: ingest keeps one customer and product per id, and staging one line per order key
    return side_by_side(config.threads, {
        table: partial(insert_if_absent, rows, config.path("staged", table), keys, None, table_layout)
        for table, (rows, keys, table_layout) in staged.items()
    })


def export_day(spark: SparkSession, config: ShopConfig, run_date: date, whole_history: bool = False) -> dict[str, str]:
    """Write the valid staged rows to the landing zone; a table without any is left out.

    ``whole_history`` lands the orders of all days under ``run_date``, for a backfill.
    """
    day = None if whole_history else run_date

    def export(table: str) -> str | None:
        path = config.path("staged", table)
        if not table_exists(spark, path):
            return None
        staged = (
            rows_between(spark, path, order_layout(config), day, day) if table == "orders"
            else read_table(spark, path)
        )
        return landing.export_table(landing.valid_rows(staged, table), config, table, run_date)

    landed = side_by_side(config.threads, {t: partial(export, t) for t in TABLES})
    return {table: uri for table, uri in landed.items() if uri is not None}


def load_day(spark: SparkSession, config: ShopConfig, run_date: date) -> dict[str, int | None]:
    return side_by_side(config.threads, {t: partial(landing.load_table, spark, config, t, run_date) for t in TABLES})


# --- models ----------------------------------------------------------------------------------

def warehouse_views(spark: SparkSession, config: ShopConfig) -> dict[str, DataFrame]:
    """The warehouse tables as loaded, and the staging views over them."""
    raw = {
        t: read_table(spark, config.path("raw", t), landing.warehouse_layout(config, t), keep_folder=True)
        for t in TABLES
    }
    return {
        **{f"raw_{t}": df for t, df in raw.items()},
        "stg_orders": models.stg_orders(raw["orders"]),
        "stg_customers": models.stg_customers(raw["customers"]),
        "stg_products": models.stg_products(raw["products"]),
    }


def pending_path(config: ShopConfig) -> str:
    """List of the fact folders that have changed since the marts were last refreshed."""
    return config.path("warehouse", "fct_orders_pending")


def _loads_seen(spark: SparkSession, config: ShopConfig) -> int:
    """The number of the last load that the fact has taken in."""
    return int(read_text(spark, config.path("warehouse", "fct_orders_loads")) or 0)


def _new_orders(spark: SparkSession, config: ShopConfig, as_of: date, loads: Sequence[Entry]) -> DataFrame:
    """The raw orders that a build after the first one reads."""
    path, layout = config.path("raw", "orders"), landing.warehouse_layout(config, "orders")
    if config.increment == "lookback":
        first = date.fromordinal(as_of.toordinal() - config.lookback_days)
        return models.recent(models.stg_orders(rows_between(spark, path, layout, first, None)), as_of, config.lookback_days)
    days = {d for load in loads for d in load.days}
    rows = layout.in_folders(read_table(spark, path, layout, keep_folder=True), list({layout.folder_value(d) for d in days}))
    of_day = F.col("order_date").isin(*(d for d in days if d is not None)) if days - {None} else F.lit(False)
    rows = rows.where(F.coalesce(of_day, F.lit(None in days)))
    return models.stg_orders(rows if layout.folder == layout.date_column else rows.drop(layout.folder))


def build_fact(spark: SparkSession, config: ShopConfig, as_of: date, full_refresh: bool = False) -> Sequence[date | None] | None:
    """Bring the order fact up to date. Returns the folders written, None when it was built anew.

    After the first build only new orders are read and merged by key. With ``config.increment="lookback"`` these
    are the orders of the look-back window, and those that arrive later than that need ``full_refresh``; with
    "ledger" the orders of all days that any load since the last build was about.
    """
    path, layout = config.path("warehouse", "fct_orders"), fact_layout(config)
    views = warehouse_views(spark, config)
    loads = landing.load_ledger(spark, config).entries(after=_loads_seen(spark, config))
    if full_refresh or not table_exists(spark, path):
        fact = models.fct_orders(views["stg_orders"], views["stg_customers"], views["stg_products"])
        note_folders(spark, pending_path(config), [], whole=True)
        overwrite_table(fact, path, layout)
        folders = None
    else:
        new = _new_orders(spark, config, as_of, loads)
        fact = models.fct_orders(new, views["stg_customers"], views["stg_products"], few=True)
        folders = upsert(materialise(fact, "fact-batch"), path, config.order_key, layout, pending_path(config))
    if loads and (folders is None or config.increment == "ledger"):
        write_text(spark, config.path("warehouse", "fct_orders_loads"), str(loads[-1].number))
    return folders


def build_marts(spark: SparkSession, config: ShopConfig, folders: Sequence[date | None] | None = None) -> dict[str, int]:
    """Rebuild the marts, whole or for the given fact folders only.

    All marts are per day, so after a merge the days in the folders it wrote are the only ones that
    can differ; the result equals a full rebuild. Folders that an earlier, failed run wrote are on a stored
    list, which goes only after all marts are written.
    """
    fact_path, layout = config.path("warehouse", "fct_orders"), fact_layout(config)
    noted, whole = noted_folders(spark, pending_path(config))
    folders = None if whole or folders is None else list({*folders, *noted})

    def products(fact: DataFrame) -> DataFrame:
        return models.ranked_products(materialise(models.product_days(fact), "product-days"))

    def refresh(name: str) -> int:
        build, path, mart = models.MARTS[name], config.path("marts", name), mart_layout(config, name)
        build = products if name == "mart_product_performance" else build
        if folders is None or not table_exists(spark, path):
            return overwrite_table(build(read_table(spark, fact_path, layout)), path, mart)
        fact = layout.in_folders(read_table(spark, fact_path, layout, keep_folder=True), folders)
        written = replace_folders(build(fact), path, mart)
        for folder in folders:
            # a day that has no orders any more leaves the mart as well
            if not has_data(spark, folder_path(spark, fact_path, layout, folder)):
                delete(spark, folder_path(spark, path, mart, folder))
        return written

    written = side_by_side(config.threads, {name: partial(refresh, name) for name in models.MARTS})
    delete(spark, pending_path(config))
    return written


def model_tables(spark: SparkSession, config: ShopConfig) -> dict[str, DataFrame]:
    """Every table the data tests look at."""
    return {
        **warehouse_views(spark, config),
        "fct_orders": read_table(spark, config.path("warehouse", "fct_orders"), fact_layout(config)),
        **{m: read_table(spark, config.path("marts", m), mart_layout(config, m)) for m in models.MARTS},
    }


def unique_orders(spark: SparkSession, config: ShopConfig) -> dict[quality.ColumnTest, int]:
    """Repeated order ids of the dated tables; only what changed since the last run is read."""
    raw = repeated_values(spark, config.path("raw", "orders"), landing.warehouse_layout(config, "orders"), "order_id",
                          config.path("quality", "raw_orders"), kept=models.usable_order())
    fact = repeated_values(spark, config.path("warehouse", "fct_orders"), fact_layout(config), "order_id",
                           config.path("quality", "fct_orders"))
    counts = {"raw_orders": raw.values, "stg_orders": raw.kept, "fct_orders": fact.values}
    return {quality.ColumnTest(table, "order_id", quality.UNIQUE): n for table, n in counts.items()}


def test_models(spark: SparkSession, config: ShopConfig) -> list[dict]:
    # several lines may share an order under grain "line", so the order id alone is not a key there
    known = unique_orders(spark, config) if config.grain == "order" else {}
    tests = [t for t in quality.SHOP_TESTS if (t.column, t.kind) != ("order_id", quality.UNIQUE)]
    return quality.require_passed(quality.report(model_tables(spark, config), tests), known)


# --- whole runs ------------------------------------------------------------------------------

def run_day(
    spark: SparkSession, config: ShopConfig, run_date: date, now: datetime | None = None,
    sources: dict[str, DataFrame] | None = None, full_refresh: bool = False, whole_marts: bool = False,
) -> dict[str, object]:
    """One business day from source files to tested marts. Returns what each step did.

    ``now`` stamps new customers and products and stands in for unreadable order times; left out, it
    is the start of ``run_date``, so that a run for any day stages what it ingested.
    """
    now = now or datetime(run_date.year, run_date.month, run_date.day)
    with own_scratch(spark):
        done: dict[str, object] = {"ingested": ingest_day(spark, config, run_date, now, sources)}
        done["staged"] = stage_day(spark, config, run_date, stamped=now.date())
        return {**done, **_publish(spark, config, run_date, full_refresh, whole_marts)}


def run_history(
    spark: SparkSession, config: ShopConfig, run_date: date, now: datetime | None = None,
    sources: dict[str, DataFrame] | None = None,
) -> dict[str, object]:
    """Backfill: seed all history, then stage, land, load and model all of it in one run."""
    now = now or datetime(run_date.year, run_date.month, run_date.day)
    with own_scratch(spark):
        done: dict[str, object] = {"ingested": seed_history(spark, config, now, sources)}
        done["staged"] = stage_day(spark, config, None)
        return {**done, **_publish(spark, config, run_date, full_refresh=True, whole_marts=True, whole_history=True)}


def _publish(
    spark: SparkSession, config: ShopConfig, run_date: date, full_refresh: bool, whole_marts: bool,
    whole_history: bool = False,
) -> dict[str, object]:
    landed = export_day(spark, config, run_date, whole_history)
    loaded = load_day(spark, config, run_date)
    done: dict[str, object] = {"landed": landed, "loaded": loaded}
    if not all(table_exists(spark, config.path("raw", t)) for t in TABLES):
        return done
    folders = build_fact(spark, config, run_date, full_refresh)
    done["fact_folders"] = folders
    done["marts"] = build_marts(spark, config, None if whole_marts else folders)
    done["tests"] = test_models(spark, config)
    return done
