"""From source files to the three ingest tables: customers, products, order lines."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from merchmill import values
from merchmill.functions import (
    average, category_group, cents, day_of, derived_age, order_status, timestamp_or, title_words,
)
from merchmill.operators import exact_median, first_per_key, matching_keys
from merchmill.schemas import MONEY
from merchmill.sources.files import FILE_POSITION

CUSTOMER_COLUMNS = ["customer_id", "full_name", "email", "city", "age", "created_at"]
PRODUCT_COLUMNS = ["product_id", "name", "category", "cost_price", "sell_price", "created_at"]
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "quantity", "unit_price", "status", "created_at"]
LINE_KEY = ["order_id", "product_id"]
#: which row of a line key goes into the ingest table
ORDER_OF_EQUAL_LINES = ["created_at", "customer_id", "status"]


def _stamp(moment: datetime):
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp_ntz")


def _row_order(customers: DataFrame, otherwise: str) -> list[str]:
    return [FILE_POSITION] if FILE_POSITION in customers.columns else [otherwise]


def person_order(customers: DataFrame) -> list[str]:
    """Which of a person's rows comes first: file order where the scan kept it, else the per-order customer id."""
    return _row_order(customers, "customer_id")


def dedupe_people(customers: DataFrame, order_by: list[str]) -> DataFrame:
    """One row per person; the source has one customer row per order."""
    return first_per_key(customers, ["customer_unique_id"], order_by)


def build_customers(
    customers: DataFrame, now: datetime, seed: int = values.DEFAULT_SEED, order_by: list[str] | None = None
) -> DataFrame:
    """Customer table: one row per person, with name, email and age derived from the id.

    ``order_by`` says which of a person's rows comes first: by default file order where the scan kept
    it, else the per-order customer id.
    """
    return customer_rows(dedupe_people(customers, order_by or person_order(customers)), now, seed)


def customer_rows(people: DataFrame, now: datetime, seed: int = values.DEFAULT_SEED) -> DataFrame:
    """The customer table's rows of ``people``, one row per person."""
    person = F.col("customer_unique_id")
    return people.select(
        person.alias("customer_id"),
        F.concat(F.lit(values.NAME_PREFIX), F.upper(F.substring(person, 1, values.NAME_ID_CHARS))).alias("full_name"),
        F.concat(F.substring(person, 1, values.EMAIL_ID_CHARS), F.lit(values.EMAIL_SUFFIX)).alias("email"),
        F.coalesce(title_words(F.col("customer_city")), F.lit(values.UNKNOWN_TEXT)).alias("city"),
        derived_age(person, seed).alias("age"),
        _stamp(now).alias("created_at"),
    )


def build_products(products: DataFrame, items: DataFrame, translation: DataFrame, now: datetime) -> DataFrame:
    """Product table: only products that were sold, priced at their exact median."""
    return product_rows(products, exact_median(items, "product_id", "price", "median_price"), translation, now)


def product_rows(products: DataFrame, medians: DataFrame, translation: DataFrame, now: datetime) -> DataFrame:
    """The product table's rows of those products that have a ``median_price``.

    The translation is left without a broadcast hint: Spark broadcasts it when its size allows.
    """
    named = (
        products.select("product_id", "product_category_name")
        .join(medians, "product_id", "inner")
        .join(
            translation.select("product_category_name", F.col("product_category_name_english").alias("english")),
            "product_category_name",
            "left",
        )
    )
    sell = F.round("median_price", 2).cast(MONEY)
    readable = F.replace(F.coalesce("english", F.lit(values.UNKNOWN_TEXT)), F.lit("_"), F.lit(" "))
    return named.select(
        "product_id",
        title_words(readable).alias("name"),
        category_group(F.col("english")).alias("category"),
        F.round(sell * F.lit(Decimal(values.COST_SHARE)), 2).cast(MONEY).alias("cost_price"),
        sell.alias("sell_price"),
        _stamp(now).alias("created_at"),
    )


def order_lines(items: DataFrame) -> DataFrame:
    """One row per order and product: units sold and mean unit price. Items without a key are left out."""
    sold = items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
    return sold.groupBy(*LINE_KEY).agg(
        F.count(F.lit(1)).alias("quantity"),
        F.sum(cents(F.col("price"))).alias("_total"),
        F.count("price").alias("_priced"),
    ).select(*LINE_KEY, "quantity", average(F.col("_total"), F.col("_priced")).alias("unit_price"))


def customer_people(customers: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Per-order customer id -> person id."""
    order_by = order_by or _row_order(customers, "customer_unique_id")
    first = first_per_key(customers, ["customer_id"], order_by, for_join=True)
    return first.select("customer_id", "customer_unique_id")


def build_orders(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    now: datetime | None,
    time_pattern: str | None = None,
    only_day: date | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Order lines with person, shop status and time; ``order_date`` is added for partitioning.

    An unreadable time becomes ``now``, or stays NULL if that is None.
    ``only_day`` gives the lines of one day only. The day is then applied to the orders first and the
    items are cut down to those orders before they are aggregated.
    """
    heads = orders.select(
        "order_id",
        "customer_id",
        order_status(F.col("order_status")).alias("status"),
        timestamp_or(F.col("order_purchase_timestamp"), now, time_pattern).alias("created_at"),
    ).withColumn("order_date", day_of(F.col("created_at")))
    if only_day is not None:
        heads = heads.where(F.col("order_date") == F.lit(only_day))
        items = matching_keys(items, heads, ["order_id"])
        customers = matching_keys(customers, heads, ["customer_id"])
    people = customer_people(customers, order_by)
    return (
        order_lines(items)
        .join(heads, "order_id", "inner")
        .join(people, "customer_id", "left")
        .select(
            "order_id",
            F.coalesce("customer_unique_id", "customer_id").alias("customer_id"),
            "product_id", "quantity", "unit_price", "status", "created_at", "order_date",
        )
    )


def whole_history(
    orders: DataFrame, items: DataFrame, customers: DataFrame, now: datetime, order_by: list[str] | None = None
) -> DataFrame:
    """All order lines, one row per line key; of several rows of an order the first by time, person and status counts.

    These are the rows that an insert of ``build_orders`` keeps. Persons are joined and the first row is taken
    among the orders, which are fewer and narrower than the lines, so the lines meet one join only.
    """
    heads = orders.where(F.col("order_id").isNotNull()).select(
        "order_id",
        "customer_id",
        order_status(F.col("order_status")).alias("status"),
        timestamp_or(F.col("order_purchase_timestamp"), now).alias("created_at"),
    )
    named = heads.join(customer_people(customers, order_by), "customer_id", "left").select(
        "order_id", F.coalesce("customer_unique_id", "customer_id").alias("customer_id"), "status", "created_at",
    )
    first = first_per_key(named, ["order_id"], ORDER_OF_EQUAL_LINES, for_join=True)
    lines = order_lines(items).join(first, "order_id", "inner")
    return lines.withColumn("order_date", day_of(F.col("created_at"))).select(*ORDER_COLUMNS, "order_date")


def timed_lines(lines: DataFrame, now: datetime, keep: tuple[str, ...] = ()) -> DataFrame:
    """Stored order lines, those without a time at ``now``."""
    made = F.coalesce(F.col("created_at"), _stamp(now))
    return lines.withColumns({"created_at": made, "order_date": day_of(made)}).select(*ORDER_COLUMNS, "order_date", *keep)


def batch_customers(customers: DataFrame, batch: DataFrame) -> DataFrame:
    return matching_keys(customers, batch, ["customer_id"])


def batch_products(products: DataFrame, batch: DataFrame) -> DataFrame:
    return matching_keys(products, batch, ["product_id"])
