"""Validation: clean the ingest tables and flag rows instead of dropping them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from merchmill import values
from merchmill.functions import age_group, cents, percent
from merchmill.operators import first_failed, first_per_key, known_keys, matching_keys
from merchmill.schemas import MONEY


def _of_day(raw: DataFrame, run_date: date | None) -> DataFrame:
    """Rows created on a day; ``None`` stages the whole history in one go."""
    if run_date is None:
        return raw
    day = F.col("order_date") if "order_date" in raw.columns else F.to_date("created_at")
    return raw.where(day == F.lit(run_date))


def _flagged(rows: DataFrame) -> DataFrame:
    """Put ``is_valid`` in front of ``invalid_reason``."""
    columns = [c for c in rows.columns if c != "invalid_reason"]
    return rows.select(*columns, F.col("invalid_reason").isNull().alias("is_valid"), "invalid_reason")


def customer_problem(full_name: Column, email: Column, age: Column) -> Column:
    return first_failed([
        (full_name.isNull() | (F.trim(full_name) == ""), values.REASON_NAME),
        (~email.like("%@%"), values.REASON_EMAIL),
        ((age < values.AGE_MIN) | (age > values.AGE_MAX), values.REASON_AGE),
    ])


def product_problem(cost: Column, sell: Column) -> Column:
    return first_failed([
        (cost <= 0, values.REASON_COST),
        (sell <= 0, values.REASON_SELL),
        (sell < cost, values.REASON_BELOW_COST),
    ])


def order_problem(
    quantity: Column, unit_price: Column, status: Column, no_customer: Column, no_product: Column
) -> Column:
    return first_failed([
        (quantity <= 0, values.REASON_QUANTITY),
        (unit_price <= 0, values.REASON_UNIT_PRICE),
        (~status.isin(*values.SHOP_STATUSES), values.REASON_STATUS),
        (no_customer, values.REASON_NO_CUSTOMER),
        (no_product, values.REASON_NO_PRODUCT),
    ])


def stage_customers(raw_customers: DataFrame, run_date: date | None = None) -> DataFrame:
    name, email, age = F.col("full_name"), F.col("email"), F.col("age")
    return _flagged(_of_day(raw_customers, run_date).select(
        "customer_id",
        F.trim(name).alias("full_name"),
        F.lower(F.trim(email)).alias("email"),
        "city",
        "age",
        age_group(age).alias("age_group"),
        customer_problem(name, email, age).alias("invalid_reason"),
    ))


def stage_products(raw_products: DataFrame, run_date: date | None = None) -> DataFrame:
    cost, sell = F.col("cost_price"), F.col("sell_price")
    return _flagged(_of_day(raw_products, run_date).select(
        "product_id",
        F.trim("name").alias("name"),
        "category",
        "cost_price",
        "sell_price",
        percent(cents(sell - cost), cents(sell)).alias("margin_pct"),
        product_problem(cost, sell).alias("invalid_reason"),
    ))


def check_orders(
    raw_orders: DataFrame, raw_customers: DataFrame, raw_products: DataFrame, run_date: date | None = None,
    few: bool = False,
) -> DataFrame:
    """Order lines with amount, date and verdict, one output row per input row.

    References are looked up among all ingested customers and products of any day, valid or not. ``few``
    says that the lines are those of some days: the tables looked up are then cut to the lines' keys first,
    so they are scanned but not shuffled.
    """
    day = F.col("order_date") if "order_date" in raw_orders.columns else F.to_date("created_at")
    raw_orders = _of_day(raw_orders, run_date)
    if few:
        raw_customers = matching_keys(raw_customers.select("customer_id"), raw_orders, ["customer_id"])
        raw_products = matching_keys(raw_products.select("product_id"), raw_orders, ["product_id"])
    lines = (
        raw_orders
        .withColumn("order_date", day)
        .join(known_keys(raw_customers, "customer_id", "_customer"), "customer_id", "left")
        .join(known_keys(raw_products, "product_id", "_product"), "product_id", "left")
    )
    quantity, price = F.col("quantity"), F.col("unit_price")
    return _flagged(lines.select(
        "order_id", "customer_id", "product_id", "quantity", "unit_price",
        (quantity * price).cast(MONEY).alias("total_amount"),
        "status",
        "order_date",
        order_problem(
            quantity, price, F.col("status"), F.col("_customer").isNull(), F.col("_product").isNull()
        ).alias("invalid_reason"),
    ))


def stage_orders(
    raw_orders: DataFrame,
    raw_customers: DataFrame,
    raw_products: DataFrame,
    run_date: date | None = None,
    key: Sequence[str] = ("order_id",),
    few: bool = False,
) -> DataFrame:
    """Checked order lines, one per ``key``: of an order's lines the lowest product id is kept.

    The line is chosen before the lookups, so they run on the kept lines only.
    """
    lines = first_per_key(_of_day(raw_orders, run_date), key, ["product_id", "created_at"])
    return check_orders(lines, raw_customers, raw_products, few=few)
