"""Warehouse models: staging views, the order fact, and three marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from merchmill import values
from merchmill.functions import average, cents, from_cents, initcap_words, percent, trim_blank
from merchmill.operators import matching_keys, rank_descending
from merchmill.schemas import MONEY

#: a sketch of customers has 2^12 registers: a standard error of about 1.6 %
SKETCH_BITS = 12

FACT_COLUMNS = [
    "order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price", "total_amount",
    "cost_amount", "profit", "status", "city", "age_group", "category", "product_name", "loaded_at",
]


# --- staging views ---------------------------------------------------------------------------

def stg_customers(raw: DataFrame) -> DataFrame:
    usable = (
        F.col("customer_id").isNotNull()
        & F.col("email").like("%@%")
        & F.col("age").between(values.AGE_MIN, values.AGE_MAX)
    )
    return raw.where(usable).select(
        "customer_id",
        initcap_words(trim_blank(F.col("full_name"))).alias("full_name"),
        F.lower(trim_blank(F.col("email"))).alias("email"),
        "city", "age", "age_group",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    usable = (
        F.col("product_id").isNotNull()
        & (F.col("cost_price") > 0)
        & (F.col("sell_price") > F.col("cost_price"))
    )
    return raw.where(usable).select(
        "product_id",
        trim_blank(F.col("name")).alias("name"),
        "category",
        *[F.col(c).cast(MONEY).alias(c) for c in ("cost_price", "sell_price", "margin_pct")],
    )


def usable_order() -> Column:
    """Which raw order lines the staging view keeps."""
    return F.col("order_id").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.where(usable_order()).select(
        "order_id", "customer_id", "product_id", "quantity",
        *[F.col(c).cast(MONEY).alias(c) for c in ("unit_price", "total_amount")],
        F.lower("status").alias("status"),
        "order_date",
    )


# --- fact ------------------------------------------------------------------------------------

def recent(orders: DataFrame, as_of: date, lookback_days: int = values.DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Orders of the look-back window. On a day-partitioned table only those folders are read."""
    return orders.where(F.col("order_date") >= F.date_sub(F.lit(as_of), lookback_days))


def fct_orders(orders: DataFrame, customers: DataFrame, products: DataFrame, few: bool = False) -> DataFrame:
    """Orders with city, age group, product and profit. Orders without a match stay, with NULLs.

    No join hint: Spark broadcasts a dimension when its size allows, and splits hot customers or
    products of the order side when it does not. ``few`` says that the orders are those of some days: the
    dimensions are then cut to the orders' keys first, so they are scanned but not shuffled.
    """
    if few:
        customers = matching_keys(customers, orders, ["customer_id"])
        products = matching_keys(products, orders, ["product_id"])
    buyers = customers.select("customer_id", "city", "age_group")
    goods = products.select("product_id", "category", F.col("name").alias("product_name"), "cost_price")
    cost = (F.col("cost_price") * F.col("quantity")).cast(MONEY)
    return (
        orders.join(buyers, "customer_id", "left")
        .join(goods, "product_id", "left")
        .withColumns({"cost_amount": cost, "profit": (F.col("total_amount") - cost).cast(MONEY)})
        .withColumn("loaded_at", F.current_timestamp())
        .select(*FACT_COLUMNS)
    )


# --- marts -----------------------------------------------------------------------------------

def _completed() -> Column:
    return F.col("status") == F.lit("completed")


def _in_cents(fact: DataFrame) -> DataFrame:
    """Facts with the two summed amounts as whole cents, converted once per row."""
    return fact.withColumns({"_total": cents(F.col("total_amount")), "_profit": cents(F.col("profit"))})


def _completed_sum(column: str) -> Column:
    return F.sum(F.when(_completed(), F.col(column)).otherwise(F.lit(0)))


def _completed_mean(column: str) -> Column:
    earned = F.when(_completed(), F.col(column))
    return average(F.sum(earned), F.count(earned))


def mart_daily_revenue(fact: DataFrame) -> DataFrame:
    """One row per day. Order counts and gross revenue cover every status."""
    days = _in_cents(fact).groupBy(F.col("order_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        *[
            F.count_if(F.col("status") == status).alias(f"{status}_orders")
            for status in ("completed", "cancelled", "pending")
        ],
        F.sum("_total").alias("_gross"),
        _completed_sum("_total").alias("_net"),
        _completed_sum("_profit").alias("_gain"),
        _completed_mean("_total").alias("avg_order_value"),
    )
    return days.select(
        "report_date", "total_orders", "completed_orders", "cancelled_orders", "pending_orders",
        from_cents(F.col("_gross")).alias("gross_revenue"),
        from_cents(F.col("_net")).alias("net_revenue"),
        from_cents(F.col("_gain")).alias("total_profit"),
        percent(F.col("cancelled_orders"), F.col("total_orders")).alias("cancel_rate"),
        "avg_order_value",
        percent(F.col("_gain"), F.col("_net")).alias("profit_margin_pct"),
    )


def product_days(fact: DataFrame) -> DataFrame:
    """Sales per day and product, not ranked yet."""
    sales = _in_cents(fact).groupBy(
        F.col("order_date").alias("report_date"), "product_id", "product_name", "category"
    ).agg(
        F.sum("quantity").alias("units_sold"),
        _completed_sum("_total").alias("_net"),
        _completed_sum("_profit").alias("_gain"),
    )
    return sales.select(
        "report_date", "product_id", "product_name", "category", "units_sold",
        from_cents(F.col("_net")).alias("revenue"),
        from_cents(F.col("_gain")).alias("profit"),
        percent(F.col("_gain"), F.col("_net")).alias("profit_margin_pct"),
    )


def mart_product_performance(fact: DataFrame) -> DataFrame:
    """Sales per day and product with the product's revenue rank of the day; only a plan, nothing runs.

    Ranking reads the aggregate twice. A job stores it first and calls ``ranked_products``.
    """
    return ranked_products(product_days(fact))


def ranked_products(sales: DataFrame) -> DataFrame:
    """``product_days`` with each product's revenue rank of the day. A busy day is ranked by many tasks."""
    return rank_descending(sales, "report_date", "revenue", "revenue_rank")


def mart_customer_segments(fact: DataFrame, approximate: bool = False) -> DataFrame:
    """Sales per day, city and age group; customers that are not known form the NULL segments.

    ``approximate`` counts customers by a sketch of bounded size, within some 5 %, instead of shuffling each one.
    """
    customers = F.approx_count_distinct("customer_id") if approximate else F.countDistinct("customer_id")
    return _in_cents(fact).groupBy(F.col("order_date").alias("report_date"), "city", "age_group").agg(
        customers.alias("total_customers"),
        F.count("order_id").alias("total_orders"),
        _completed_mean("_total").alias("avg_order_value"),
        from_cents(_completed_sum("_total")).alias("total_revenue"),
        from_cents(_completed_sum("_profit")).alias("total_profit"),
    )


def segment_sketches(fact: DataFrame) -> DataFrame:
    """A sketch of the customers of each day, city and age group, of a few kilobytes at most.

    Distinct counts of days can't be added up, as customers come back; sketches can be merged. Stored by day,
    they give the customers of any stretch of days without the facts.
    """
    return fact.groupBy(F.col("order_date").alias("report_date"), "city", "age_group").agg(
        F.hll_sketch_agg("customer_id", F.lit(SKETCH_BITS)).alias("customers"))


def segment_customers(sketches: DataFrame) -> DataFrame:
    """About how many different customers each city and age group has over all days of ``sketches``."""
    merged = sketches.groupBy("city", "age_group").agg(F.hll_union_agg("customers").alias("customers"))
    return merged.select("city", "age_group", F.hll_sketch_estimate("customers").alias("total_customers"))


def unmatched_orders(fact: DataFrame) -> DataFrame:
    """How many facts have no product or no customer, and so no profit or segment."""
    return fact.agg(
        F.count_if(F.col("cost_amount").isNull()).alias("no_product"),
        F.count_if(F.col("city").isNull() & F.col("age_group").isNull()).alias("no_customer"),
    )


MARTS = {
    "mart_daily_revenue": mart_daily_revenue,
    "mart_product_performance": mart_product_performance,
    "mart_customer_segments": mart_customer_segments,
}
