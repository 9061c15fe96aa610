"""Shop tables derived from the TPC-H-like test tables, as SQL that Spark and DuckDB both run.

Every row of the test tables is used. Faults (missing names, unknown products, bad times and so on)
are planted by CASE on the key, so no row is left out. Money is in whole cents here.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from merchmill.functions import from_cents

RUN_DATE = date(1995, 7, 12)
NEXT_DATE = date(1995, 7, 13)
AS_OF = date(2001, 8, 1)
NOW = datetime(2001, 8, 1)
SEED = 42

DRIVER_TABLES = ("customer", "orders", "lineitem", "part", "nation")

#: name -> SQL; a name in braces is a test table
FIXTURES = {
    # one customer row per order, and people who move; some orders point to a customer row that does not exist
    "csv_customers": """
        SELECT CASE WHEN o_orderkey % 113 = 0 THEN concat('x', cast(o_orderkey AS varchar(20)))
                    ELSE cast(o_orderkey AS varchar(20)) END AS customer_id,
               md5(cast(o_custkey AS varchar(20))) AS customer_unique_id,
               CASE WHEN o_orderkey % 83 = 0 THEN NULL
                    WHEN o_orderkey % 7 = 0 THEN concat(lower(n_name), ' d''oeste-2nd são')
                    ELSE lower(n_name) END AS customer_city
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey""",
    "csv_orders": """
        SELECT cast(o_orderkey AS varchar(20)) AS order_id, cast(o_orderkey AS varchar(20)) AS customer_id,
               CASE WHEN o_orderstatus = 'F' THEN 'Delivered'
                    WHEN o_orderstatus = 'O' THEN CASE o_orderkey % 4 WHEN 0 THEN 'shipped' WHEN 1 THEN 'processing'
                                                                      WHEN 2 THEN 'approved' ELSE 'created' END
                    ELSE CASE o_orderkey % 5 WHEN 0 THEN 'canceled' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'mystery'
                                             WHEN 3 THEN 'INVOICED' ELSE NULL END END AS order_status,
               CASE WHEN o_orderkey % 127 = 0 THEN 'not-a-date' WHEN o_orderkey % 131 = 0 THEN NULL
                    ELSE cast(o_orderdate AS varchar(40)) END AS order_purchase_timestamp
        FROM {orders}""",
    "csv_order_items": """
        SELECT cast(l_orderkey AS varchar(20)) AS order_id,
               CASE WHEN l_partkey % 137 = 0 AND l_linenumber = 7 THEN NULL
                    ELSE cast(l_partkey AS varchar(20)) END AS product_id,
               CASE WHEN l_orderkey % 139 = 0 THEN NULL
                    ELSE cast(round(l_extendedprice * 100, 0) AS bigint) END AS price_cents
        FROM {lineitem}""",
    "csv_products": """
        SELECT cast(p_partkey AS varchar(20)) AS product_id,
               CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN concat(p_type, ' II')
                    ELSE p_type END AS product_category_name
        FROM {part}""",
    # a category without translation, one with capitals and a trailing blank, one outside the groups
    "csv_translation": """
        SELECT p_type AS product_category_name,
               CASE p_type WHEN 'ECONOMY' THEN 'electronics' WHEN 'SMALL' THEN 'fashion_shoes'
                           WHEN 'MEDIUM' THEN 'Food_Drink ' WHEN 'STANDARD' THEN 'books_technical'
                           WHEN 'PROMO' THEN 'no_such_group' ELSE NULL END AS eng_name
        FROM {part} GROUP BY p_type
        UNION ALL
        SELECT concat(p_type, ' II'),
               CASE p_type WHEN 'ECONOMY' THEN 'sports_leisure' WHEN 'SMALL' THEN 'health_beauty'
                           WHEN 'MEDIUM' THEN 'la_cuisine' ELSE 'bed_bath_table' END
        FROM {part} GROUP BY p_type""",
    # ids that orders do not find, blank and missing names, bad mail addresses, odd ages
    "raw_customers": """
        SELECT CASE WHEN c_custkey % 89 = 0 THEN concat('gone-', cast(c_custkey AS varchar(20)))
                    ELSE cast(c_custkey AS varchar(20)) END AS customer_id,
               CASE WHEN c_custkey % 71 = 0 THEN NULL WHEN c_custkey % 73 = 0 THEN '   '
                    ELSE concat('  ', lower(c_name), ' ') END AS full_name,
               CASE WHEN c_custkey % 61 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN 'no-at-sign'
                    ELSE concat(' ', upper(c_name), '@Example.COM ') END AS email,
               lower(n_name) AS city,
               CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE cast(10 + (c_custkey * 37) % 95 AS int) END AS age,
               cast('1995-01-01' AS date) + cast(c_custkey % 3 AS int) AS created_on
        FROM {customer} LEFT JOIN {nation} ON n_nationkey = c_nationkey""",
    "raw_products": """
        SELECT CASE WHEN p_partkey % 97 = 0 THEN concat('gone-', cast(p_partkey AS varchar(20)))
                    ELSE cast(p_partkey AS varchar(20)) END AS product_id,
               concat(' ', p_name) AS name, lower(p_type) AS category,
               cast(CASE WHEN p_partkey % 41 = 0 THEN -1 WHEN p_partkey % 43 = 0 THEN round(p_retailprice * 100, 0)
                         WHEN p_partkey % 47 = 0 THEN 2 * round(p_retailprice * 100, 0)
                         ELSE floor(55 * p_retailprice + 0.5) END AS bigint) AS cost_cents,
               cast(CASE WHEN p_partkey % 59 = 0 THEN 0 ELSE round(p_retailprice * 100, 0) END AS bigint) AS sell_cents,
               cast('1995-01-01' AS date) + cast(p_partkey % 3 AS int) AS created_on
        FROM {part}""",
    "raw_orders": """
        SELECT cast(l_orderkey AS varchar(20)) AS order_id, cast(o_custkey AS varchar(20)) AS customer_id,
               cast(l_partkey AS varchar(20)) AS product_id,
               cast(CASE WHEN l_orderkey % 83 = 0 THEN 0 WHEN l_orderkey % 101 = 0 THEN NULL ELSE q END
                    AS bigint) AS quantity,
               CASE WHEN l_partkey % 79 = 0 THEN 0 ELSE up END AS unit_cents,
               CASE WHEN l_orderkey % 103 = 0 THEN 'refunded' WHEN l_orderkey % 107 = 0 THEN NULL
                    WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending'
                    ELSE 'cancelled' END AS status,
               cast(o_orderdate AS date) AS order_date
        FROM (SELECT l_orderkey, l_partkey, count(*) AS q,
                     cast(max(round(l_extendedprice * 100, 0)) AS bigint) AS up
              FROM {lineitem} GROUP BY l_orderkey, l_partkey) AS i
        JOIN {orders} ON o_orderkey = l_orderkey""",
}

#: cents column of a fixture -> money column of the shop table
_MONEY_COLUMNS = {"price_cents": "price", "unit_cents": "unit_price", "cost_cents": "cost_price",
                  "sell_cents": "sell_price"}


@lru_cache(maxsize=64)
def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Only the lazy plan is kept, so its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shop table as the library expects it: money as decimals, times as wall-clock times."""
    sql = FIXTURES[name]
    used = {t: driver_table(spark, sf_dir, t) for t in DRIVER_TABLES if "{" + t + "}" in sql}
    if name == "raw_orders":
        # by order before the grouping: it and the join with the orders then need no shuffle of the lines of their own,
        # and the lines of an order stay together for what follows
        used["lineitem"] = used["lineitem"].repartition("l_orderkey")
    df = spark.sql(sql, **used)
    for column in df.columns:
        if column in _MONEY_COLUMNS:
            df = df.withColumn(column, from_cents(F.col(column))).withColumnRenamed(column, _MONEY_COLUMNS[column])
    if "created_on" in df.columns:
        df = df.withColumn("created_at", F.col("created_on").cast("timestamp_ntz")).drop("created_on")
    if name == "raw_orders":
        df = df.withColumn("created_at", F.col("order_date").cast("timestamp_ntz"))
    if name == "csv_translation":
        df = df.withColumnRenamed("eng_name", "product_category_name_english")
    return df
