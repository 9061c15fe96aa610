"""Declared schemas: source files, and what the warehouse accepts from the landing zone."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

_STRING, _LONG, _INT, _DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


#: columns of the source files that any job reads; other columns in a file are skipped by name
SOURCE_SCHEMAS = {
    "customers": _schema(customer_id=_STRING, customer_unique_id=_STRING, customer_city=_STRING),
    "orders": _schema(
        order_id=_STRING, customer_id=_STRING, order_status=_STRING, order_purchase_timestamp=_STRING
    ),
    "order_items": _schema(order_id=_STRING, product_id=_STRING, price=MONEY),
    "products": _schema(product_id=_STRING, product_category_name=_STRING),
    "translation": _schema(product_category_name=_STRING, product_category_name_english=_STRING),
}

#: what the warehouse declares for each landed table; money enters as floating point and the
#: staging views turn it back into exact decimals
LOAD_SCHEMAS = {
    "orders": _schema(
        order_id=_STRING, customer_id=_STRING, product_id=_STRING, quantity=_LONG,
        unit_price=_DOUBLE, total_amount=_DOUBLE, status=_STRING, order_date=T.DateType(),
    ),
    "customers": _schema(
        customer_id=_STRING, full_name=_STRING, email=_STRING, city=_STRING, age=_INT, age_group=_STRING
    ),
    "products": _schema(
        product_id=_STRING, name=_STRING, category=_STRING, cost_price=_DOUBLE, sell_price=_DOUBLE,
        margin_pct=_DOUBLE,
    ),
}

#: columns a load must refuse to leave empty
REQUIRED_COLUMNS = {"orders": ("order_id",), "customers": ("customer_id",), "products": ("product_id",)}
