from datetime import date, datetime
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from merchmill import values
from merchmill.plans import ingest, models, quality, staging

NOW = datetime(2018, 9, 1, 12)
D1, D2 = date(2018, 1, 1), date(2018, 1, 2)


# --- ingest ----------------------------------------------------------------------------------

def test_customers_keep_the_first_row_of_a_person(spark):
    raw = spark.createDataFrame(
        [("c2", "abcdef0123456789", "rio"), ("c1", "abcdef0123456789", "santa rita d'oeste"), ("c3", "ffff", None)],
        "customer_id string, customer_unique_id string, customer_city string",
    )
    rows = {r.customer_id: r for r in ingest.build_customers(raw, NOW).collect()}
    one = rows["abcdef0123456789"]
    assert (one.full_name, one.email, one.city) == (
        "Customer ABCDEF01", "abcdef012345" + values.EMAIL_SUFFIX, "Santa Rita D'Oeste",
    )
    assert rows["ffff"].city == "Unknown" and one.created_at == NOW and 18 <= one.age <= 65


def test_products_are_priced_at_the_median(spark):
    products = spark.createDataFrame(
        [("p1", "livros"), ("p2", None), ("p3", "novo"), ("unsold", "livros")],
        "product_id string, product_category_name string",
    )
    items = spark.createDataFrame(
        [("p1", Dec("10.00")), ("p1", Dec("10.01")), ("p2", Dec("3.33")), ("p2", None), ("p3", Dec("1.00")),
         ("p3", Dec("5.00")), ("p3", Dec("9.99"))], "product_id string, price decimal(18,2)",
    )
    translation = spark.createDataFrame(
        [("livros", "books_technical")], "product_category_name string, product_category_name_english string"
    )
    got = {r.product_id: tuple(r)[1:5] for r in ingest.build_products(products, items, translation, NOW).collect()}
    assert got == {
        "p1": ("Books Technical", "Books", Dec("5.51"), Dec("10.01")),  # 10.005 and 5.5055, both away from zero
        "p2": ("Unknown", "Home & Living", Dec("1.83"), Dec("3.33")),
        "p3": ("Unknown", "Home & Living", Dec("2.75"), Dec("5.00")),
    }


def order_frames(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "DELIVERED", "2018-01-01 10:00:00"), ("o2", "c9", None, "bad"), ("o3", "c1", "canceled", None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string",
    )
    items = spark.createDataFrame(
        [("o1", "p1", Dec("10.00")), ("o1", "p1", Dec("10.01")), ("o1", "p2", None), ("o2", "p1", Dec("3.00")),
         ("o2", None, Dec("4.00")), (None, "p1", Dec("4.00")), ("gone", "p1", Dec("4.00"))],
        "order_id string, product_id string, price decimal(18,2)",
    )
    customers = spark.createDataFrame(
        [("c1", "u1", "rio")], "customer_id string, customer_unique_id string, customer_city string"
    )
    return orders, items, customers


def test_orders(spark):
    got = sorted(tuple(r) for r in ingest.build_orders(*order_frames(spark), NOW).collect())
    ten = datetime(2018, 1, 1, 10)
    assert got == [
        ("o1", "u1", "p1", 2, Dec("10.01"), "completed", ten, D1),
        ("o1", "u1", "p2", 1, None, "completed", ten, D1),
        ("o2", "c9", "p1", 1, Dec("3.00"), "pending", NOW, NOW.date()),
    ]


@pytest.mark.parametrize("day", [D1, NOW.date(), D2])
def test_orders_of_one_day_equal_the_filtered_whole(spark, day):
    frames = order_frames(spark)
    whole = ingest.build_orders(*frames, NOW).where(F.col("order_date") == F.lit(day))
    assert sorted(map(repr, ingest.build_orders(*frames, NOW, only_day=day).collect())) == sorted(
        map(repr, whole.collect())
    )


# --- staging ---------------------------------------------------------------------------------

def reasons(df, key):
    return {r[key]: (r.is_valid, r.invalid_reason) for r in df.collect()}


def test_customer_rules_in_order(spark):
    rows = [
        ("ok", " Ana ", " A@B.c ", 30), ("null name", None, "bad", 5), ("blank name", "  ", "a@b", 30),
        ("mail", "Ana", "bad", 5), ("young", "Ana", "a@b", 15), ("old", "Ana", "a@b", 101),
        ("edge16", "Ana", "a@b", 16), ("edge100", "Ana", "a@b", 100), ("nulls", "Ana", None, None), ("tab", "\t", "a@b", 20),
    ]
    raw = spark.createDataFrame(
        [(*r, "x", datetime(2018, 1, 1)) for r in rows],
        "customer_id string, full_name string, email string, age int, city string, created_at timestamp_ntz",
    )
    staged = staging.stage_customers(raw, D1)
    good = (True, None)
    assert reasons(staged, "customer_id") == {
        "ok": good, "null name": (False, values.REASON_NAME), "blank name": (False, values.REASON_NAME),
        "mail": (False, values.REASON_EMAIL), "young": (False, values.REASON_AGE), "old": (False, values.REASON_AGE),
        "edge16": good, "edge100": good, "nulls": good, "tab": good,
    }
    one = staged.where("customer_id = 'ok'").first()
    assert (one.full_name, one.email, one.age_group) == ("Ana", "a@b.c", "25-34")
    assert staged.columns == ["customer_id", "full_name", "email", "city", "age", "age_group", "is_valid", "invalid_reason"]
    assert staging.stage_customers(raw, D2).count() == 0


def test_product_rules_in_order(spark):
    rows = [("ok", "1.00", "3.00"), ("cost", "0.00", "0.00"), ("sell", "1.00", "0.00"), ("below", "3.00", "2.99"),
            ("even", "3.00", "3.00"), ("null cost", None, "2.00"), ("null sell", "1.00", None), ("minus", "1.00", "-3.00")]
    raw = spark.createDataFrame(
        [(k, " n ", "c", c and Dec(c), s and Dec(s), datetime(2018, 1, 1)) for k, c, s in rows],
        "product_id string, name string, category string, cost_price decimal(18,2), sell_price decimal(18,2), "
        "created_at timestamp_ntz",
    )
    staged = staging.stage_products(raw)
    good = (True, None)
    assert reasons(staged, "product_id") == {
        "ok": good, "cost": (False, values.REASON_COST), "sell": (False, values.REASON_SELL),
        "below": (False, values.REASON_BELOW_COST), "even": good, "null cost": good, "null sell": good,
        "minus": (False, values.REASON_SELL),
    }
    margins = {r.product_id: r.margin_pct for r in staged.collect()}
    assert margins == {"ok": Dec("66.67"), "cost": None, "sell": None, "below": Dec("-0.33"), "even": Dec("0.00"),
                       "null cost": None, "null sell": None, "minus": Dec("133.33")}


def raw_orders(spark, *rows):
    return spark.createDataFrame(
        [(o, c, p, q, None if u is None else Dec(u), s, datetime(2018, 1, 1, 9)) for o, c, p, q, u, s in rows],
        "order_id string, customer_id string, product_id string, quantity bigint, unit_price decimal(18,2), "
        "status string, created_at timestamp_ntz",
    )


def dimensions(spark):
    return (spark.createDataFrame([("c",), ("c",), (None,)], "customer_id string"),
            spark.createDataFrame([("p",), ("p2",)], "product_id string"))


def test_order_rules_in_order(spark):
    orders = raw_orders(
        spark, ("ok", "c", "p", 2, "1.50", "completed"), ("qty", "x", "x", 0, "0.00", "bad"),
        ("price", "x", "x", 1, "0.00", "bad"), ("status", "x", "x", 1, "1.00", "bad"),
        ("customer", "x", "x", 1, "1.00", "pending"), ("product", "c", "x", 1, "1.00", "pending"),
        ("null customer", None, "p", 1, "1.00", "pending"), ("nulls", "c", "p", None, None, None),
    )
    staged = staging.check_orders(orders, *dimensions(spark), run_date=D1)
    good = (True, None)
    assert reasons(staged, "order_id") == {
        "ok": good, "qty": (False, values.REASON_QUANTITY), "price": (False, values.REASON_UNIT_PRICE),
        "status": (False, values.REASON_STATUS), "customer": (False, values.REASON_NO_CUSTOMER),
        "product": (False, values.REASON_NO_PRODUCT), "null customer": (False, values.REASON_NO_CUSTOMER), "nulls": good,
    }
    one = staged.where("order_id = 'ok'").first()
    assert (one.total_amount, one.order_date) == (Dec("3.00"), D1)


def test_one_line_per_order_or_all_lines(spark):
    orders = raw_orders(spark, ("o", "c", "p2", 1, "1.00", "pending"), ("o", "c", "p", 0, "2.00", "pending"),
                        ("q", "c", "p2", 1, "1.00", "pending"))
    kept = staging.stage_orders(orders, *dimensions(spark), run_date=D1)
    # the lowest product id is kept even when it is the bad line
    assert sorted((r.order_id, r.product_id, r.is_valid) for r in kept.collect()) == [("o", "p", False), ("q", "p2", True)]
    lines = staging.stage_orders(orders, *dimensions(spark), key=["order_id", "product_id"])
    assert lines.count() == 3


# --- models ----------------------------------------------------------------------------------

def test_views_drop_what_they_should(spark):
    customers = spark.createDataFrame(
        [("a", "\tANA-maria o'neil ", " A@B ", 16, "55+"), ("b", "x", None, 20, ""), ("c", "x", "bad", 20, ""),
         ("d", "x", "a@b", None, ""), ("e", "x", "a@b", 15, ""), ("f", "x", "a@b", 101, ""), (None, "x", "a@b", 20, "")],
        "customer_id string, full_name string, email string, age int, age_group string",
    ).withColumn("city", F.lit("rio"))
    assert [tuple(r) for r in models.stg_customers(customers).collect()] == [("a", "Ana-Maria O'neil", "a@b", "rio", 16, "55+")]
    products = spark.createDataFrame(
        [("a", "\t n ", 1.1, 2.2), ("even", "n", 2.0, 2.0), ("cost", "n", 0.0, 2.0), ("null", "n", None, 2.0), (None, "n", 1.0, 2.0)],
        "product_id string, name string, cost_price double, sell_price double",
    ).withColumns({"category": F.lit("c"), "margin_pct": F.lit(50.0)})
    assert [tuple(r) for r in models.stg_products(products).collect()] == [
        ("a", "n", "c", Dec("1.10"), Dec("2.20"), Dec("50.00"))
    ]
    orders = spark.createDataFrame(
        [("a", 1, 1.005, "COMPLETED"), ("q", 0, 1.0, "x"), ("nq", None, 1.0, "x"), ("u", 1, 0.0, "x"), (None, 1, 1.0, "x"),
         ("ns", 1, 1.0, None)],
        "order_id string, quantity bigint, unit_price double, status string",
    ).withColumns({"customer_id": F.lit("c"), "product_id": F.lit("p"), "total_amount": F.lit(0.3), "order_date": F.lit(D1)})
    got = {r.order_id: (r.unit_price, r.total_amount, r.status) for r in models.stg_orders(orders).collect()}
    assert got == {"a": (Dec("1.01"), Dec("0.30"), "completed"), "ns": (Dec("1.00"), Dec("0.30"), None)}


def test_fact_keeps_orders_without_a_match(spark):
    orders = spark.createDataFrame(
        [("a", "c", "p", 2, Dec("5.00"), Dec("10.00"), "completed", D1), ("b", "x", "x", 1, Dec("5.00"), Dec("5.00"), "pending", D1),
         ("n", None, None, 1, Dec("5.00"), Dec("5.00"), None, D1), ("loss", "c", "p", 1, Dec("1.00"), Dec("1.00"), "completed", D1)],
        "order_id string, customer_id string, product_id string, quantity bigint, unit_price decimal(18,2), "
        "total_amount decimal(18,2), status string, order_date date",
    )
    customers = spark.createDataFrame([("c", "rio", "18-24")], "customer_id string, city string, age_group string")
    products = spark.createDataFrame([("p", "n", "k", Dec("3.33"))],
                                     "product_id string, name string, category string, cost_price decimal(18,2)")
    fact = models.fct_orders(orders, customers, products)
    assert fact.columns == models.FACT_COLUMNS
    got = {r.order_id: (r.cost_amount, r.profit, r.city, r.product_name) for r in fact.collect()}
    assert got == {"a": (Dec("6.66"), Dec("3.34"), "rio", "n"), "b": (None, None, None, None), "n": (None, None, None, None),
                   "loss": (Dec("3.33"), Dec("-2.33"), "rio", "n")}
    assert tuple(models.unmatched_orders(fact).first()) == (2, 2)


def facts(spark, *rows):
    return spark.createDataFrame(
        [(f"o{i}", c, p, d, 1, None if t is None else Dec(t), None if g is None else Dec(g), s, city, city and "18-24", "k", "n")
         for i, (c, p, d, t, g, s, city) in enumerate(rows)],
        "order_id string, customer_id string, product_id string, order_date date, quantity bigint, "
        "total_amount decimal(18,2), profit decimal(18,2), status string, city string, age_group string, "
        "category string, product_name string",
    )


def test_daily_revenue_edges(spark):
    fact = facts(
        spark,
        ("a", "p", D1, "10.00", "4.00", "completed", "rio"), ("b", "p", D1, "5.01", None, "completed", "rio"),
        ("a", "p", D1, "7.00", "1.00", "cancelled", "rio"),
        ("a", "p", D2, "7.00", "1.00", "cancelled", "rio"), ("a", "p", D2, "7.00", "1.00", "pending", "rio"),
        ("a", "p", D2, "7.00", "1.00", None, "rio"),
        ("a", "p", None, "8.00", "-9.00", "completed", "rio"),
    )
    got = {r.report_date: tuple(r)[1:] for r in models.mart_daily_revenue(fact).collect()}
    assert got == {
        D1: (3, 2, 1, 0, Dec("22.01"), Dec("15.01"), Dec("4.00"), Dec("33.33"), Dec("7.51"), Dec("26.65")),
        D2: (3, 0, 1, 1, Dec("21.00"), Dec("0.00"), Dec("0.00"), Dec("33.33"), None, None),
        None: (1, 1, 0, 0, Dec("8.00"), Dec("8.00"), Dec("-9.00"), Dec("0.00"), Dec("8.00"), Dec("-112.50")),
    }


def test_product_ranks_share_and_skip(spark):
    fact = facts(
        spark,
        ("a", "p1", D1, "10.00", "4.00", "completed", "rio"), ("a", "p2", D1, "10.00", "4.00", "completed", "rio"),
        ("a", "p3", D1, "9.99", "4.00", "completed", "rio"), ("a", "p4", D1, "99.00", "4.00", "pending", "rio"),
        ("a", "p5", D1, "99.00", None, "cancelled", "rio"), ("a", "p1", D2, "1.00", None, "completed", "rio"),
        ("a", None, D1, "50.00", None, "completed", "rio"),
    )
    rows = models.mart_product_performance(fact).collect()
    got = {(r.report_date, r.product_id): (r.revenue_rank, r.revenue, r.profit, r.profit_margin_pct) for r in rows}
    assert got == {
        (D1, None): (1, Dec("50.00"), None, None), (D1, "p1"): (2, Dec("10.00"), Dec("4.00"), Dec("40.00")),
        (D1, "p2"): (2, Dec("10.00"), Dec("4.00"), Dec("40.00")), (D1, "p3"): (4, Dec("9.99"), Dec("4.00"), Dec("40.04")),
        (D1, "p4"): (5, Dec("0.00"), Dec("0.00"), None), (D1, "p5"): (5, Dec("0.00"), Dec("0.00"), None),
        (D2, "p1"): (1, Dec("1.00"), None, None),
    }


def test_segments_count_unknown_customers(spark):
    fact = facts(
        spark,
        ("a", "p", D1, "10.00", "4.00", "completed", "rio"), ("a", "p", D1, "20.01", "4.00", "completed", "rio"),
        ("b", "p", D1, "7.00", "1.00", "pending", "rio"), ("x", "p", D1, "7.00", None, "completed", None),
        (None, "p", D1, "7.00", None, "cancelled", None),
    )
    got = {r.city: tuple(r)[3:] for r in models.mart_customer_segments(fact).collect()}
    assert got == {
        "rio": (2, 3, Dec("15.01"), Dec("30.01"), Dec("8.00")), None: (1, 2, Dec("7.00"), Dec("7.00"), Dec("0.00")),
    }


# --- data tests ------------------------------------------------------------------------------

def test_there_are_21_tests():
    kinds = [t.kind for t in quality.SHOP_TESTS]
    assert (len(kinds), kinds.count("not_null"), kinds.count("unique"), kinds.count("accepted_values")) == (21, 13, 6, 2)


def test_report_and_failure(spark):
    df = spark.createDataFrame(
        [("a", "completed"), ("a", "odd"), ("b", "odd"), ("b", "strange"), (None, None), (None, "pending")],
        "order_id string, status string",
    )
    tests = [t for t in quality.SHOP_TESTS if t.table == "raw_orders"]
    result = quality.report({"raw_orders": df}, tests)
    got = {(r.column_name, r.test): (r.failures, r.passed) for r in result.collect()}
    assert got == {("order_id", "not_null"): (2, False), ("order_id", "unique"): (2, False),
                   ("status", "accepted_values"): (2, False)}
    with pytest.raises(quality.DataTestFailure, match="raw_orders.order_id unique: 2"):
        quality.require_passed(result)
    fine = spark.createDataFrame([("a", None), ("b", "pending")], "order_id string, status string")
    assert len(quality.require_passed(quality.report({"raw_orders": fine}, tests))) == 3
