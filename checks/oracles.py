"""SQL for DuckDB that gives the same rows as each registered query.

Common table expressions are named once in ``STEPS``; ``oracle`` puts those that a query needs in
front of it. Money stays in whole cents until the last SELECT, and quotients are taken in whole
numbers, half away from zero.
"""

from __future__ import annotations

import re

from checks.fixtures import AS_OF, DRIVER_TABLES, FIXTURES, NEXT_DATE, NOW, RUN_DATE, SEED


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(names) -> str:
    return ", ".join(text(n) for n in names)


def div_half_up(n: str, d: str) -> str:
    """n / d as a whole number, half away from zero; NULL when d is zero."""
    return f"(sign({n}) * sign({d}) * ((2 * abs({n}) + abs({d})) // nullif(2 * abs({d}), 0)))"


def money(cents: str) -> str:
    return f"(cast({cents} AS double) / 100)"


def percent(n: str, d: str) -> str:
    return money(f"cast({div_half_up(f'(10000 * cast({n} AS hugeint))', d)} AS bigint)")


def mean(total: str, count: str) -> str:
    return money(f"cast({div_half_up(f'cast({total} AS hugeint)', count)} AS bigint)")


def by_letter(x: str, starts_word: str) -> str:
    """Capital where the letter before makes a new word, else lower case."""
    before = f"substr({x}, i - 1, 1)"
    return (
        f"list_aggregate(list_transform(range(1, length({x}) + 1), lambda i: CASE WHEN i = 1 OR "
        f"{starts_word.format(before=before)} THEN upper(substr({x}, i, 1)) "
        f"ELSE lower(substr({x}, i, 1)) END), 'string_agg', '')"
    )


def title(x: str) -> str:
    return by_letter(x, r"NOT regexp_matches({before}, '\p{{L}}')")


def initcap(x: str) -> str:
    return by_letter(x, "({before} = ' ' OR instr(" + text('[](){}/|<>!?@"^#$&~_,.:;*%+-').replace("{", "{{").replace("}", "}}") + ", {before}) > 0)")


# The lists below are stated here and not taken from the library, which is what they check.

def status_case(x: str) -> str:
    return (f"CASE WHEN lower({x}) IN ('delivered', 'shipped') THEN 'completed' "
            f"WHEN lower({x}) IN ('canceled', 'unavailable') THEN 'cancelled' ELSE 'pending' END")


def category_case(x: str) -> str:
    """The groups of the categories that the test tables have; all others are in the default group."""
    return (f"CASE trim(lower({x})) WHEN 'electronics' THEN 'Electronics' WHEN 'fashion_shoes' THEN 'Clothing' "
            "WHEN 'food_drink' THEN 'Food & Beverage' WHEN 'books_technical' THEN 'Books' WHEN 'sports_leisure' THEN 'Sports' "
            "WHEN 'la_cuisine' THEN 'Sports' WHEN 'health_beauty' THEN 'Beauty' ELSE 'Home & Living' END")


AGE_CASE = ("CASE WHEN age >= 18 AND age < 25 THEN '18-24' WHEN age >= 25 AND age < 35 THEN '25-34' "
            "WHEN age >= 35 AND age < 45 THEN '35-44' WHEN age >= 45 AND age < 55 THEN '45-54' ELSE '55+' END")


def age_sql(key: str) -> str:
    return f"cast(18 + cast('0x' || substr(md5('{SEED}' || {key}), 1, 8) AS bigint) % 48 AS int)"


def draw(alias: str = "") -> str:
    return f"md5('{SEED}|' || {alias}order_id || '|' || {alias}product_id)"


def batch_step(day) -> str:
    return f"""
        SELECT order_id, customer_id, product_id, quantity, unit_cents, status,
               CASE WHEN order_date = DATE '{day}' THEN created_at ELSE TIMESTAMP '{day} 00:00:00' END AS created_at,
               DATE '{day}' AS order_date
        FROM built_orders
        ORDER BY order_date <> DATE '{day}', CASE WHEN order_date <> DATE '{day}' THEN {draw()} ELSE '' END,
                 order_id, product_id
        LIMIT 250"""


ORDER_REASON = f"""
    CASE WHEN quantity <= 0 THEN 'Invalid quantity'
         WHEN unit_cents <= 0 THEN 'Invalid unit price'
         WHEN status NOT IN ('completed', 'pending', 'cancelled') THEN 'Unknown status'
         WHEN NOT has_customer THEN 'Customer not found'
         WHEN NOT has_product THEN 'Product not found' END"""


def checked(orders: str, customers: str, products: str) -> str:
    return f"""
        SELECT order_id, customer_id, product_id, quantity, unit_cents, quantity * unit_cents AS total_cents,
               status, order_date, {ORDER_REASON} AS invalid_reason
        FROM (SELECT o.*, EXISTS (SELECT 1 FROM {customers} c WHERE c.customer_id = o.customer_id) AS has_customer,
                     EXISTS (SELECT 1 FROM {products} p WHERE p.product_id = o.product_id) AS has_product
              FROM {orders} o)"""


def first_line(rows: str) -> str:
    return f"SELECT * FROM {rows} QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY product_id) = 1"


def fact_of(orders: str, customers: str, products: str) -> str:
    return f"""
        SELECT o.order_id, o.customer_id, o.product_id, o.order_date, o.quantity, o.unit_cents, o.total_cents,
               p.cost_cents * o.quantity AS cost_cents, o.total_cents - p.cost_cents * o.quantity AS profit_cents,
               o.status, c.city, c.age_group, p.category, p.name AS product_name
        FROM {orders} o LEFT JOIN {customers} c ON c.customer_id = o.customer_id
        LEFT JOIN {products} p ON p.product_id = o.product_id"""


DONE = "FILTER (WHERE status = 'completed')"


def daily_mart(fact: str) -> str:
    return f"""
        SELECT report_date, total_orders, completed_orders, cancelled_orders, pending_orders,
               {money('gross')} AS gross_revenue, {money('net')} AS net_revenue, {money('gain')} AS total_profit,
               {percent('cancelled_orders', 'total_orders')} AS cancel_rate,
               {mean('net_sum', 'net_n')} AS avg_order_value,
               {percent('gain', 'net')} AS profit_margin_pct
        FROM (SELECT order_date AS report_date, count(*) AS total_orders,
                     count(*) {DONE} AS completed_orders,
                     count(*) FILTER (WHERE status = 'cancelled') AS cancelled_orders,
                     count(*) FILTER (WHERE status = 'pending') AS pending_orders,
                     cast(sum(total_cents) AS bigint) AS gross,
                     cast(sum(total_cents) {DONE} AS bigint) AS net_sum, count(total_cents) {DONE} AS net_n,
                     cast(sum(CASE WHEN status = 'completed' THEN total_cents ELSE 0 END) AS bigint) AS net,
                     cast(sum(CASE WHEN status = 'completed' THEN profit_cents ELSE 0 END) AS bigint) AS gain
              FROM {fact} GROUP BY order_date)"""


def product_mart(fact: str) -> str:
    return f"""
        SELECT report_date, product_id, product_name, category, units_sold,
               {money('net')} AS revenue, {money('gain')} AS profit, {percent('gain', 'net')} AS profit_margin_pct,
               rank() OVER (PARTITION BY report_date ORDER BY net DESC NULLS LAST) AS revenue_rank
        FROM (SELECT order_date AS report_date, product_id, product_name, category,
                     cast(sum(quantity) AS bigint) AS units_sold,
                     cast(sum(CASE WHEN status = 'completed' THEN total_cents ELSE 0 END) AS bigint) AS net,
                     cast(sum(CASE WHEN status = 'completed' THEN profit_cents ELSE 0 END) AS bigint) AS gain
              FROM {fact} GROUP BY order_date, product_id, product_name, category)"""


def segment_mart(fact: str) -> str:
    return f"""
        SELECT report_date, city, age_group, total_customers, total_orders,
               {mean('net_sum', 'net_n')} AS avg_order_value,
               {money('net')} AS total_revenue, {money('gain')} AS total_profit
        FROM (SELECT order_date AS report_date, city, age_group, count(DISTINCT customer_id) AS total_customers,
                     count(order_id) AS total_orders,
                     cast(sum(total_cents) {DONE} AS bigint) AS net_sum, count(total_cents) {DONE} AS net_n,
                     cast(sum(CASE WHEN status = 'completed' THEN total_cents ELSE 0 END) AS bigint) AS net,
                     cast(sum(CASE WHEN status = 'completed' THEN profit_cents ELSE 0 END) AS bigint) AS gain
              FROM {fact} GROUP BY order_date, city, age_group)"""


def customer_view(rows: str) -> str:
    return f"""
        SELECT customer_id, {initcap('full_name')} AS full_name, lower(trim(email)) AS email, city, age, age_group
        FROM {rows} WHERE customer_id IS NOT NULL AND contains(email, '@') AND age >= 16 AND age <= 100"""


def product_view(rows: str) -> str:
    return f"""
        SELECT product_id, trim(name) AS name, category, cost_cents, sell_cents, margin_pct
        FROM {rows} WHERE product_id IS NOT NULL AND cost_cents > 0 AND sell_cents > cost_cents"""


def order_view(rows: str) -> str:
    return f"""
        SELECT order_id, customer_id, product_id, quantity, unit_cents, total_cents, lower(status) AS status, order_date
        FROM {rows} WHERE order_id IS NOT NULL AND quantity > 0 AND unit_cents > 0"""


def staged_product_sql(rows: str) -> str:
    return f"""
        SELECT product_id, trim(name) AS name, category, cost_cents, sell_cents,
               {percent('(sell_cents - cost_cents)', 'sell_cents')} AS margin_pct,
               CASE WHEN cost_cents <= 0 THEN 'Invalid cost price'
                    WHEN sell_cents <= 0 THEN 'Invalid sell price'
                    WHEN sell_cents < cost_cents THEN 'Sell price below cost' END AS invalid_reason
        FROM {rows}"""


def staged_customer_sql(rows: str) -> str:
    return f"""
        SELECT customer_id, trim(full_name) AS full_name, lower(trim(email)) AS email, city, age,
               {AGE_CASE} AS age_group,
               CASE WHEN coalesce(trim(full_name), '') = '' THEN 'Missing or empty full name'
                    WHEN NOT contains(email, '@') THEN 'Invalid email format'
                    WHEN age < 16 OR age > 100 THEN 'Age out of range (16-100)' END AS invalid_reason
        FROM {rows}"""


CHANGED = "order_date >= DATE '{}' - 60".format(AS_OF)

STEPS: dict[str, str] = {
    **{name: sql.format(**{t: t for t in DRIVER_TABLES}) for name, sql in FIXTURES.items()},
    # --- ingest
    "people": "SELECT * FROM csv_customers QUALIFY row_number() OVER "
              "(PARTITION BY customer_unique_id ORDER BY customer_id) = 1",
    "built_customers": f"""
        SELECT customer_unique_id AS customer_id, 'Customer ' || upper(left(customer_unique_id, 8)) AS full_name,
               left(customer_unique_id, 12) || '@olist.example.com' AS email,
               coalesce({title('customer_city')}, 'Unknown') AS city, {age_sql('customer_unique_id')} AS age
        FROM people""",
    "medians": """
        SELECT product_id, quantile_cont(price_cents, 0.5) AS middle FROM csv_order_items
        WHERE product_id IS NOT NULL AND price_cents IS NOT NULL GROUP BY product_id""",
    "built_products": f"""
        SELECT product_id, {title("replace(coalesce(eng_name, 'Unknown'), '_', ' ')")} AS name,
               {category_case('eng_name')} AS category,
               (55 * sell_cents + 50) // 100 AS cost_cents, sell_cents
        FROM (SELECT product_id, eng_name, cast(floor(middle + 0.5) AS bigint) AS sell_cents
              FROM csv_products JOIN medians USING (product_id) LEFT JOIN csv_translation USING (product_category_name))""",
    "lines": f"""
        SELECT order_id, product_id, count(*) AS quantity,
               cast({div_half_up('sum(price_cents)', 'count(price_cents)')} AS bigint) AS unit_cents
        FROM csv_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL GROUP BY order_id, product_id""",
    "id_map": "SELECT customer_id, min(customer_unique_id) AS person FROM csv_customers GROUP BY customer_id",
    "built_orders": f"""
        SELECT order_id, coalesce(person, customer_id) AS customer_id, product_id, quantity, unit_cents,
               {status_case('order_status')} AS status, created_at, cast(created_at AS date) AS order_date
        FROM (SELECT *, coalesce(try_cast(order_purchase_timestamp AS timestamp), TIMESTAMP '{NOW}') AS created_at
              FROM lines JOIN csv_orders USING (order_id) LEFT JOIN id_map USING (customer_id))""",
    "batch_1": batch_step(RUN_DATE),
    "batch_2": batch_step(NEXT_DATE),
    # --- staging
    "staged_customers": staged_customer_sql("raw_customers"),
    "staged_products": staged_product_sql("raw_products"),
    "checked_orders": checked("raw_orders", "raw_customers", "raw_products"),
    "staged_orders": first_line("checked_orders"),
    # --- warehouse
    "valid_customers": "SELECT * EXCLUDE (invalid_reason) FROM staged_customers WHERE invalid_reason IS NULL",
    "valid_products": "SELECT * EXCLUDE (invalid_reason) FROM staged_products WHERE invalid_reason IS NULL",
    "valid_orders": "SELECT * EXCLUDE (invalid_reason) FROM staged_orders WHERE invalid_reason IS NULL",
    "view_customers": customer_view("valid_customers"),
    "view_products": product_view("valid_products"),
    "view_orders": order_view("valid_orders"),
    "fact": fact_of("view_orders", "view_customers", "view_products"),
    "late": f"""
        SELECT * REPLACE (CASE WHEN status = 'pending' THEN 'completed' ELSE status END AS status,
                          CASE WHEN status = 'pending' THEN cast(order_date + 1 AS date) ELSE order_date END AS order_date)
        FROM fact WHERE {CHANGED}""",
    "merged": f"""
        SELECT * FROM fact WHERE NOT coalesce({CHANGED}, false) UNION ALL SELECT * FROM late""",
    "daily": daily_mart("fact"),
    "product": product_mart("fact"),
    "segment": segment_mart("fact"),
    # --- two daily runs
    "two_batches": """
        SELECT *, 1 AS run FROM batch_1
        UNION ALL SELECT *, 2 FROM batch_2
        WHERE (order_id, product_id) NOT IN (SELECT (order_id, product_id) FROM batch_1)""",
    "two_customers": "SELECT * FROM built_customers WHERE customer_id IN (SELECT customer_id FROM two_batches)",
    "two_products": "SELECT * FROM built_products WHERE product_id IN (SELECT product_id FROM two_batches)",
    "two_lines": """
        SELECT * FROM two_batches
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY run, product_id) = 1""",
    "two_checked": checked("two_lines", "two_customers", "two_products"),
    "two_staged_customers": staged_customer_sql("two_customers"),
    "two_staged_products": staged_product_sql("two_products"),
    "two_view_orders": order_view("(SELECT * FROM two_checked WHERE invalid_reason IS NULL)"),
    "two_view_customers": customer_view("(SELECT * FROM two_staged_customers WHERE invalid_reason IS NULL)"),
    "two_view_products": product_view("(SELECT * FROM two_staged_products WHERE invalid_reason IS NULL)"),
    "two_fact": fact_of("two_view_orders", "two_view_customers", "two_view_products"),
    # --- all history in one run
    "all_lines": first_line("built_orders"),
    "all_checked": checked("all_lines", "built_customers", "built_products"),
    "all_staged_customers": staged_customer_sql("built_customers"),
    "all_staged_products": staged_product_sql("built_products"),
    "all_view_orders": order_view("(SELECT * FROM all_checked WHERE invalid_reason IS NULL)"),
    "all_view_customers": customer_view("(SELECT * FROM all_staged_customers WHERE invalid_reason IS NULL)"),
    "all_view_products": product_view("(SELECT * FROM all_staged_products WHERE invalid_reason IS NULL)"),
    "all_fact": fact_of("all_view_orders", "all_view_customers", "all_view_products"),
}


def oracle(query: str) -> str:
    """The query with the steps it needs in front, in the order they are listed."""
    needed: set[str] = set()
    open_texts = [query]
    while open_texts:
        words = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", open_texts.pop())))
        for name in (words & STEPS.keys()) - needed:
            needed.add(name)
            open_texts.append(STEPS[name])
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items() if name in needed)
    return f"WITH {steps}\n{query}" if steps else query


ORDER_OUT = (f"order_id, customer_id, product_id, quantity, {money('unit_cents')} AS unit_price, status, "
             "cast(created_at AS varchar) AS created_at, order_date")
CUSTOMER_OUT = "customer_id, full_name, email, city, age"
PRODUCT_OUT = f"product_id, name, category, {money('cost_cents')} AS cost_price, {money('sell_cents')} AS sell_price"
VERDICT = "invalid_reason IS NULL AS is_valid, invalid_reason"
LANDED_ORDER = (f"order_id, customer_id, product_id, quantity, {money('unit_cents')} AS unit_price, "
                f"{money('total_cents')} AS total_amount, status, order_date")
FACT_OUT = (f"order_id, customer_id, product_id, order_date, quantity, {money('unit_cents')} AS unit_price, "
            f"{money('total_cents')} AS total_amount, {money('cost_cents')} AS cost_amount, "
            f"{money('profit_cents')} AS profit, status, city, age_group, category, product_name")
DAY = f"DATE '{RUN_DATE}'"

_TESTED = {
    "raw_orders": "raw_orders", "raw_customers": "valid_customers", "raw_products": "valid_products",
    "stg_orders": "view_orders", "stg_customers": "view_customers", "stg_products": "view_products",
    "fct_orders": "fact", "mart_daily_revenue": "daily", "mart_product_performance": "product",
    "mart_customer_segments": "segment",
}


def test_report() -> str:
    from merchmill.plans.quality import NOT_NULL, SHOP_TESTS, UNIQUE

    parts = []
    for t in SHOP_TESTS:
        source, c = _TESTED[t.table], t.column
        if t.kind == NOT_NULL:
            found = f"(SELECT count(*) FROM {source} WHERE {c} IS NULL)"
        elif t.kind == UNIQUE:
            found = (f"(SELECT count(*) FROM (SELECT {c} FROM {source} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1))")
        else:
            found = f"(SELECT count(DISTINCT {c}) FROM {source} WHERE {c} NOT IN ({listed(t.accepted)}))"
        parts.append(f"SELECT {text(t.table)} AS table_name, {text(c)} AS column_name, {text(t.kind)} AS test, "
                     f"{found} AS failures")
    return f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


_SELECTS: dict[str, str] = {
    "csv_scan": f"SELECT order_id, product_id, {money('price_cents')} AS price FROM csv_order_items",
    "quarantine_faults": """
SELECT source, column_name, value, reason FROM (
  SELECT order_id, cast(order_id AS bigint) % 151 = 0 AS no_id, cast(order_id AS bigint) % 157 = 0 AS cut, customer_id, order_purchase_timestamp AS bought FROM csv_orders) AS o,
LATERAL (
  SELECT 'orders' AS source, NULL AS column_name, concat(CASE WHEN no_id THEN '' ELSE order_id END, ',', customer_id, ',"on') AS value, 'open quote' AS reason WHERE cut
  UNION ALL SELECT 'orders', NULL, concat('hold",', coalesce(bought, '')), 'open quote' WHERE cut
  UNION ALL SELECT 'orders', 'order_id', NULL, 'no key' WHERE no_id AND NOT cut
  UNION ALL SELECT 'orders', 'order_purchase_timestamp', bought, 'unreadable time' WHERE bought = 'not-a-date' AND NOT cut) AS f
UNION ALL
SELECT 'order_items', 'product_id', NULL, 'no key' FROM csv_order_items WHERE product_id IS NULL
UNION ALL
SELECT 'order_items', 'price', 'free', 'unreadable value' FROM csv_order_items WHERE cast(order_id AS bigint) % 149 = 0""",
    "csv_scan_text": "SELECT * FROM csv_customers",
    "csv_scan_multiline": "SELECT * REPLACE (replace(customer_city, ' ', chr(10)) AS customer_city) FROM csv_customers",
    "customers_dedup": "SELECT customer_unique_id, customer_id, customer_city FROM people",
    "customers_build": f"SELECT {CUSTOMER_OUT} FROM built_customers",
    "median_price": "SELECT product_id, cast(cast(2 * middle AS bigint) * 5 AS double) / 1000 AS median_price FROM medians",
    "products_build": f"SELECT {PRODUCT_OUT} FROM built_products",
    "order_items_agg": f"SELECT order_id, product_id, quantity, {money('unit_cents')} AS unit_price FROM lines",
    "customer_id_map": "SELECT order_id, coalesce(person, customer_id) AS customer_id "
                       "FROM csv_orders LEFT JOIN id_map USING (customer_id)",
    "orders_build": f"SELECT {ORDER_OUT} FROM built_orders",
    "status_map": f"SELECT order_id, order_status, {status_case('order_status')} AS status FROM csv_orders",
    "category_map": f"SELECT product_id, eng_name, {category_case('eng_name')} AS category "
                    "FROM csv_products LEFT JOIN csv_translation USING (product_category_name)",
    "title_case": f"SELECT customer_id, {title('customer_city')} AS city FROM csv_customers",
    "derive_age": f"SELECT customer_id, {age_sql('customer_unique_id')} AS age FROM csv_customers",
    "parse_timestamp": "SELECT order_id, cast(coalesce(try_cast(order_purchase_timestamp AS timestamp), "
                       f"TIMESTAMP '{NOW}') AS varchar) AS created_at FROM csv_orders",
    "daily_orders": f"SELECT {ORDER_OUT} FROM built_orders WHERE order_date = {DAY}",
    "daily_head": f"SELECT {ORDER_OUT} FROM (SELECT * FROM built_orders WHERE order_date = {DAY} "
                  "ORDER BY order_id, product_id LIMIT 50)",
    "daily_topup": f"SELECT {ORDER_OUT} FROM (SELECT * REPLACE ({DAY} AS order_date, TIMESTAMP '{RUN_DATE} 00:00:00' "
                   f"AS created_at) FROM (SELECT * FROM built_orders WHERE order_date <> {DAY} "
                   f"ORDER BY {draw()}, order_id, product_id LIMIT 250))",
    "daily_head_large": f"SELECT {ORDER_OUT} FROM (SELECT * FROM built_orders ORDER BY order_id, product_id LIMIT 20000)",
    "daily_topup_large": f"SELECT {ORDER_OUT} FROM (SELECT * REPLACE ({DAY} AS order_date, TIMESTAMP '{RUN_DATE} 00:00:00' "
                         f"AS created_at) FROM (SELECT * FROM built_orders WHERE order_date <> {DAY} "
                         f"ORDER BY {draw()}, order_id, product_id LIMIT 20000))",
    "daily_batch": f"SELECT {ORDER_OUT} FROM batch_1",
    "batch_customers": f"SELECT {CUSTOMER_OUT} FROM built_customers WHERE customer_id IN (SELECT customer_id FROM batch_1)",
    "batch_products": f"SELECT {PRODUCT_OUT} FROM built_products WHERE product_id IN (SELECT product_id FROM batch_1)",
    "age_group": f"SELECT customer_id, age, {AGE_CASE} AS age_group FROM raw_customers",
    "validate_customers": f"SELECT customer_id, {VERDICT} FROM staged_customers",
    "validate_products": f"SELECT product_id, {VERDICT} FROM staged_products",
    "validate_orders": f"SELECT order_id, product_id, {VERDICT} FROM checked_orders",
    "stage_customers": f"SELECT {CUSTOMER_OUT}, age_group, {VERDICT} FROM staged_customers",
    "stage_products": f"SELECT {PRODUCT_OUT}, margin_pct, {VERDICT} FROM staged_products",
    "stage_orders": f"SELECT {LANDED_ORDER}, {VERDICT} FROM staged_orders",
    "stage_first_per_order": f"SELECT {LANDED_ORDER}, {VERDICT} FROM staged_orders",
    "insert_if_absent_customers":
        "SELECT customer_id, full_name, email, CASE WHEN created_on = DATE '1995-01-01' THEN city ELSE 'moved' END "
        "AS city, age, cast(cast(created_on AS timestamp) AS varchar) AS created_at FROM raw_customers",
    "insert_if_absent_products":
        f"SELECT product_id, name, CASE WHEN created_on = DATE '1995-01-01' THEN category ELSE 'other' END AS category, "
        f"{money('cost_cents')} AS cost_price, {money('sell_cents')} AS sell_price, "
        "cast(cast(created_on AS timestamp) AS varchar) AS created_at FROM raw_products",
    "insert_if_absent_orders":
        "SELECT order_id, customer_id, product_id, CASE WHEN status = 'completed' THEN quantity "
        f"ELSE coalesce(quantity, 0) + 10 END AS quantity, {money('unit_cents')} AS unit_price, status, order_date "
        "FROM raw_orders",
    "landing_orders": f"SELECT {LANDED_ORDER} FROM valid_orders",
    "landing_orders_day": f"SELECT {LANDED_ORDER} FROM valid_orders WHERE order_date = {DAY}",
    "landing_customers": f"SELECT {CUSTOMER_OUT}, age_group FROM valid_customers",
    "landing_products": f"SELECT {PRODUCT_OUT}, margin_pct FROM valid_products",
    "load_orders": f"SELECT {LANDED_ORDER} FROM valid_orders",
    "load_orders_day": f"SELECT {LANDED_ORDER} FROM valid_orders",
    "load_customers": f"SELECT {CUSTOMER_OUT}, age_group FROM valid_customers",
    "load_products": f"SELECT {PRODUCT_OUT}, margin_pct FROM valid_products",
    "row_counts": "SELECT 'customers' AS table_name, count(*) AS row_count FROM raw_customers UNION ALL "
                  "SELECT 'products', count(*) FROM raw_products UNION ALL "
                  "SELECT 'orders', count(DISTINCT order_id) FROM raw_orders",
    "stg_customers": f"SELECT {CUSTOMER_OUT}, age_group FROM view_customers",
    "stg_orders": f"SELECT {LANDED_ORDER} FROM view_orders",
    "stg_products": f"SELECT {PRODUCT_OUT}, margin_pct FROM view_products",
    "fct_orders": f"SELECT {FACT_OUT} FROM fact",
    "fct_orders_incremental": f"SELECT {FACT_OUT} FROM fact WHERE order_date >= DATE '{AS_OF}' - 3",
    "fct_orders_merge": f"SELECT {FACT_OUT} FROM merged",
    "fct_orders_merge_day": f"SELECT {FACT_OUT} FROM merged",
    "fct_orders_late": f"SELECT {FACT_OUT} FROM fact",
    "segment_customers_approx": "SELECT city, age_group, count(DISTINCT customer_id) AS total_customers, true AS within_bound "
                                "FROM fact GROUP BY city, age_group",
    "mart_daily_revenue": "SELECT * FROM daily",
    "mart_product_performance": "SELECT * FROM product",
    "mart_customer_segments": "SELECT * FROM segment",
    "unmatched_orders": "SELECT count(*) FILTER (WHERE cost_cents IS NULL) AS no_product, "
                        "count(*) FILTER (WHERE city IS NULL AND age_group IS NULL) AS no_customer FROM fact",
    "dq_not_null": "SELECT order_id, product_id, status FROM raw_orders WHERE quantity IS NULL",
    "dq_unique": "SELECT order_id, count(*) AS n_records FROM raw_orders GROUP BY order_id HAVING count(*) > 1",
    "dq_unique_days": "SELECT count(*) FILTER (WHERE n > 1) AS n_repeated, count(*) FILTER (WHERE m > 1) AS n_repeated_usable FROM ("
                      "SELECT order_id, count(*) AS n, count(*) FILTER (WHERE quantity > 0 AND unit_cents > 0) AS m "
                      "FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id)",
    "dq_accepted_values": "SELECT status, count(*) AS n_records FROM raw_orders "
                          f"WHERE status NOT IN ('completed', 'pending', 'cancelled') GROUP BY status",
    "dq_report": test_report(),
    "run_two_days": f"SELECT * FROM ({product_mart('two_fact')})",
    "run_history": f"SELECT * FROM ({daily_mart('all_fact')})",
}

ORACLES: dict[str, str] = {name: oracle(sql) for name, sql in _SELECTS.items()}
