"""Data tests on tables: declared per column, run in few passes, reported per test."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from merchmill import values

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class ColumnTest:
    table: str
    column: str
    kind: str
    accepted: tuple[str, ...] = ()


def _tests(table: str, column: str, *kinds: str) -> list[ColumnTest]:
    return [ColumnTest(table, column, k, values.SHOP_STATUSES if k == ACCEPTED else ()) for k in kinds]


#: the tests a run must pass; ``raw_*`` are the warehouse tables as loaded
SHOP_TESTS = [
    *_tests("raw_orders", "order_id", NOT_NULL, UNIQUE),
    *_tests("raw_orders", "status", ACCEPTED),
    *_tests("raw_customers", "customer_id", NOT_NULL),
    *_tests("raw_products", "product_id", NOT_NULL),
    *_tests("stg_orders", "order_id", NOT_NULL, UNIQUE),
    *_tests("stg_orders", "quantity", NOT_NULL),
    *_tests("stg_orders", "status", ACCEPTED),
    *_tests("stg_customers", "customer_id", NOT_NULL, UNIQUE),
    *_tests("stg_products", "product_id", NOT_NULL, UNIQUE),
    *_tests("fct_orders", "order_id", NOT_NULL, UNIQUE),
    *_tests("mart_daily_revenue", "report_date", NOT_NULL, UNIQUE),
    *_tests("mart_daily_revenue", "cancel_rate", NOT_NULL),
    *_tests("mart_product_performance", "report_date", NOT_NULL),
    *_tests("mart_product_performance", "product_id", NOT_NULL),
    *_tests("mart_customer_segments", "report_date", NOT_NULL),
]


class DataTestFailure(Exception):
    """Some data tests of a run found bad rows."""


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows that break ``not_null``."""
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that break ``unique``, with their row counts. NULL is not a value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where("n_records > 1")


def unlisted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values that break ``accepted_values``, with their row counts. NULL does not break it."""
    return df.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def _failures(test: ColumnTest) -> Column:
    """Failure count of a test that fits into one aggregate over the table."""
    column = F.col(test.column)
    if test.kind == NOT_NULL:
        return F.count_if(column.isNull())
    return F.count_distinct(F.when(~column.isin(*test.accepted), column))


def report(
    tables: dict[str, DataFrame], tests: Sequence[ColumnTest] = SHOP_TESTS,
    views: dict[str, tuple[str, Callable[[], Column]]] | None = None,
) -> DataFrame:
    """One row per test with the number of failing rows or values.

    All ``not_null`` and ``accepted_values`` tests of a table are one aggregate over it, each
    ``unique`` test is one grouping. ``views`` names tables that are rows of another one, with the
    condition they are kept on: where both have the same ``unique`` test, one grouping answers both.
    Tables should be stored or otherwise cheap to read.
    """
    parts = []
    both = [
        (t, ColumnTest(base, t.column, UNIQUE), kept) for view, (base, kept) in (views or {}).items()
        for t in tests if t.table == view and t.kind == UNIQUE and ColumnTest(base, t.column, UNIQUE) in tests
    ]
    for of_view, of_base, kept in both:
        column = F.col(of_base.column)
        counts = tables[of_base.table].where(column.isNotNull()).groupBy(column).agg(
            F.count(F.lit(1)).alias("n_base"), F.count_if(kept()).alias("n_view"))
        repeated = counts.agg(F.count_if(F.col("n_base") > 1).alias("n_base"), F.count_if(F.col("n_view") > 1).alias("n_view"))
        lines = [
            F.struct(*[F.lit(v).alias(n) for n, v in _labels(t)], F.col(c).alias("failures"))
            for t, c in ((of_base, "n_base"), (of_view, "n_view"))
        ]
        parts.append(repeated.select(F.inline(F.array(*lines))))
    tests = [t for t in tests if not any(t in pair for pair in both)]
    for table, df in tables.items():
        own = [t for t in tests if t.table == table]
        simple = [t for t in own if t.kind != UNIQUE]
        if simple:
            counts = df.agg(*[_failures(t).alias(f"t{i}") for i, t in enumerate(simple)])
            lines = [
                F.struct(*[F.lit(v).alias(n) for n, v in _labels(t)], F.col(f"t{i}").alias("failures"))
                for i, t in enumerate(simple)
            ]
            parts.append(counts.select(F.inline(F.array(*lines))))
        for t in own:
            if t.kind == UNIQUE:
                repeated = repeated_values(df, t.column).agg(F.count(F.lit(1)).alias("failures"))
                parts.append(repeated.select(*[F.lit(v).alias(n) for n, v in _labels(t)], "failures"))
    found = reduce(DataFrame.unionByName, parts)
    return found.withColumn("passed", F.col("failures") == 0)


def _labels(test: ColumnTest) -> list[tuple[str, str]]:
    return [("table_name", test.table), ("column_name", test.column), ("test", test.kind)]


def require_passed(results: DataFrame, known: dict[ColumnTest, int] | None = None) -> list[dict]:
    """Run a report; raise when a test failed, naming all that did. Returns the report's rows.

    ``known`` are failure counts of further tests that were taken otherwise.
    """
    rows = [r.asDict() for r in results.collect()]  # one row per declared test
    rows += [{**dict(_labels(t)), "failures": n, "passed": n == 0} for t, n in (known or {}).items()]
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise DataTestFailure("; ".join(
            f"{r['table_name']}.{r['column_name']} {r['test']}: {r['failures']}" for r in failed
        ))
    return rows
