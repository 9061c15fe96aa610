import random
import statistics
from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchmill import operators as op
from merchmill.operators import batches


def money(cents):
    return None if cents is None else Decimal(cents) / 100


@pytest.mark.parametrize("spread", [50, 3_000_000, 10**12])
def test_median_is_exact_with_a_hot_key(spark, spread):
    rng = random.Random(spread)
    rows = [("hot", rng.randint(-spread, spread)) for _ in range(3001)]
    rows += [(f"k{rng.randint(0, 40)}", rng.randint(-spread, spread)) for _ in range(1000)]
    rows += [("tie", 7)] * 500 + [("one", 5), ("gap", None), ("hot", None), (None, 3)]
    df = spark.createDataFrame([(k, money(c)) for k, c in rows], "k string, amount decimal(18,2)").repartition(7)
    expected = defaultdict(list)
    for k, c in rows:
        if k is not None and c is not None:
            expected[k].append(c)
    got = {r.k: r.m for r in op.exact_median(df, "k", "amount", "m").collect()}
    assert got == {k: Decimal(statistics.median(map(Decimal, v))) / 100 for k, v in expected.items()}


def sql_rank(rows):
    """RANK by brute force: one more than the rows of the group that are larger; NULL is smallest."""
    def size(c):
        return -10**30 if c is None else c
    return sorted(
        (repr(g), i, 1 + sum(1 for h, _, d in rows if h == g and size(d) > size(c))) for g, i, c in rows
    )


@pytest.mark.parametrize("spread", [3, 5_000_000, 10**13])
def test_rank_is_exact_with_ties_nulls_and_a_hot_day(spark, spread):
    rng = random.Random(spread)
    hot, cold = date(2020, 1, 1), date(2020, 1, 2)
    rows = [(hot, i, rng.randint(-spread, spread)) for i in range(900)]
    rows += [(hot, 1000 + i, 0) for i in range(300)] + [(hot, 2000, None), (hot, 2001, None)]
    rows += [(cold, 3000 + i, 5) for i in range(4)] + [(None, 4000, 1), (None, 4001, 2), (None, 4002, 2)]
    df = spark.createDataFrame([(g, i, money(c)) for g, i, c in rows], "g date, i int, amount decimal(18,2)")
    got = op.rank_descending(df.repartition(5), "g", "amount", "r")
    assert got.columns == ["g", "i", "amount", "r"]
    assert sorted((repr(r.g), r.i, r.r) for r in got.collect()) == sql_rank(rows)


def test_first_per_key_and_plan_drops_rows_before_the_shuffle(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 9, "n"), (None, 8, "m")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    first = op.first_per_key(df, ["k"], ["o"])
    assert sorted(map(repr, (r.v for r in first.collect()))) == ["'m'", "'y'", "'z'"]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_without_keys(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    target = spark.createDataFrame([(2, 0), (2, 1), (9, 1)], "k int, w int")
    assert sorted(r.k for r in op.without_keys(batch, target, ["k"]).collect()) == [1, 3]


def test_first_failed_takes_null_as_kept(spark):
    df = spark.createDataFrame([(1, None), (-1, None), (None, -5), (None, None), (-1, -5)], "a int, b int")
    reason = op.first_failed([(F.col("a") < 0, "a"), (F.col("b") < 0, "b")])
    assert [r[0] for r in df.select(reason).collect()] == [None, "a", "b", None, "a"]


DAY = date(2020, 5, 1)


def orders(spark, own, other):
    rows = [(f"{i:04d}", "p", datetime(2020, 5, 1, 10), DAY) for i in range(own)]
    rows += [(f"9{i:04d}", "p", datetime(2020, 4, 1, 10), date(2020, 4, 1)) for i in range(other)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows, "order_id string, product_id string, created_at timestamp_ntz, order_date date"
    ).repartition(3)


KEYS = ["order_id", "product_id"]


def ids(df):
    return sorted(r.order_id for r in df.collect())


def test_batch_caps_in_key_order(spark):
    got = op.take_batch(orders(spark, 30, 50), DAY, 20, 42, KEYS)
    assert ids(got) == [f"{i:04d}" for i in range(20)]
    assert {r.created_at for r in got.collect()} == {datetime(2020, 5, 1, 10)}


def test_batch_tops_up_and_restamps(spark):
    df = orders(spark, 5, 50)
    rows = op.take_batch(df, DAY, 20, 42, KEYS).collect()
    assert len(rows) == 20 and {r.order_date for r in rows} == {DAY}
    extra = [r for r in rows if r.order_id.startswith("9")]
    assert len(extra) == 15 and {r.created_at for r in extra} == {datetime(2020, 5, 1)}
    assert sorted(r.order_id for r in extra) == ids(op.top_up(df, DAY, 15, 42, KEYS))
    assert ids(op.take_batch(df.repartition(9), DAY, 20, 42, KEYS)) == sorted(r.order_id for r in rows)
    assert ids(op.take_batch(df, DAY, 20, 7, KEYS)) != sorted(r.order_id for r in rows)


def test_batch_takes_all_there_is(spark):
    assert len(op.take_batch(orders(spark, 5, 6), DAY, 20, 42, KEYS).collect()) == 11


def test_no_limit_means_no_cap_and_no_top_up(spark):
    assert ids(op.take_batch(orders(spark, 30, 50), DAY, None, 42, KEYS)) == [f"{i:04d}" for i in range(30)]


@pytest.mark.parametrize("own, count", [(30, 20), (5, 20), (5, 200), (0, 7), (20, 20)])
def test_batches_of_any_size_are_the_plain_sorted_head(spark, own, count):
    df = orders(spark, own, 50)
    other = F.col("order_date") != F.lit(DAY)
    plain = df.orderBy(other, F.when(other, batches.draw_order(42, KEYS)), *KEYS).limit(count)
    assert ids(op.take_batch(df, DAY, count, 42, KEYS)) == ids(plain)


def test_head_rows_with_null_keys_and_one_common_prefix(spark):
    rows = [(None, i) for i in range(3)] + [(f"ORD-{i:06d}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(5)
    for count in (2, 10, 43, 99):
        head = op.head_rows(df, count, ["k", "n"])
        assert sorted((r.k or "", r.n) for r in head.collect()) == sorted((k or "", n) for k, n in rows)[:count]
        assert "GlobalLimit" not in head._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("count", [0, 1, 49, 50, 51, 99, 100, 500])
def test_head_rows_at_every_cut(spark, count):
    texts = [f"{i // 10:04d}-{i % 10}" for i in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(6)
    assert sorted(r.t for r in op.head_rows(df, count, ["t"]).collect()) == texts[:count]
