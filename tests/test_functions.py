from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from merchmill import functions as fn, values

NAMES = [
    "são paulo", "sant'ana do livramento", "porto-alegre", "MOGI DAS CRUZES", "d'oeste 2nd", "3rd avenue",
    "  two  blanks ", "é", "", "x_y z.w", "ponte nova/mg", "água-fria d'ávila",
]


def column(spark, values_, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_title_words_match_python_title(spark):
    assert column(spark, NAMES, fn.title_words) == [n.title() for n in NAMES]
    assert column(spark, [None], fn.title_words) == [None]


def test_initcap_breaks_at_blanks_and_marks_only(spark):
    texts = ["ana maria", "porto-alegre", "o'neil", "a.b_c", "x2y 2z", "JOÃO\tDA silva", "[a](b)", 'q"w^e&&r']
    assert column(spark, texts, fn.initcap_words) == [
        "Ana Maria", "Porto-Alegre", "O'neil", "A.B_C", "X2y 2z", "João\tDa Silva", "[A](B)", 'Q"W^E&&R',
    ]


def test_trim_blank_takes_every_white_space(spark):
    assert column(spark, ["\t a b \n", "   ", None], fn.trim_blank) == ["a b", "", None]
    assert column(spark, ["\u00a0 a\u00a0b\u2003", "\u3000"], fn.trim_blank) == ["a\u00a0b", ""]


def test_statuses(spark):
    raw = [*values.STATUS_LABELS, "DELIVERED", "Canceled", "mystery", " delivered", None]
    expected = [*values.STATUS_LABELS.values(), "completed", "cancelled", "pending", "pending", "pending"]
    assert column(spark, raw, fn.order_status) == expected


def test_categories(spark):
    known = [(n, g) for g, names in values.CATEGORY_GROUPS.items() for n in names]
    assert len(known) == 71
    raw = [n for n, _ in known] + [" Food_Drink\t", "none of these", None, ""]
    expected = [g for _, g in known] + ["Food & Beverage"] + ["Home & Living"] * 3
    assert column(spark, raw, fn.category_group) == expected


def test_age_bands(spark):
    ages = [15, 16, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 100, None]
    assert column(spark, ages, fn.age_group, "int") == [
        "55+", "55+", "55+", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+", "55+",
    ]


def test_derived_age_depends_on_key_and_seed_only(spark):
    keys = [f"person-{i}" for i in range(2000)]
    first = column(spark, keys, lambda c: fn.derived_age(c, 42))
    assert set(first) == set(range(18, 66))
    assert column(spark, keys[::-1], lambda c: fn.derived_age(c, 42)) == first[::-1]
    assert column(spark, keys, lambda c: fn.derived_age(c, 43)) != first


def test_unreadable_times_become_the_default(spark):
    now = datetime(2018, 1, 2, 3, 4, 5)
    texts = ["2017-10-15 23:59:59", "2017-10-15", "not a time", "", None, "2017-13-40 00:00:00"]
    assert column(spark, texts, lambda c: fn.timestamp_or(c, now)) == [
        datetime(2017, 10, 15, 23, 59, 59), datetime(2017, 10, 15), now, now, now, now,
    ]
    day_first = column(spark, ["15/10/2017", "2017-10-15"], lambda c: fn.timestamp_or(c, now, "dd/MM/yyyy"))
    assert day_first == [datetime(2017, 10, 15), now]


def _exact(numerator: int, denominator: int, factor: int):
    if denominator == 0:
        return None
    whole, rest = divmod(2 * factor * abs(numerator) + abs(denominator), 2 * abs(denominator))
    return Decimal(-whole if (numerator < 0) != (denominator < 0) else whole) / 100


def test_quotients_round_half_away_from_zero_at_any_size(spark):
    big = 9_000_000_000_000_000_000
    pairs = [
        (1, 8), (-1, 8), (1, -8), (0, 5), (5, 0), (1, 3), (2, 3), (12345, 100000), (-12345, 100000), (1, 200000),
        (-1, 200000), (big, big), (big - 1, big), (10**14, 3), (10**15, 3 * 10**15),
        (461168601842738, 7 * 10**14), (None, 4), (4, None),
    ]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    rows = df.orderBy("i").select(fn.percent(F.col("a"), F.col("b")), fn.average(F.col("a"), F.col("b"))).collect()
    for (a, b), (share, mean) in zip(pairs, rows):
        if a is None or b is None:
            assert share is None and mean is None
        else:
            assert share == _exact(a, b, 10_000), (a, b)
            assert mean == _exact(a, b, 1), (a, b)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**17, 10**17), st.integers(-10**6, 10**6)), min_size=200, max_size=300))
def test_quotients_random(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    got = [r[0] for r in df.orderBy("i").select(fn.average(F.col("a"), F.col("b"))).collect()]
    assert got == [_exact(a, b, 1) for a, b in pairs]


def test_cents_round_trip(spark):
    amounts = [Decimal("0.01"), Decimal("-12.34"), Decimal("9999999999999.99"), None]
    assert column(spark, amounts, fn.cents, "decimal(18,2)") == [1, -1234, 999999999999999, None]
    assert column(spark, amounts, lambda c: fn.from_cents(fn.cents(c)), "decimal(18,2)") == amounts


def test_half_cent_is_away_from_zero():
    assert _exact(1, 2, 1) == Decimal("0.01") == Decimal("0.005").quantize(Decimal("0.01"), ROUND_HALF_UP)
