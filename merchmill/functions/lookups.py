"""Label lookups and bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from merchmill import values
from merchmill.functions.text import trim_blank


def _label(key: Column, groups: dict[str, list[str]], default: str) -> Column:
    """One membership test per label; long lists become hash sets, so no row walks the whole table."""
    branches = [(key.isin(*names), label) for label, names in groups.items()]
    (first, label), *rest = branches
    chain = reduce(lambda c, b: c.when(b[0], b[1]), rest, F.when(first, label))
    return chain.otherwise(F.lit(default))


def order_status(raw: Column) -> Column:
    """Shop status of a source status in any case; unknown and missing ones are pending."""
    groups: dict[str, list[str]] = {}
    for name, label in values.STATUS_LABELS.items():
        groups.setdefault(label, []).append(name)
    return _label(F.lower(raw.cast("string")), groups, values.DEFAULT_STATUS)


def category_group(english_name: Column) -> Column:
    """Shop category of an English category name; case and outer blanks do not matter."""
    key = trim_blank(F.lower(english_name.cast("string")))
    return _label(key, {g: list(n) for g, n in values.CATEGORY_GROUPS.items()}, values.DEFAULT_CATEGORY)


def age_group(age: Column) -> Column:
    """Age band. Everything outside the listed bands, NULL included, is in the last one."""
    (low, high), *rest = values.AGE_BANDS
    chain = F.when(age.between(low, high), f"{low}-{high}")
    for low, high in rest:
        chain = chain.when(age.between(low, high), f"{low}-{high}")
    return chain.otherwise(F.lit(values.OLDEST_BAND))


def derived_age(key: Column, seed: int) -> Column:
    """A stand-in age for sources without one: fixed by seed and key, whatever the row order."""
    width = values.DERIVED_AGE_MAX - values.DERIVED_AGE_MIN + 1
    digest = F.md5(F.concat(F.lit(str(seed)), key))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (F.lit(values.DERIVED_AGE_MIN) + number % F.lit(width)).cast("int")
