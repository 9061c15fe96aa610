"""Operators on keys: first row per key, semi and anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], for_join: bool = False
) -> DataFrame:
    """Keep one row per key: the first in the stated order.

    ``row_number() = 1`` lets Spark drop all but one row per key in every map task before the
    shuffle (WindowGroupLimit), so a hot key sends at most one row per task. ``for_join`` is for a
    lookup table that many rows are then joined to, see ``_apart``.
    """
    parts = [*keys, _apart(keys)] if for_join else keys
    place = F.row_number().over(W.partitionBy(*parts).orderBy(*order_by))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def _apart(keys: Sequence[str]) -> Column:
    """An extra grouping term that follows from the keys and so changes no group.

    Spark splits a skewed join at run time only where both inputs come straight from their own
    exchange. A lookup table grouped by exactly the join key would be joined without one. With this
    term it is partitioned otherwise, the join exchanges it once more, and a hot key on the other
    side can be split.
    """
    return F.xxhash64(*keys)


def known_keys(table: DataFrame, key: str, flag: str) -> DataFrame:
    """Distinct non-NULL keys with a marker column, as a lookup for a left join."""
    keys = table.where(F.col(key).isNotNull()).groupBy(key, _apart([key]).alias("_apart")).agg(F.lit(True).alias(flag))
    return keys.select(key, flag)


def matching_keys(df: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``batch``."""
    return df.join(batch.select(*keys), list(keys), "left_semi")


def without_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` yet.

    The target is first cut down to the keys of the batch. For a daily batch Spark broadcasts those
    few keys, so a target of any size is only scanned for its key columns and never shuffled; for a
    large batch both joins run as sort-merge joins on the same key.
    """
    known = matching_keys(target.select(*keys), batch, keys)
    return batch.join(known, list(keys), "left_anti")
