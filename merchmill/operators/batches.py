"""Selecting the rows of one business day, with a fixed-size batch and a repeatable top-up."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merchmill.sources.storage import materialise


def day_rows(df: DataFrame, day: date, column: str = "order_date") -> DataFrame:
    return df.where(F.col(column) == F.lit(day))


def other_rows(df: DataFrame, day: date, column: str = "order_date") -> DataFrame:
    return df.where(F.col(column) != F.lit(day))


def draw_order(seed: int, keys: Sequence[str]) -> Column:
    """Repeatable random order: depends on the seed and the row's key only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))


def head_rows(df: DataFrame, count: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``count`` rows in the order of some columns, NULL first, by one path for every count.

    Each hash group of rows first drops what lies behind its own first ``count``, in every map task and
    before any shuffle. The rest is range-partitioned and stored sorted, with the number of its range.
    Ranges before the cut are then taken whole, and only the one range in which the cut lies is numbered.
    ``df`` is read once. The driver gets one count for each range.
    """
    spark = df.sparkSession
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_group", F.pmod(F.xxhash64(*order_by), F.lit(groups)))
    first = F.row_number().over(W.partitionBy("_group").orderBy(*order_by))
    ahead = spread.withColumn("_place", first).where(F.col("_place") <= count).drop("_group", "_place")
    ordered = materialise(
        ahead.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_range", F.spark_partition_id()), "head"
    )
    sizes = sorted((r["_range"], r["count"]) for r in ordered.groupBy("_range").count().collect())
    taken = 0
    for number, size in sizes:
        if taken + size > count:
            place = F.row_number().over(W.partitionBy("_range").orderBy(*order_by))
            edge = ordered.where(F.col("_range") == number).withColumn("_place", place)
            kept = edge.where(F.col("_place") <= count - taken).drop("_place")
            return ordered.where(F.col("_range") < number).unionByName(kept).drop("_range")
        taken += size
    return ordered.drop("_range")


def top_up(df: DataFrame, day: date, count: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """An exact-size draw without replacement from the other days, moved to midnight of ``day``."""
    drawn = other_rows(df, day).withColumn("_draw", draw_order(seed, keys))
    return restamp(head_rows(drawn, count, ["_draw", *keys]).drop("_draw"), day)


def restamp(df: DataFrame, day: date, moved: Column | None = None) -> DataFrame:
    """Put rows (those that are ``moved``) at midnight of ``day``."""
    midnight = F.lit(f"{day:%Y-%m-%d} 00:00:00").cast("timestamp_ntz")
    stamp = midnight if moved is None else F.when(moved, midnight).otherwise(F.col("created_at"))
    return df.withColumns({"created_at": stamp, "order_date": F.lit(day)})


def take_batch(df: DataFrame, day: date, count: int | None, seed: int, keys: Sequence[str]) -> DataFrame:
    """The day's rows, capped at ``count`` and topped up to it from other days.

    ``count=None`` takes the whole day and adds nothing. The day's own rows go by key ahead of all others
    in draw order, so how many the day has need not be known, and ``df`` is read once.
    """
    if count is None:
        return day_rows(df, day)
    other = F.col("order_date") != F.lit(day)
    ordered = df.where(F.col("order_date").isNotNull()).withColumns(
        {"_extra": other, "_draw": F.when(other, draw_order(seed, keys))}
    )
    chosen = head_rows(ordered, count, ["_extra", "_draw", *keys])
    return restamp(chosen, day, moved=F.col("_extra")).drop("_extra", "_draw")
