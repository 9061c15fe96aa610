"""Exact order statistics that never bring a whole group to one task.

Both the median and the rank need, for each value in a group, how many rows lie below it. Rows are
first collapsed to one row per distinct value with a count (combined map-side, so a hot group or a
hot value costs one row per task). Running counts are then taken at two levels: over coarse buckets
of the value, and inside each bucket. However many rows a group has, a window partition holds at most
``BUCKET_WIDTH`` narrow rows, or one row per bucket in use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from merchmill.functions.money import cents

_BUCKET_BITS = 20
BUCKET_WIDTH = 1 << _BUCKET_BITS


def running_counts(
    histogram: DataFrame, group: Sequence[str], value: str, count: str, wanted: Column | None = None,
    null_groups: bool = True,
) -> DataFrame:
    """Add ``below`` (rows of the group with a smaller value) and ``total`` (rows of the group).

    ``histogram`` has one row per group and distinct whole-number ``value``. ``wanted`` may narrow
    the result to some buckets by ``bucket_below``, ``bucket_upto`` and ``total``. Without
    ``null_groups`` rows of a NULL group are left out, and the bucket sums, the join and the last window
    share one partitioning by group and bucket.
    """
    # a bucket that can't be NULL adds no filter to one of the two uses of the histogram, and the greatest value
    # makes the second one need the same columns: so Spark makes the histogram once and reuses its exchange
    histogram = histogram.withColumn("_bucket", F.coalesce(F.shiftright(value, _BUCKET_BITS), F.lit(0)))
    if not null_groups:
        histogram = histogram.repartition(*group, "_bucket")
    in_group = W.partitionBy(*group)
    buckets = histogram.groupBy(*group, "_bucket").agg(F.sum(count).alias("_rows"), F.max(value).alias("_top")).select(
        *group,
        "_bucket",
        "_top",
        F.sum("_rows").over(in_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)).alias("bucket_upto"),
        F.sum("_rows").over(in_group).alias("total"),
        "_rows",
    ).withColumn("bucket_below", F.col("bucket_upto") - F.col("_rows")).drop("_rows")
    if wanted is not None:
        buckets = buckets.where(wanted)
    # groups may be NULL (a day that is not known), so match them null-safely
    buckets = buckets.select(*[F.col(g).alias(f"_b_{g}") for g in [*group, "_bucket"]],
                             "bucket_below", "bucket_upto", "total", "_top")
    pairs = [(F.col(g), F.col(f"_b_{g}")) for g in [*group, "_bucket"]]
    same = [a.eqNullSafe(b) if null_groups else a == b for a, b in pairs]
    at_most = F.coalesce(value, F.lit(0)) <= F.coalesce("_top", F.lit(0))
    joined = histogram.join(buckets, [*same, at_most], "inner")
    in_bucket = W.partitionBy(*group, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    below = F.col("bucket_below") + F.sum(count).over(in_bucket) - F.col(count)
    return joined.select(*group, value, count, below.alias("below"), "total")


def value_counts(df: DataFrame, key: str, amount: str, value: str = "cents", count: str = "n") -> DataFrame:
    """How many rows of a key have an amount: key, the amount in cents, rows. NULL keys and amounts are left out.

    Counts of several batches can be added up, so they can be stored and a median taken without the rows.
    """
    known = df.where(F.col(key).isNotNull() & F.col(amount).isNotNull())
    return known.groupBy(key, cents(F.col(amount)).alias(value)).agg(F.count(F.lit(1)).alias(count))


def median_of_counts(counts: DataFrame, key: str, value: str, count: str, out: str) -> DataFrame:
    """Exact median per key from ``value_counts``, one row per key and value."""
    low = F.expr("(total - 1) div 2")
    high = F.expr("total div 2")
    hit = ((F.col("bucket_below") <= low) & (low < F.col("bucket_upto"))) | (
        (F.col("bucket_below") <= high) & (high < F.col("bucket_upto"))
    )
    counted = running_counts(counts, [key], value, count, wanted=hit, null_groups=False)
    upto = F.col("below") + F.col(count)
    middle = counted.where(
        ((F.col("below") <= low) & (low < upto)) | ((F.col("below") <= high) & (high < upto))
    )
    half = (F.min(value) + F.max(value)) * F.lit(5)
    return middle.groupBy(key).agg((half.cast("decimal(21,0)") / F.lit(1000)).cast("decimal(21,3)").alias(out))


def exact_median(df: DataFrame, key: str, amount: str, out: str) -> DataFrame:
    """Exact median of a two-place money column per key; NULL keys and amounts are left out.

    For an even number of rows it is the mean of the two middle ones, hence three decimal places.
    """
    return median_of_counts(value_counts(df, key, amount), key, "cents", "n", out)


def approx_median(df: DataFrame, key: str, amount: str, out: str, accuracy: int = 10_000) -> DataFrame:
    """An amount that occurs, at a rank within 1 / ``accuracy`` of the middle; NULL keys and amounts are left out.

    One shuffle of a bounded summary per key, where ``exact_median`` shuffles every distinct amount.
    """
    known = df.where(F.col(key).isNotNull() & F.col(amount).isNotNull())
    middle = F.percentile_approx(cents(F.col(amount)), 0.5, accuracy)
    return known.groupBy(key).agg((middle.cast("decimal(21,0)") / F.lit(100)).cast("decimal(21,3)").alias(out))


def rank_descending(df: DataFrame, group: str, amount: str, out: str) -> DataFrame:
    """SQL RANK over a two-place money column, largest first, NULL last, per group.

    Ties share a rank and leave a gap. ``df`` is read twice, so pass something cheap to read such as
    a written table.
    """
    last = (1 << 62)
    falling = F.coalesce(-cents(F.col(amount)), F.lit(last))
    keyed = df.withColumn("_falling", falling)
    histogram = keyed.groupBy(group, "_falling").agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_counts(histogram, [group], "_falling", "_n").select(
        F.col(group).alias("_g"), F.col("_falling").alias("_f"), (F.col("below") + 1).alias(out)
    )
    same = [F.col(group).eqNullSafe(F.col("_g")), F.col("_falling") == F.col("_f")]
    return keyed.join(ranks, same, "inner").drop("_falling", "_g", "_f")
