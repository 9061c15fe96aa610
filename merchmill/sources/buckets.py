"""Tables in folders by a hash of their key, from which the rows of a few keys are read without the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from merchmill.sources.storage import COMPRESSION

BUCKET = "key_bucket"
#: the range of the number of buckets; a power of two
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 14


def bucket_count(rows: int, per_bucket: int) -> int:
    """How many buckets hold ``rows`` rows at about ``per_bucket`` each."""
    wanted = max(LEAST_BUCKETS, min(MOST_BUCKETS, rows // per_bucket))
    return 1 << (wanted - 1).bit_length()


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], buckets: int, mode: str = "append") -> None:
    """Write or add rows, sorted by key inside a bucket's files; a large bucket gets several files."""
    arranged = df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(BUCKET))
    arranged.sortWithinPartitions(BUCKET, *keys).write.mode(mode).option("compression", COMPRESSION).partitionBy(BUCKET).parquet(path)


def read_buckets(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int, batch: DataFrame | None = None
) -> DataFrame:
    """The table, or its rows with a key of ``batch`` (cheap to read): then only those keys' buckets are read.

    ``schema`` is that of the rows without the bucket.
    """
    table = spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    if batch is None:
        return table.drop(BUCKET)
    wanted = batch.select(*keys, bucket_of(keys, buckets))
    numbers = [r[0] for r in wanted.select(BUCKET).distinct().collect()]  # at most the number of buckets
    table = table.where(F.col(BUCKET).isin(*numbers) if numbers else F.lit(False))
    return table.join(wanted, [*keys, BUCKET], "left_semi").drop(BUCKET)
