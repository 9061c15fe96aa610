"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Copies are combined three times, always by the whole normalised text beside its digest: inside each map
task, in salted digest groups, and over the winners of the salts. A hot text therefore leaves a map task
once, is spread over the salts, and meets in one group only as one row per salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import lower_ascii, stored

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, and all empty texts are
    one group. The largest doc_id of a group stays; rows that repeat it are all kept, and a null doc_id
    stays only in a group without any other. Only doc_id and text are read, so other columns may have any
    name. No rows give no rows. ``digest`` only speeds up the comparison: texts that share a digest are
    still told apart by their content.
    """
    rows = docs.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("norm")).select(
        "doc_id", "norm", digest(F.col("norm")).alias("digest"))
    # groupBy combines inside each map task first, so a text is shuffled once per task that holds it
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n")))
    winners = salted.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    # after the content was compared the groups travel without it; texts is 1 unless digests collide
    narrow = stored(winners.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("texts")), "exact-groups")
    found = rows.select("doc_id", "digest", F.sha2("norm", 256).alias("text_sha256")).join(
        narrow.where("texts = 1"), "digest")
    clashing = narrow.where("texts > 1").select("digest")
    if not clashing.isEmpty():
        apart = rows.join(clashing, "digest", "left_semi")
        found = found.drop("texts").unionByName(
            apart.withColumn("text_sha256", F.sha2("norm", 256)).join(winners, ["digest", "norm"]).drop("norm"))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one for each different text.

    Rows of the same doc_id and text are one document: one of them stays.
    """
    keys = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id_key")]
    kept = exact_groups(docs).where("kept").select(*keys, "text_sha256").distinct()
    text_key = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256).alias("text_sha256")
    rows = docs.select(*keys, text_key, F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"))
    # both steps go by the same keys, so rows are shuffled once
    once = rows.join(kept, ["id_key", "text_sha256"], "left_semi").dropDuplicates(["id_key", "text_sha256"])
    return once.select("whole_row.*")
