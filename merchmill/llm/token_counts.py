"""Exact token counts for every context limit, from a histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchmill.llm.common import rows_of, stored, token_encoder, vocabulary_paths

#: Lengths summed in one group before the groups are put in order; the result doesn't depend on it.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens of the whole text. Null counts as empty: 0 tokens."""
    paths = paths or vocabulary_paths()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(*paths)
        for batch in rows_of(batches):
            lengths = [len(encode(t)) // 4 if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "doc_id long, n_tokens long")


def length_histogram(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """n_tokens, docs: how many documents have each encoded length."""
    return encoded_lengths(docs, paths).groupBy("n_tokens").agg(F.count("*").alias("docs"))


def totals_by_limit(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, taken as a context limit: what fits and what is cut off.

    context_limit; docs of that length; docs_over it; docs_upto it; tokens_upto: their tokens;
    tokens_truncated: tokens of all documents when each is cut at the limit; tokens_lost by that;
    quantile: the share of documents up to the limit. Between two lengths that occur, tokens_truncated
    grows by docs_over a token, so these rows answer every limit. A histogram without rows gives none.

    Suffix sums run in two steps, inside blocks of ``BLOCK`` lengths and over the blocks' totals. There
    are at most sqrt(2 * all tokens) different lengths.
    """
    h = histogram.select("n_tokens", "docs", F.expr(f"n_tokens div {BLOCK}").alias("block"))
    blocks = h.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(F.expr("docs * n_tokens")).alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = blocks.select("block", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
                          F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = h.select("*", F.coalesce(F.sum("docs").over(inside), F.lit(0)).alias("d_in"),
                    F.coalesce(F.sum(F.expr("docs * n_tokens")).over(inside), F.lit(0)).alias("t_in")).join(later, "block")
    rows = over.select("n_tokens", "docs", (F.col("d_in") + F.col("d_after")).alias("docs_over"),
                       (F.col("t_in") + F.col("t_after")).alias("tokens_over"), "all_docs", "all_tokens")
    return rows.select(
        F.col("n_tokens").alias("context_limit"), "docs", "docs_over",
        (F.col("all_docs") - F.col("docs_over")).alias("docs_upto"),
        (F.col("all_tokens") - F.col("tokens_over")).alias("tokens_upto"),
        (F.col("all_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
        (F.col("tokens_over") - F.col("docs_over") * F.col("n_tokens")).alias("tokens_lost"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("quantile"))


def token_counts(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``totals_by_limit`` of whole texts. Null and empty texts have 0 tokens; repeated rows count each."""
    return totals_by_limit(stored(length_histogram(docs, paths), "length-histogram"))
