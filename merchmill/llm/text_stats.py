"""Counts of a text as Spark columns; no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import BLANKS, UPPER

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _windows(words: str, value) -> Column:
    return F.when(F.size(words) > WINDOW, F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), value))


def text_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, then n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_upper, n_digits, n_exclaim, n_distinct_words of the whole text.

    A null or empty text has no words and all counts are 0. Repeated windows of eight words are looked
    for by hash; only texts in which two hashes agree compare the windows themselves.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keep, text.alias("_t"))
    split = base.select(
        *keep, "_t", F.array_remove(F.split("_t", r"[\x20\x09-\x0D]+"), "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0).alias("_l"))
    hashed = split.select(
        *keep, "_t", "_w", "_l",
        _windows("_w", lambda i: F.xxhash64(F.slice("_w", i + 1, F.lit(WINDOW)))).alias("_h"))
    suspect = F.size(F.array_distinct("_h")) < F.size("_h")
    paired = hashed.select(
        *keep, "_t", "_w", "_l",
        F.when(suspect, F.sort_array(_windows("_w", lambda i: F.struct(
            F.array_join(F.slice("_w", i + 1, F.lit(WINDOW)), " ").alias("w"), i.alias("p"))))).alias("_s"))

    def repeated(x: Column, i: Column) -> Column:
        s = F.col("_s")
        before = (i > 0) & (F.get(s, i - 1)["w"] == x["w"])
        after = (i + 1 < F.size(s)) & (F.get(s, i + 1)["w"] == x["w"])
        return before | after

    placed = paired.select(
        *keep, "_t", "_w", "_l",
        F.sort_array(F.transform(F.filter("_s", repeated), lambda x: x["p"])).alias("_p"))
    covered = F.aggregate(
        "_p", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    t, n = F.col("_t"), "long"
    return placed.select(
        *keep,
        F.size("_w").cast(n).alias("n_words"),
        (F.length(t) - _without(t, BLANKS)).cast(n).alias("word_chars"),
        _without(t, SYMBOLS).cast(n).alias("n_symbols"),
        F.size("_l").cast(n).alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast(n).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast(n).alias("n_repeat_words"),
        _without(t, UPPER).cast(n).alias("n_upper"),
        _without(t, "0123456789").cast(n).alias("n_digits"),
        _without(t, "!").cast(n).alias("n_exclaim"),
        F.size(F.array_distinct("_w")).cast(n).alias("n_distinct_words"),
    )
