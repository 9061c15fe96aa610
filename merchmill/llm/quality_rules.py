"""Quality rules with adaptive thresholds, in DataFrame operations only.

Every threshold is read from mergeable quantile sketches of the corpus, per language and source. A sketch here
is a histogram with buckets of bounded relative width (below 16 exact, above that within one sixteenth), so
sketches merge by adding counts, in any order and with the same result. A rate's fence lies ``REACH``
interquartile ranges beyond the quartile, or at the quantile that leaves ``TAIL`` percent of the documents
outside, whichever is further: where most documents have the same rate, such as none, the quartiles alone would
set aside whoever differs at all. A group's fences are averaged with those of its language, and a language's with
those of all documents, weighted by their documents and ``TRUST`` documents for the larger group, so that a small
source is judged nearly as its language and a large one by itself, without a jump between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchmill.llm.common import stored
from merchmill.llm.text_stats import text_counts

#: A fence lies this many interquartile ranges beyond the quartile, and at least where this share (percent) is outside.
REACH, TAIL = 3, 10
#: Documents of a language that count in the fences of each of its sources, and of all in those of each language.
TRUST = 50

#: name -> rate, an integer: parts of ten thousand, or hundredths of a character.
RATES = {
    "symbols": "n_symbols * 10000 div greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines * 10000 div greatest(n_lines, 1)",
    "repeats": "n_repeat_words * 10000 div greatest(n_words, 1)",
    "upper": "n_upper * 10000 div greatest(word_chars, 1)",
    "exclaims": "n_exclaim * 10000 div greatest(word_chars, 1)",
    "word_length": "word_chars * 100 div greatest(n_words, 1)",
}


def bucket(value: str) -> Column:
    """The largest value of the sketch bucket that ``value`` (a long of 0 or more) falls into."""
    shift = f"greatest(length(bin({value})) - 5, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}) + 1, {shift}) - 1")


def sketches(rates: DataFrame) -> DataFrame:
    """Sketches of columns ``RATES`` by (language, source), by language and of all, as rows of counts."""
    long = rates.select("language", "origin", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rate"), F.col(name).alias("value")) for name in RATES])).alias("r"))
    counted = long.groupBy("language", "origin", F.col("r.rate").alias("rate"), bucket("r.value").alias("bucket")).agg(F.count("*").alias("n"))
    # merging two sketches is adding their counts
    merged = [counted.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n")).select(
        *[(F.col(k) if k in keys else F.lit(None).cast("string")).alias(k) for k in ("language", "origin")],
        F.lit(len(keys)).alias("level"), "rate", "bucket", "n") for keys in (["language", "origin"], ["language"], [])]
    return merged[0].unionByName(merged[1]).unionByName(merged[2])


def fences(sketch: DataFrame) -> DataFrame:
    """Per group and level: n documents, and for each rate its fences <rate>_low and <rate>_high, from its own sketch."""
    keys = ["level", "language", "origin", "rate"]
    order = Window.partitionBy(*keys).orderBy("bucket")  # buckets of one rate: some hundreds at most
    seen = sketch.withColumn("upto", F.sum("n").over(order)).withColumn("of", F.sum("n").over(Window.partitionBy(*keys)))
    quantile = lambda percent: F.min(F.when(F.col("upto") * 100 >= F.col("of") * percent, F.col("bucket")))
    by_rate = seen.groupBy(*keys).agg(
        quantile(25).alias("q1"), quantile(75).alias("q3"), quantile(TAIL).alias("first"), quantile(100 - TAIL).alias("last"), F.max("of").alias("n"))
    gap = (F.col("q3") - F.col("q1")) * REACH
    at = lambda name, c: F.max(F.when(F.col("rate") == name, c))
    return by_rate.groupBy("level", "language", "origin").agg(
        F.max("n").alias("n"),
        *[at(r, F.greatest(F.col("q3") + gap, "last")).alias(f"{r}_high") for r in RATES],
        *[at(r, F.greatest(F.least(F.col("q1") - gap, "first"), F.lit(0))).alias(f"{r}_low") for r in RATES])


def thresholds(rates: DataFrame) -> DataFrame:
    """Fences for each (language, origin) that occurs: its own averaged with its language's, these with those of all."""
    levels = stored(fences(sketches(rates)), "fences")
    names = [f"{r}_{side}" for r in RATES for side in ("low", "high")]
    part = lambda level, tag: levels.where(F.col("level") == level).select(
        "language", "origin", F.col("n").alias(f"n_{tag}"), *[F.col(c).alias(f"{c}_{tag}") for c in names])
    own, lang = part(2, "own"), part(1, "lang").drop("origin")
    whole = part(0, "all").drop("language", "origin").withColumn("one", F.lit(1))  # one row
    both = own.join(lang, "language").withColumn("one", F.lit(1)).join(whole, "one")
    of_lang = lambda c: f"((n_lang * {c}_lang + {TRUST} * {c}_all) div (n_lang + {TRUST}))"
    return both.select("language", "origin", *[
        F.expr(f"(n_own * {c}_own + {TRUST} * {of_lang(c)}) div (n_own + {TRUST})").alias(c) for c in names])


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept, and the rates.

    A null or empty text has no words, fails the base rule and is not kept. A null language or source is a
    group of its own. Documents that fail the base rule are left out of the sketches. Repeated rows are
    judged alike; no rows give no rows. Only doc_id, text, lang and source are read.
    """
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit(""))
    keyed = docs.select("doc_id", "text", key("lang").alias("language"), key("source").alias("origin"))
    counts = text_counts(keyed, ["doc_id", "language", "origin"])
    rated = stored(counts.withColumns(
        {"base_failed": F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")} | {k: F.expr(v) for k, v in RATES.items()}), "quality-counts")
    limits = thresholds(rated.where("NOT base_failed"))
    inside = F.lit(True)
    for r in RATES:
        inside = inside & (F.col(r) <= F.col(f"{r}_high"))
    inside = inside & (F.col("word_length") >= F.col("word_length_low"))
    return rated.join(limits, ["language", "origin"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"), *RATES)


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '') AS language, coalesce('=' || source, '') AS origin,
         row_number() OVER () AS rid FROM documents),
c AS (
  SELECT rid, doc_id, language, origin, t,
         [x for x in string_split_regex(t, '[\x20\x09-\x0D]+') if x <> ''] AS w,
         [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM t),
win AS (
  SELECT rid, i, array_to_string(w[i:i+7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM c WHERE len(w) >= 8)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS k FROM win) WHERE k > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY rid),
counts AS (
  SELECT c.rid, doc_id, language, origin, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaim
  FROM c LEFT JOIN cov ON c.rid = cov.rid),
rated AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_symbols * 10000 // greatest(word_chars, 1) AS symbols, n_dup_lines * 10000 // greatest(n_lines, 1) AS dup_lines,
         n_repeat_words * 10000 // greatest(n_words, 1) AS repeats, n_upper * 10000 // greatest(word_chars, 1) AS upper_,
         n_exclaim * 10000 // greatest(word_chars, 1) AS exclaims, word_chars * 100 // greatest(n_words, 1) AS word_length
  FROM counts),
long AS (
  SELECT language, origin, unnest(['symbols', 'dup_lines', 'repeats', 'upper', 'exclaims', 'word_length']) AS rate,
         unnest([symbols, dup_lines, repeats, upper_, exclaims, word_length]) AS v FROM rated WHERE NOT base_failed),
b AS (
  SELECT language, origin, rate, (((v >> s) + 1) << s) - 1 AS bucket
  FROM (SELECT *, greatest(length(bin(v)) - 5, 0) AS s FROM long)),
levels AS (
  SELECT 2 AS level, language, origin, rate, bucket, count(*) AS n FROM b GROUP BY ALL
  UNION ALL SELECT 1, language, NULL, rate, bucket, count(*) FROM b GROUP BY ALL
  UNION ALL SELECT 0, NULL, NULL, rate, bucket, count(*) FROM b GROUP BY ALL),
seen AS (
  SELECT *, sum(n) OVER (PARTITION BY level, language, origin, rate ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY level, language, origin, rate) AS of_ FROM levels),
q AS (
  SELECT level, language, origin, rate, max(of_) AS n, min(bucket) FILTER (upto * 100 >= of_ * 25) AS q1, min(bucket) FILTER (upto * 100 >= of_ * 75) AS q3,
         min(bucket) FILTER (upto * 100 >= of_ * 10) AS first_, min(bucket) FILTER (upto * 100 >= of_ * 90) AS last_
  FROM seen GROUP BY level, language, origin, rate),
f AS (SELECT level, language, origin, rate, n::HUGEINT AS n, greatest(q3 + 3 * (q3 - q1), last_) AS high, greatest(least(q1 - 3 * (q3 - q1), first_), 0) AS low FROM q),
lang AS (
  SELECT l.language, l.rate, (l.n * l.high + 50 * a.high) // (l.n + 50) AS high, (l.n * l.low + 50 * a.low) // (l.n + 50) AS low
  FROM f l JOIN f a ON a.level = 0 AND a.rate = l.rate WHERE l.level = 1),
pick AS (
  SELECT o.language, o.origin, o.rate, (o.n * o.high + 50 * l.high) // (o.n + 50) AS high, (o.n * o.low + 50 * l.low) // (o.n + 50) AS low
  FROM f o JOIN lang l ON l.language = o.language AND l.rate = o.rate WHERE o.level = 2),
bad AS (
  SELECT DISTINCT r.rid FROM rated r JOIN pick p ON r.language = p.language AND r.origin = p.origin
  WHERE CASE p.rate WHEN 'symbols' THEN symbols WHEN 'dup_lines' THEN dup_lines WHEN 'repeats' THEN repeats WHEN 'upper' THEN upper_
             WHEN 'exclaims' THEN exclaims ELSE word_length END > p.high OR p.rate = 'word_length' AND word_length < p.low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM rated
"""
