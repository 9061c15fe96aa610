"""Quality classifier: a sparse ensemble of rules, compiled into Spark column expressions.

Small trees are grown on statistics of labelled texts, the path to every node becomes a conjunctive rule,
a logistic model with an L1 penalty keeps few of the rules, and those are scored as plain columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import stored
from merchmill.llm.text_stats import text_counts

#: Labelled rows that a fit takes at most (those of the smallest hash of their doc_id); they go to the driver.
SAMPLE_ROWS = 20_000
CUTOFF = 0.3

#: Statistics of a text, from the counts of ``text_counts``.
STATISTICS = {
    "words": "double(n_words)",
    "word_length": "n_word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_word_chars, 1)",
    "upper_share": "n_upper / greatest(n_word_chars, 1)",
    "digit_share": "n_digits / greatest(n_word_chars, 1)",
    "exclaim_share": "n_exclaim / greatest(n_word_chars, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most the bound or above it, bound)


@dataclass
class RuleModel:
    intercept: float
    weights: list[float] = field(default_factory=list)
    rules: list[Rule] = field(default_factory=list)

    def score(self) -> Column:
        """The probability of label 1 as an expression over the columns ``STATISTICS``."""
        names = list(STATISTICS)
        total = F.lit(float(self.intercept))
        for weight, rule in zip(self.weights, self.rules):
            holds = F.lit(True)
            for statistic, low, bound in rule:
                c = F.col(names[statistic])
                holds = holds & (c <= F.lit(bound) if low else c > F.lit(bound))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        names = list(STATISTICS)
        return [f"{w:+.3f} if " + " and ".join(f"{names[s]} {'<=' if low else '>'} {b:.6g}" for s, low, b in rule)
                for w, rule in zip(self.weights, self.rules)]


def _tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, least: int) -> list[Rule]:
    """The paths to all nodes but the root of one tree that splits by squared error."""
    rules: list[Rule] = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            rules.append(path)
        if len(path) == depth or len(rows) < 2 * least or np.ptp(y[rows]) == 0:
            return
        best = (1e-9, -1, 0.0)
        for s in rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False):
            order = rows[np.argsort(x[rows, s], kind="stable")]
            v, t = x[order, s], np.cumsum(y[order])
            n = np.arange(1, len(order))
            cut = (v[1:] > v[:-1]) & (n >= least) & (n <= len(order) - least)
            if cut.any():
                left, right = t[:-1], t[-1] - t[:-1]
                gain = np.where(cut, left**2 / n + right**2 / (len(order) - n) - t[-1] ** 2 / len(order), -1)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], int(s), float((v[at] + v[at + 1]) / 2))
        if best[1] >= 0:
            low = x[rows, best[1]] <= best[2]
            grow(rows[low], (*path, (best[1], True, best[2])))
            grow(rows[~low], (*path, (best[1], False, best[2])))

    grow(np.arange(len(x)), ())
    return rules


def _holds(x: np.ndarray, rule: Rule) -> np.ndarray:
    out = np.ones(len(x), bool)
    for s, low, bound in rule:
        out &= x[:, s] <= bound if low else x[:, s] > bound
    return out


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 2e-3, steps: int = 600, seed: int = 7) -> RuleModel:
    """Fit on statistics ``x`` and labels ``y`` of 0 and 1. Labels of one kind, or none, give a constant."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    centred, found = y - y.mean(), {}
    for _ in range(trees):
        rows = rng.choice(len(x), max(20, len(x) // 2))
        for rule in _tree(x[rows], centred[rows], rng, depth, max(3, len(rows) // 500)):
            found.setdefault(_holds(x, rule).tobytes(), rule)  # one rule for each set of rows
    rules = list(found.values())
    m = np.stack([_holds(x, r) for r in rules], axis=1).astype(np.float64)
    scale = np.maximum(np.sqrt(m.var(0)), 0.05)
    z = (m - m.mean(0)) / scale
    lipschitz = 0.25 * np.linalg.norm(z, 2) ** 2 / len(y)
    w = v = np.zeros(z.shape[1])
    b, t = float(np.log(y.mean() / (1 - y.mean()))), 1.0
    for _ in range(steps):  # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(b + z @ v)))
        b -= 2 * (p - y).mean()
        step = v - z.T @ (p - y) / len(y) / lipschitz
        new = np.sign(step) * np.maximum(np.abs(step) - penalty / lipschitz, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    kept = np.flatnonzero(w)
    return RuleModel(float(b - (w / scale * m.mean(0)).sum()), list((w / scale)[kept]), [rules[i] for i in kept])


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    counts = text_counts(docs, keep).withColumnRenamed("word_chars", "n_word_chars")
    return counts.select(*keep, *[F.expr(e).alias(n) for n, e in STATISTICS.items()])


def held_out() -> Column:
    return F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 5 = 0"), F.lit(False))


def fit(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **settings) -> RuleModel:
    """Fit on the labelled rows that are not held out; null labels and rows without a text are left out."""
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label IN (0, 1)")
    labelled = stats.where(~held_out()).join(known, "doc_id").withColumn("_place", F.xxhash64("doc_id"))
    found = labelled.count()
    # hashes are spread evenly: only about as many rows as are wanted pass this bound, so no task sends more than its share
    share = (rows + 6 * rows ** 0.5 + 64) / max(1, found)
    while True:
        few = labelled if share >= 1 else labelled.where(F.col("_place") < int(share * 2**64) - 2**63)
        data = few.orderBy("_place", "doc_id").limit(rows).select("label", *STATISTICS).toPandas().to_numpy(np.float64)
        if len(data) >= min(rows, found) or share >= 1:
            return fit_rules(data[:, 1:], data[:, 0], **settings)
        share *= 4


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, cutoff: float = CUTOFF, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= cutoff).

    Labels are learnt from rows whose crc32(doc_id) mod 5 is not 0, at most ``rows`` of them. Only the text
    is an input of the score; a null text is an empty one, and has a score too. Rows alike get scores alike.
    Without labels of both kinds all rows get the share of label 1. No rows give no rows.
    """
    stats = stored(statistics(docs, ["doc_id"]), "statistics")
    score = fit(stats, labels, rows, **settings).score()
    return stats.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= cutoff).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` whose text scores ``cutoff`` or more, with all their columns and in their places.

    The rows are written once beside their statistics, so texts are neither shuffled nor read for them twice.
    """
    whole = docs.select("doc_id", "text", F.struct(*[docs[c] for c in docs.columns]).alias("whole_row"))
    stats = stored(statistics(whole, ["doc_id", "whole_row"]), "rows-with-statistics")
    score = fit(stats.drop("whole_row"), labels, rows).score()
    return stats.where(score >= cutoff).select("whole_row.*")
