"""The classifier of rules and the rules with adaptive thresholds."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchmill.llm import quality_classifier, quality_rules
from merchmill.llm.text_stats import text_counts

BLANK = re.compile(r"[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words int, language string"


def texts(seed=1, n=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    good = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) + "." for _ in range(rng.randint(3, 12)))
    bad = [lambda: " ".join(w + "&&&" for w in good().split()), lambda: good().upper() + "!!", lambda: " ".join(["again and"] * 60)]
    return [(i, good() if i % 5 else bad[i // 5 % 3]()) for i in range(n)]


ODD = [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "w " * 5000), (1004, "é" * 3000), (None, "one two"), (1005, "a\n a\na\n\n\n b c\na"),
       (1006, "a b c d e f g h " * 2), (1007, "x a b c d e f g h y a b c d e f g h a b c d e f g h"), (1008, "nbsp stays one\x0bword")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if i and i % 7 == 0 else "en", f"s{(i or 0) % 3}", 1, "x") for i, t in rows], SCHEMA).repartition(4)


def brute_counts(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_upper": sum("A" <= c <= "Z" for c in text),
            "n_digits": sum(c in "0123456789" for c in text), "n_exclaim": text.count("!"), "n_distinct_words": len(set(words))}


def test_counts_equal_brute_force(spark):
    rows = texts(n=60) + ODD
    got = {r.doc_id: r.asDict() for r in text_counts(frame(spark, rows).select("doc_id", "text"), ["doc_id"]).collect()}
    assert {k: {c: v[c] for c in v if c != "doc_id"} for k, v in got.items()} == {i: brute_counts(t) for i, t in rows}


def test_verdicts(spark):
    rows = texts() + ODD
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        c = brute_counts(t)
        failed = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
        assert got[i].base_failed == failed and (not failed or not got[i].kept)
        if i is not None and i < 400 and i % 5 and not failed:
            assert got[i].kept, t
    assert sum(got[i].kept for i in range(0, 400, 5)) == 0  # symbols, capitals and repeats are outside the fences
    assert quality_rules.quality_verdicts(frame(spark, rows).limit(0)).count() == 0


RULES = {
    "symbols": lambda t: t.replace(" ", " & ", 6), "dup_lines": lambda t: t + "\n" + t.split("\n")[0],
    "repeats": lambda t: t + " again " + " ".join(t.split()[:9]), "upper": lambda t: t.upper(), "exclaims": lambda t: t.replace(".", "!"),
    "word_length": lambda t: " ".join(a + b for a, b in zip(t.split()[::2], t.split()[1::2])),
}


@pytest.mark.parametrize("rule", RULES)
def test_each_rule_can_fire(spark, rule):
    """Some documents of a large source differ in one rate, and only these are set aside."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    good = lambda: "\n".join(" ".join(rng.choice(words) for _ in range(9)) + "." for _ in range(8))
    rows = [(i, RULES[rule](good()) if i % 20 == 0 else good()) for i in range(300)]
    df = spark.createDataFrame([(i, t, "en", "s", 1, "x") for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert {i for i, r in got.items() if not r.kept} == {i for i in got if i % 20 == 0}


def test_fences_change_smoothly_with_the_size_of_a_source(spark):
    def limits(n):
        rows = [("=en", "=big", *[k % 40] * 6) for k in range(400)] + [("=en", "=small", *[900 + k % 9] * 6) for k in range(n)]
        df = spark.createDataFrame(rows, "language string, origin string, " + ", ".join(f"{r} long" for r in quality_rules.RATES))
        return {r.origin: r.symbols_high for r in quality_rules.thresholds(df).collect()}

    high = [limits(n)["=small"] for n in (1, 9, 49, 50, 51, 2000)]
    assert high == sorted(high) and abs(high[3] - high[2]) < 20 and abs(high[4] - high[3]) < 20  # 49, 50, 51 documents
    assert high[0] < 300 and high[-1] > 850  # one document is judged as its language, many by themselves


def test_verdicts_of_large_sources_equal_the_sql(spark, folder):
    import duckdb

    frame(spark, texts(seed=2, n=700) + ODD).withColumn("n_chars", F.length("text")).coalesce(1).write.parquet(f"{folder}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents/*.parquet'")
    result = con.execute(quality_rules.SQL)
    names = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    docs = spark.read.parquet(f"{folder}/documents")
    assert docs.groupBy("lang", "source").count().where("count > 60").count() >= 3
    got = quality_rules.quality_verdicts(docs.union(docs.limit(0)))
    assert Counter(map(tuple, got.select(*names).collect())) == want
    assert len({r.kept for r in got.where("not base_failed").collect()}) == 2


def test_sketches_merge_and_bound_their_error(spark):
    values = [random.Random(i).randint(0, 10**6) for i in range(500)] + list(range(40))
    df = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bucket("v").alias("b"))
    assert all(r.v <= r.b and (r.b == r.v if r.v < 16 else r.b - r.v < r.v / 16) for r in df.collect())
    one = spark.createDataFrame([("=en", "=a", *[v] * 6) for v in values], "language string, origin string, " + ", ".join(f"{r} long" for r in quality_rules.RATES))
    two = one.withColumn("origin", F.when(F.rand(3) < 0.5, "=a").otherwise("=b"))
    whole = lambda d: sorted(map(tuple, quality_rules.sketches(d).where("level = 0").collect()), key=repr)
    assert whole(one) == whole(two)


def test_classifier_on_held_out_rows(spark):
    rows = texts(n=600) + ODD
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i, _ in rows[:600]] + [(1000, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_classifier.score_documents(frame(spark, rows), labels).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(got[i].held_out == (crc32(str(i).encode()) % 5 == 0) for i, _ in rows if i is not None)
    held = [i for i in range(600) if got[i].held_out]
    assert np.mean([got[i].predicted == int(i % 5 > 0) for i in held]) > 0.97
    kept = quality_classifier.keep_good(frame(spark, rows), labels)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_words", "language"]
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_compiled_rules_score_as_numpy(spark):
    stats = quality_classifier.statistics(frame(spark, texts(n=200)), ["doc_id"]).orderBy("doc_id")
    x = stats.drop("doc_id").toPandas().to_numpy(float)
    model = quality_classifier.fit_rules(x, (np.arange(200) % 5 > 0).astype(float))
    assert 0 < len(model.rules) < 200 and len(model.describe()) == len(model.rules)
    total = model.intercept + sum(w * quality_classifier._holds(x, r) for w, r in zip(model.weights, model.rules))
    got = [r.s for r in stats.select("doc_id", model.score().alias("s")).orderBy("doc_id").collect()]
    assert got == pytest.approx(list(1 / (1 + np.exp(-total))))


@pytest.mark.parametrize("rows", [1, 30, 250])
def test_the_sample_is_that_of_the_smallest_hashes(spark, monkeypatch, rows):
    """What reaches the driver is about the sample, and the sample is the same as without a bound."""
    taken = []
    monkeypatch.setattr(quality_classifier, "fit_rules", lambda x, y, **k: taken.append((x, y)))
    ids = [*range(300), *[7] * 200]  # one id with two fifths of the rows
    stats = spark.createDataFrame([(i, *[float(i)] * len(quality_classifier.STATISTICS)) for i in ids],
                                  "doc_id long, " + ", ".join(f"{c} double" for c in quality_classifier.STATISTICS))
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    quality_classifier.fit(stats, labels, rows)
    known = stats.where(~quality_classifier.held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()
    assert sorted(taken[0][0][:, 0]) == sorted(r[1] for r in known)
    assert sorted(taken[0][1]) == sorted(r.doc_id % 2 for r in known)


@pytest.mark.parametrize("quality", [[], [1, 1, 1], [None]])
def test_labels_of_one_kind(spark, quality):
    labels = spark.createDataFrame(list(enumerate(quality)), "doc_id long, quality int")
    scores = {r.score for r in quality_classifier.score_documents(frame(spark, texts(n=10)), labels).collect()}
    assert len(scores) == 1 and quality_classifier.score_documents(frame(spark, texts(n=10)).limit(0), labels).count() == 0
