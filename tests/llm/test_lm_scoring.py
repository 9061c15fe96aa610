import itertools
import math
from collections import Counter

import numpy as np
import pytest

from merchmill.llm import lm_scoring as lm

SHAPE = lm.Shape(groups=4, width=6, hashed=4, rounds=1, batch=64, masked=1, rate=0.5)
WORDS = "the cat sat on a mat near the old dog and it slept".split()


def sentences(n=300, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join(WORDS[(s + k) % len(WORDS)] for k in range(int(rng.integers(3, 30)))) for s in rng.integers(0, len(WORDS), n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string").repartition(3)


ODD = [(None, "the cat"), (900, None), (901, ""), (902, " \n "), (903, "THE Cat ÄÖ"), (904, "the " * 4000), (905, "same"), (905, "same")]


def by_hand(net, classes, shape):
    """The definition, place by place, in plain Python."""
    total = 0.0
    for i, c in enumerate(classes):
        h = net["hidden"].astype(float).copy()
        for j, o in enumerate([o for o in range(-shape.reach, shape.reach + 1) if o]):
            k = classes[i + o] if 0 <= i + o < len(classes) else shape.classes
            h += net["seen"][j][k]
        h = np.tanh(h)
        g, w = divmod(int(c), shape.groups)
        for logits, at in ((h @ net["group"] + net["group_bias"], g), (h @ net["word"][g] + net["word_bias"][g], w)):
            total += logits[at] - math.log(sum(math.exp(x) for x in logits))
    return total


def test_scores_equal_the_definition(spark):
    docs = frame(spark, list(enumerate(sentences(40))) + ODD)
    net, known = lm.train(docs, SHAPE)
    rows = lm.score(docs, net, known, SHAPE).collect()
    assert len(rows) == docs.count()
    text = {(r.doc_id): r.text for r in docs.collect()}
    for r in rows:
        classes = lm.classes_of(text[r.doc_id], known, SHAPE).tolist()
        assert r.n_tokens == len(classes)
        assert r.log_likelihood == pytest.approx(by_hand(net, classes, SHAPE), rel=1e-3, abs=1e-3)
        assert r.mean_log_likelihood == (pytest.approx(r.log_likelihood / r.n_tokens) if classes else None)


def test_training_beats_word_frequencies_and_sees_order(spark):
    docs = frame(spark, list(enumerate(sentences(600))))
    net, known = lm.train(docs, lm.Shape(groups=4, width=6, hashed=4, rounds=2, batch=64, masked=1, rate=0.5))
    new = frame(spark, list(enumerate(sentences(60, seed=9))) + [(i + 1000, " ".join(sorted(t.split()))) for i, t in enumerate(sentences(60, seed=9))])
    rows = lm.score(new, net, known, SHAPE).collect()
    total = lambda keep: sum(r.log_likelihood for r in rows if keep(r)) / sum(r.n_tokens for r in rows if keep(r))
    seen = Counter(w for t in sentences(600) for w in t.split())
    frequency = sum(n * math.log(n / seen.total()) for n in seen.values()) / seen.total()
    assert total(lambda r: r.doc_id < 1000) > frequency + 0.3
    assert total(lambda r: r.doc_id < 1000) > total(lambda r: r.doc_id >= 1000)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(2)
    net = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in lm.new_network(SHAPE).items()}
    target, around = lm.contexts([rng.integers(0, SHAPE.classes, 30).astype(np.int32) for _ in range(3)], SHAPE)
    before = lm.log_probabilities(net, target, around, SHAPE).sum()
    moved = {k: v.copy() for k, v in net.items()}
    lm.log_probabilities(moved, target, around, SHAPE, learn=1e-4)
    gain = lm.log_probabilities(moved, target, around, SHAPE).sum() - before
    weight = {"seen": 16, "hidden": 1, "group": 4, "group_bias": 4, "word": 8, "word_bias": 8}
    step = {k: (moved[k] - net[k]) / weight[k] for k in net}
    expected = sum(weight[k] * (s**2).sum() for k, s in step.items()) / (1e-4 / len(target))
    assert gain == pytest.approx(expected, rel=1e-2)


def test_no_words_and_no_rows(spark):
    assert lm.pseudo_likelihood(frame(spark, [(1, None), (2, " ")]), SHAPE).where("log_likelihood = 0 AND mean_log_likelihood IS NULL").count() == 2
    assert lm.pseudo_likelihood(frame(spark, ODD).limit(0), SHAPE).count() == 0


def test_words_of_all_documents_are_counted(spark):
    docs = frame(spark, list(enumerate(sentences(50))) + ODD)
    got = {r.word: r.n for r in lm.word_counts(docs).collect()}
    want = Counter(w.decode() for r in docs.collect() for w in lm._split(r.text))
    assert got == want


def test_each_word_of_a_shared_class_has_its_own_probability(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 50)  # so that there are many chunks
    docs = frame(spark, [(i, t + " rare" * (i % 3) + f" only{i % 40}") for i, t in enumerate(sentences(60))] + ODD)
    counts = lm.word_counts(docs)
    net, known = lm.train(docs, SHAPE, counts)
    n = {r.word.encode(): r.n for r in counts.collect()}
    total, different = Counter(), Counter()
    for w in n.keys() - known.keys():
        c = int(lm.classes_of(w.decode(), known, SHAPE)[0])
        total[c] += n[w]
        different[c] += 1

    def of_word(w):
        if w in known:
            return 0.0
        c = int(lm.classes_of(w.decode(), known, SHAPE)[0])
        all_of = math.log(total[c] + different[c])
        return math.log(n[w]) - all_of if w in n else math.log(different[c]) - all_of - (len(w) + 1) * math.log(257)

    new = docs.union(frame(spark, [(2000, "the unheard-of cat"), (2001, "the rare cat")]).select(docs.columns))
    words = {r.doc_id: r for r in lm.score(new, net, known, SHAPE, counts).collect()}
    classes = {r.doc_id: r for r in lm.score(new, net, known, SHAPE).collect()}
    assert len(words) == len(classes) and lm.score(new, net, known, SHAPE, counts).count() == new.count()
    for r in new.collect():
        got, split = words[r.doc_id], lm._split(r.text)
        assert got.n_tokens == len(split)
        assert got.log_likelihood == pytest.approx(classes[r.doc_id].log_likelihood + sum(map(of_word, split)), rel=1e-6, abs=1e-6)
        assert got.mean_log_likelihood == (pytest.approx(got.log_likelihood / got.n_tokens) if split else None)


def test_rare_and_frequent_words_of_a_class_score_differently(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(sentences(60))] + [(100 + i, "the zebra sat") for i in range(9)] + [(200, "the zeira sat")])
    shape = lm.Shape(groups=3, width=6, hashed=1, rounds=1, batch=64, masked=1)  # one shared class
    scores = {r.doc_id: r.log_likelihood for r in lm.pseudo_likelihood(docs, shape).collect()}
    assert scores[100] - scores[200] == pytest.approx(math.log(9), abs=1e-4)


def test_all_bytes_of_a_word_decide_its_shared_class():
    shape = lm.Shape()
    inner = ["t" + "".join(p) + "y" for p in itertools.permutations("hinlegb")]  # alike in start, end and length
    sizes = Counter(lm.classes_of(" ".join(inner), {}, shape).tolist())
    assert len(sizes) == shape.hashed and max(sizes.values()) < 2 * len(inner) / shape.hashed
    assert lm.classes_of("thinly", {}, shape) == lm.classes_of("THINLY", {}, shape) != lm.classes_of("tlnihy", {}, shape)


def test_every_place_is_learnt_in_the_production_setting(spark):
    docs = frame(spark, [(i, "one two three four " * 20) for i in range(2400)])  # one place in four always has the same word
    shape = lm.Shape()
    net, known = lm.train(docs, shape)
    for word in ("one", "two", "three", "four"):
        target, around = lm.contexts([lm.classes_of(docs.first().text, known, shape)], shape)
        at = target == known[word.encode()]
        learnt, at_first = (lm.log_probabilities(n, target, around, shape)[at].mean() for n in (net, lm.new_network(shape)))
        assert learnt > at_first + 1, word


def test_groups_are_scored_in_blocks(monkeypatch):
    """The blocks bound the arrays of a step; scores and weights are those of one block."""
    rng, made = np.random.default_rng(5), []
    target, around = rng.integers(0, SHAPE.classes, 500).astype(np.int32), rng.integers(0, SHAPE.classes + 1, (500, 2 * SHAPE.reach)).astype(np.int32)
    for block in (64, 1 << 20):
        monkeypatch.setattr(lm, "BLOCK", block)
        net = lm.new_network(SHAPE)
        logs = lm.log_probabilities(net, target, around, SHAPE, 0.5)
        made.append([logs, lm.log_probabilities(net, target, around, SHAPE), *net.values()])
    for a, b in zip(*made):
        np.testing.assert_allclose(a, b, rtol=1e-4, atol=1e-5)
