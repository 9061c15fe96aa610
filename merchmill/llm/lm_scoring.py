"""Masked pseudo-likelihood scores from a bidirectional window network, trained in numpy.

The network sees the words on both sides of a place and predicts the word there; a document's score is the
sum of the log-probabilities of all its words, each given its neighbours. The most frequent words of the
whole corpus are classes of their own, the others share hashed classes; the network predicts the class, and
a word of a shared class has its probability within the class from the word counts of the whole corpus, a
table that is joined. The output is a two-level softmax: a group of classes, then a class of it. Training is data-parallel: in each round every task trains a copy on its share of
the documents, and the copies are averaged by their number of words. Every place of every
document is learnt once, in steps that each mask a part of the places, and every place is scored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import rows_of, stored

#: So many words outside the vocabulary, or a batch with more, are looked up together.
CHUNK = 1 << 20
#: Words whose hashed class a task remembers.
KEPT = 1 << 17
#: Places whose groups are scored at a time: arrays of few places stay in the cache, and their memory is used again.
BLOCK = 1024
#: The log-probability of a byte, or of the end, in the spelling of a word that the corpus doesn't have.
PER_BYTE = -np.log(257)


@dataclass(frozen=True)
class Shape:
    groups: int = 32  # of words; a group holds as many
    reach: int = 2  # words seen on each side
    width: int = 16  # of an embedding
    hashed: int = 128  # classes of words that aren't among the most frequent
    rounds: int = 2  # of training; a document belongs to one
    masked: int = 4  # a step masks one place in so many of a lot of documents; the lot's steps mask all
    rate: float = 0.5
    batch: int = 8192  # places in a step of training
    seed: int = 11

    @property
    def classes(self) -> int:
        return self.groups * self.groups


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all documents; words are lower-cased (A-Z) runs of other characters than white space."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        for batch in rows_of(batches, 4096):
            seen: Counter = Counter()
            for text in batch.column(0).to_pylist():
                seen.update(_split(text))
            yield pa.record_batch([pa.array(seen.keys(), pa.binary()).cast(pa.string()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").lower().split() if text else []  # of bytes, both know ASCII only


def vocabulary(counts: DataFrame, shape: Shape) -> dict[bytes, int]:
    """The most frequent words and their classes, spread over the groups by rank. Bounded by ``shape``."""
    top = counts.orderBy(F.desc("n"), "word").limit(shape.classes - shape.hashed).collect()
    return {r["word"].encode(): shape.hashed + i for i, r in enumerate(top)}


class Classes(dict):
    """word -> class: that of the vocabulary, else by a hash of the whole word."""

    def __init__(self, known: dict[bytes, int], shape: Shape) -> None:
        super().__init__(known)
        self.hashed, self.most = shape.hashed, len(known) + KEPT

    def __missing__(self, word: bytes) -> int:
        c = crc32(word) % self.hashed
        if len(self) < self.most:
            self[word] = c
        return c

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def classes_of(text: str | None, known: dict[bytes, int], shape: Shape) -> np.ndarray:
    """Classes of the words; one that isn't known gets a class by a hash of all its bytes."""
    return (known if isinstance(known, Classes) else Classes(known, shape)).of(_split(text))


def shared_totals(counts: DataFrame, known: dict[bytes, int], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(occurrences, different words) of each shared class over the whole of ``counts``."""
    shared = counts.sparkSession.sparkContext.broadcast(known)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, classes = np.zeros((2, shape.classes), np.int64), Classes(shared.value, shape)
        for batch in rows_of(batches, 4096):
            at = classes.of([w.encode() for w in batch.column(0).to_pylist()])
            np.add.at(sums[0], at, batch.column(1).to_numpy(zero_copy_only=False))
            sums[1] += np.bincount(at, minlength=shape.classes)
        yield pa.record_batch([pa.array(np.arange(shape.hashed)), *map(pa.array, sums[:, :shape.hashed])], ["class", "n", "words"])

    rows = counts.select("word", "n").mapInArrow(totals, "class long, n long, words long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    out = np.zeros((2, shape.hashed), np.int64)
    for r in rows:
        out[:, r["class"]] = r["n"], r["words"]
    return out[0], out[1]


def new_network(shape: Shape) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(shape.seed)
    normal = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    edge = shape.classes  # the class beyond a document's ends
    return {"seen": normal(2 * shape.reach, edge + 1, shape.width), "hidden": np.zeros(shape.width, np.float32),
            "group": normal(shape.width, shape.groups), "group_bias": np.zeros(shape.groups, np.float32),
            "word": normal(shape.groups, shape.width, shape.groups), "word_bias": np.zeros((shape.groups, shape.groups), np.float32)}


def contexts(documents: list[np.ndarray], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(the classes at every place, the classes around it): neighbours never cross a document's ends."""
    pad = np.full(shape.reach, shape.classes, np.int32)
    flat = np.concatenate([x for d in documents for x in (pad, d)] + [pad])
    here = np.flatnonzero(flat < shape.classes)
    offsets = [o for o in range(-shape.reach, shape.reach + 1) if o]
    return flat[here], np.stack([flat[here + o] for o in offsets], axis=1)


def _softmax(x: np.ndarray, at: np.ndarray, learn: float) -> np.ndarray:
    """Log-probability of row at[i] in column i of ``x``; with ``learn``, ``x`` becomes the gradient of their sum."""
    here = np.arange(len(at))
    x -= x.max(axis=0)
    out = x[at, here]
    total = np.exp(x, out=x).sum(axis=0)
    if learn:
        x /= -total
        x[at, here] += 1
    return out - np.log(total)


def log_probabilities(net: dict[str, np.ndarray], target: np.ndarray, around: np.ndarray, shape: Shape, learn: float = 0.0) -> np.ndarray:
    """Log-probability of each target; with ``learn`` also one step of gradient ascent on ``net``."""
    n = len(target)
    order = np.argsort((target // shape.groups).astype(np.min_scalar_type(shape.groups)), kind="stable")  # small integers: by radix
    (group, word), around = np.divmod(target[order], shape.groups), around.take(order, axis=0)
    h = net["seen"][0].take(around[:, 0], axis=0)
    other = np.empty_like(h)
    for j in range(1, around.shape[1]):
        h += net["seen"][j].take(around[:, j], axis=0, out=other, mode="clip")
    h += net["hidden"]
    np.tanh(h, out=h)
    step, dh, logs = learn / max(n, 1), other, np.empty(n, np.float32)
    to_group, to_bias = np.zeros_like(net["group"]), np.zeros_like(net["group_bias"])
    for s in range(0, n, BLOCK):
        part = h[s:s + BLOCK]
        d = net["group"].T @ part.T + net["group_bias"][:, None]  # a column for each place
        logs[s:s + BLOCK] = _softmax(d, group[s:s + BLOCK], learn)
        if learn:
            np.matmul(d.T, net["group"].T, out=dh[s:s + BLOCK])
            to_group += (d @ part).T
            to_bias += d.sum(axis=1)
    if learn:
        net["group"] += step * 4 * to_group
        net["group_bias"] += step * 4 * to_bias
    ends = np.searchsorted(group, np.arange(shape.groups + 1))
    for g in range(shape.groups):
        a, b = ends[g], ends[g + 1]
        if a == b:
            continue
        d = net["word"][g].T @ h[a:b].T + net["word_bias"][g][:, None]
        logs[a:b] += _softmax(d, word[a:b], learn)
        if learn:
            dh[a:b] += d.T @ net["word"][g].T
            net["word"][g] += step * 8 * (d @ h[a:b]).T
            net["word_bias"][g] += step * 8 * d.sum(axis=1)
    if learn:
        np.multiply(h, h, out=h)
        dh *= np.subtract(1, h, out=h)
        net["hidden"] += step * dh.sum(axis=0)
        places = np.ascontiguousarray(around.T, np.int64)
        for column in range(dh.shape[1]):  # sum the steps of equal words
            own = step * 16 * dh[:, column].astype(np.float64)
            for seen, at in zip(net["seen"], places):
                seen[:, column] += np.bincount(at, own, len(seen))
    out = np.empty_like(logs)
    out[order] = logs
    return out


def train_round(docs: DataFrame, net: dict[str, np.ndarray], known: dict[bytes, int], shape: Shape) -> dict[str, np.ndarray]:
    """Average, over all tasks, of copies of ``net`` that each learnt the task's documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((net, known))  # both bounded by ``shape``
    names = list(net)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, words = shared.value
        words = Classes(words, shape)
        own, places = {k: v.copy() for k, v in start.items()}, 0
        held, rng = [], np.random.default_rng(shape.seed)

        def step(documents: list[np.ndarray]) -> int:
            target, around = contexts(documents, shape)
            mixed = rng.permutation(len(target))  # each place is in one step
            target, around = target[mixed], around.take(mixed, axis=0)
            for s in range(0, len(target), shape.batch):
                log_probabilities(own, target[s:s + shape.batch], around[s:s + shape.batch], shape, shape.rate)
            return len(target)

        for batch in rows_of(batches):
            for text in batch.column(0).to_pylist():
                found = classes_of(text, words, shape)
                if len(found):
                    held.append(found)
            if sum(map(len, held)) >= shape.batch * shape.masked:
                places += step(held)
                held = []
        if held:
            places += step(held)
        if places:
            for k in names:
                yield pa.record_batch([pa.array([k]), pa.array([own[k].astype(np.float64).ravel() * places], pa.list_(pa.float64())), pa.array([places], pa.int64())], ["part", "weights", "places"])

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, list] = {}
        for batch in batches:
            for part, weights, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                old = total.setdefault(part, [0.0, 0])
                total[part] = [old[0] + weights.values.to_numpy(), old[1] + places]
        for part, (weights, places) in total.items():
            yield pa.record_batch([pa.array([part]), pa.array([weights], pa.list_(pa.float64())), pa.array([places], pa.int64())], ["part", "weights", "places"])

    schema = "part string, weights array<double>, places long"
    copies = docs.select(F.col("text").cast("string")).mapInArrow(learn, schema)
    # sums of sums: some tasks' copies meet first, then one network a group, a few hundred kB each
    some = copies.withColumn("lot", F.pmod(F.hash("part", "weights"), F.lit(8))).repartition("part", "lot").drop("lot").mapInArrow(average, schema)
    done = {r["part"]: np.array(r["weights"]) / r["places"] for r in some.repartition("part").mapInArrow(average, schema).collect()}
    return {k: done[k].reshape(v.shape).astype(np.float32) if k in done else v for k, v in net.items()}


def train(docs: DataFrame, shape: Shape = Shape(), counts: DataFrame | None = None) -> tuple[dict[str, np.ndarray], dict[bytes, int]]:
    """(network, vocabulary) learnt from all rows of ``docs``; no words give the untrained network. ``counts``: ``word_counts`` of them."""
    known, net = vocabulary(word_counts(docs) if counts is None else counts, shape), new_network(shape)
    for r in range(shape.rounds):
        share = docs.where(F.pmod(F.xxhash64("text"), F.lit(shape.rounds)) == r)
        net = train_round(share, net, known, shape)
    return net, known


def _class_sums(classes: list[np.ndarray], net: dict[str, np.ndarray], shape: Shape, less: np.ndarray | None = None) -> np.ndarray:
    """The summed log-probabilities of each document's classes, each lowered by its entry in ``less``."""
    sums, full = np.zeros(len(classes)), [i for i, d in enumerate(classes) if len(d)]
    if full:
        target, around = contexts([classes[i] for i in full], shape)
        logs = np.concatenate([log_probabilities(net, target[s:s + shape.batch], around[s:s + shape.batch], shape) for s in range(0, len(target), shape.batch)]).astype(np.float64)
        heads = np.cumsum([0, *[len(classes[i]) for i in full[:-1]]])
        sums[full] = np.add.reduceat(logs if less is None else logs - less[target], heads)
    return sums


def _scores(ids: pa.Array, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([ids, pa.array(n), pa.array(sums), pa.array(sums / np.maximum(n, 1), mask=n == 0)],
                           ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])


SCORES = "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double"


def score(docs: DataFrame, net: dict[str, np.ndarray], known: dict[bytes, int], shape: Shape = Shape(), counts: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, log_likelihood (summed), mean_log_likelihood.

    Whole texts are scored. A text without words (null, empty, blank) has 0 tokens, a sum of 0 and a null
    mean. Rows of equal texts get equal scores. Only doc_id and text are read. Without ``counts``, the
    corpus' ``word_counts``, these are the log-probabilities of the classes alone.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if counts is not None:
        return _score_words(texts, net, known, shape, counts)
    shared = docs.sparkSession.sparkContext.broadcast((net, known))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, words = shared.value
        words = Classes(words, shape)
        for batch in rows_of(batches, 128):
            found = [classes_of(t, words, shape) for t in batch.column(1).to_pylist()]
            yield _scores(batch.column(0), np.array([len(d) for d in found], np.int64), _class_sums(found, weights, shape))

    return texts.mapInArrow(scored, SCORES)


def _score_words(texts: DataFrame, net: dict[str, np.ndarray], known: dict[bytes, int], shape: Shape, counts: DataFrame) -> DataFrame:
    """Scores of words: log P(class | neighbours) + log P(word | class) at each place.

    Within a shared class of N occurrences of T different words, a word seen n times has n / (N + T), and all
    words that the corpus doesn't have T / (N + T), times the probability of their spelling. Documents are taken
    in chunks; the different words of a chunk are joined with the counts, and their logarithms go back to it.
    """
    n_shared, t_shared = shared_totals(counts, known, shape)
    less, new = np.zeros(shape.classes), np.log(np.maximum(t_shared, 1))
    less[:shape.hashed] = np.log(np.maximum(n_shared + t_shared, 1))
    shared = texts.sparkSession.sparkContext.broadcast((net, known, less, new))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, words, lowered, unseen = shared.value
        first = len(words)  # the words of the vocabulary have the first numbers, the others of a chunk those after them
        names = ["ids", "tokens", "sums", "rare", "places", "words", "unseen"]

        def chunk(held: list[tuple], numbers: dict[bytes, int], classes: np.ndarray) -> pa.RecordBatch:
            ids, tokens, sums, rare, places = zip(*held)
            outside = list(islice(numbers, first, None))
            spelt = unseen[classes[first:]] + PER_BYTE * (np.fromiter(map(len, outside), np.int64, len(outside)) + 1)
            columns = [pa.concat_arrays(ids), *[pa.array(np.concatenate(x)) for x in (tokens, sums, rare, places)],
                       pa.array(outside, pa.binary()).cast(pa.string()), pa.array(spelt)]
            return pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], names)

        def start() -> tuple:
            return [], 0, defaultdict(count(first).__next__, zip(words, range(first))), np.fromiter(words.values(), np.int32, first)

        held, size, numbers, classes = start()
        for batch in rows_of(batches, 128):
            split = [_split(t) for t in batch.column(1).to_pylist()]
            tokens = np.fromiter(map(len, split), np.int64, len(split))
            at = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int32, tokens.sum())
            new = list(islice(reversed(numbers), len(numbers) - len(classes)))[::-1]
            classes = np.concatenate([classes, np.fromiter(map(crc32, new), np.uint32, len(new)).astype(np.int64) % shape.hashed]).astype(np.int32)
            outside, ends = at >= first, np.cumsum(tokens)
            found = np.split(classes[at], ends[:-1])
            rare = np.diff(np.r_[0, np.cumsum(outside)][np.r_[0, ends]]).astype(np.int32)
            held.append((batch.column(0), tokens, _class_sums(found, weights, shape, lowered), rare, at[outside] - first))
            size += len(held[-1][-1]) + batch.num_rows
            if size >= CHUNK:
                yield chunk(held, numbers, classes)
                held, size, numbers, classes = start()
        if held:
            yield chunk(held, numbers, classes)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1):
            ids, tokens, sums, rare, places, at, logs = [c.flatten() for c in batch.columns]
            n, sums, rare = tokens.to_numpy(), sums.to_numpy().copy(), rare.to_numpy()
            if len(at):
                by_word = np.empty(len(at))
                by_word[at.to_numpy()] = logs.to_numpy()
                full = np.flatnonzero(rare)
                sums[full] += np.add.reduceat(by_word[places.to_numpy()], (np.cumsum(rare) - rare)[full])
            yield _scores(ids, n, sums)

    lists = "ids array<long>, tokens array<long>, sums array<double>, rare array<int>, places array<int>"
    table = stored(texts.mapInArrow(chunks, f"{lists}, words array<string>, unseen array<double>").withColumn("chunk", F.monotonically_increasing_id()), "lm-chunks")
    wanted = table.select("chunk", F.posexplode(F.arrays_zip("words", "unseen")).alias("at", "w")).select("chunk", "at", "w.words", "w.unseen")
    logs = wanted.join(counts.select(F.col("word").alias("words"), F.log("n").alias("seen")), "words", "left").select("chunk", "at", F.coalesce("seen", "unseen").alias("log"))
    back = logs.groupBy("chunk").agg(F.collect_list(F.struct("at", "log")).alias("l"))  # of one chunk, so bounded
    return table.drop("words", "unseen").join(back, "chunk", "left").select(
        *[x.split()[0] for x in lists.split(", ")], F.coalesce(F.col("l.at"), F.array().cast("array<int>")).alias("at"), F.coalesce(F.col("l.log"), F.array().cast("array<double>")).alias("log")).mapInArrow(summed, SCORES)


def pseudo_likelihood(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """Train on all of ``docs`` and score each of its rows, see ``score``."""
    counts = stored(word_counts(docs), "lm-words")
    return score(docs, *train(docs, shape, counts), shape, counts)
