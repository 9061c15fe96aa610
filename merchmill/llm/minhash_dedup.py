"""MinHash near-dedup by a multi-index Hamming join.

A document is the set of its word shingles; its signature has one 16-bit minimum for each of ``4 * chunks``
hash functions. Two signatures whose Hamming distance (places that differ) is at most ``2 * chunks - 1``
agree, by the pigeonhole principle, in at least three of the four places of some chunk. So every chunk is
indexed four times, once for each place that may be wrong, and all pairs within the distance meet in a
bucket. They are then confirmed on their full sets. What can be missed is only a pair whose signatures are
further apart than that: below one in 100,000 at the similarity threshold, and rarer above it.

Documents of one set are one node. In a first pass a bucket compares its rows with its leaders only, and of the
leaders that a document meets only the few that it shares most buckets with are confirmed: ``CLOSEST`` pairs
for each document at most, however large its group, here and in each round. What this leaves apart is for the
passes after it. Rounds follow in which a bucket that still has rows of several
components draws a few leaders anew and compares them with the rows of other components; confirmed links join
components, and what is one component now is compared no more. So a family whose members are linked in chains
takes a number of comparisons in line with its size in each round, not all its pairs. A last pass compares the
rows of a bucket that are still in different components, so no link is lost. Rounds and last pass leave out the
pairs that can't be similar enough by the spread of their shingles over 256 cells: sets differ by as much as
their counts do at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import rows_of, stored, stored_alone
from merchmill.llm.components import components

PLACES = 4  # of a chunk
#: Rounds at most, and leaders that a bucket draws in one; the result doesn't depend on them, as a last pass follows.
ROUNDS, DRAWN = 6, 4
#: Leaders that a row is compared with in full in the first pass and in a round; the last pass has no such bound.
CLOSEST = 3
_KNOWN_WORDS = 200_000  # hashes kept beside a task; only speed depends on it
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def chunks_for(percent: int, miss: float = 1e-5) -> int:
    """The fewest chunks with which a pair at the threshold is missed with a chance below ``miss``."""
    p = 1 - percent / 100
    for chunks in range(2, 64):
        n, most = PLACES * chunks, 2 * chunks - 1
        if sum(comb(n, d) * p**d * (1 - p) ** (n - d) for d in range(most + 1, n + 1)) < miss:
            return chunks
    raise ValueError(f"{percent} percent is too low for this index")


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Texts -> sorted sets of 64-bit shingle hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = text.encode("utf-8", "replace").lower().split() if text else []  # of bytes, both know ASCII only
        if not found:
            return np.empty(0, np.uint64)
        if len(self.known) > _KNOWN_WORDS:
            self.known = {}
        known, new = self.known, xxhash.xxh3_64_intdigest
        for w in set(found).difference(known):
            known[w] = new(w)
        h = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        k = min(self.words, len(h))
        total = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):  # _mix between the words, so their order counts
            total = _mix(total * _FACTORS[i % 8] + h[i:len(h) - k + 1 + i])
        return np.unique(total)


def _signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """16 bits of the smallest hash for each place, a row for each (non-empty) set."""
    out = np.empty((len(sets), places), np.uint16)
    rng = np.random.default_rng(20240501)
    a = rng.integers(1, 1 << 63, places, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, places, dtype=np.uint64)
    at = 0
    while at < len(sets):  # about 64k hashes a block stay in the cache
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        heads = np.cumsum([0, *map(len, sets[at:end - 1])])
        for i in range(places):
            x = flat * a[i] + b[i]
            low = np.minimum.reduceat(x, heads)
            out[at:end, i] = (_mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
        at = end
    return out


def document_sets(docs: DataFrame, words: int, chunks: int) -> DataFrame:
    """doc_id, n_shingles, set_key (a digest of the set), signature, spread; the last three null for an empty set."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in rows_of(batches):
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            full = [s for s in sets if len(s)]
            made = iter(_signatures(full, PLACES * chunks)) if full else iter(())
            yield pa.record_batch([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([next(made).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([_spread(s) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "set_key", "signature", "spread"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        features, "doc_id long, n_shingles long, set_key binary, signature binary, spread binary")


def _index_rows(sets: DataFrame, chunks: int) -> DataFrame:
    """bucket, id, n, signature: a row for each chunk and each place of it that may be wrong."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 4096):
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(batch.num_rows, chunks, PLACES).astype(np.uint64)
            for c in range(chunks):
                for gone in range(PLACES):
                    kept = [sig[:, c, i] for i in range(PLACES) if i != gone]
                    key = kept[0] << np.uint64(32) | kept[1] << np.uint64(16) | kept[2]
                    key |= np.uint64(c * PLACES + gone) << np.uint64(48)
                    yield pa.record_batch([pa.array(key.view(np.int64)), *batch.columns], ["bucket", "id", "n", "signature"])

    return sets.select(F.col("doc_id").alias("id"), F.col("n_shingles").cast("int").alias("n"), "signature").mapInArrow(
        index, "bucket long, id long, n int, signature binary")


def _near(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, bucket: np.ndarray, chunks: int, percent: int, once: bool) -> np.ndarray:
    """Pairs within the signature distance whose sizes allow the similarity; ``once``: in the first bucket that they share."""
    fits = np.minimum(na, nb).astype(np.int64) * 100 >= np.maximum(na, nb).astype(np.int64) * percent
    same = (a == b).reshape(len(a), chunks, PLACES)
    fits &= same.sum((1, 2)) >= 2 * chunks + 1
    if not once:
        return fits
    agree = same.sum(2)
    first = np.argmax(agree >= PLACES - 1, axis=1)  # the first chunk with one error at most
    wrong = np.argmin(same[np.arange(len(a)), first], axis=1)  # its wrong place, 0 if there is none
    return fits & (first * PLACES + wrong == (bucket.astype(np.uint64) >> np.uint64(48)).astype(np.int64))


def _spread(members: np.ndarray) -> bytes:
    """How many members fall into each of 256 cells, up to 255."""
    return np.minimum(np.bincount((members >> np.uint64(40)).astype(np.int64) & 255, minlength=256), 255).astype(np.uint8).tobytes()


def _may_be_similar(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of spreads ``a`` and ``b`` may share enough: each cell's counts differ by members of one set only."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16)).sum(1, dtype=np.int64)
    total = na.astype(np.int64) + nb
    return 100 * (total - apart) >= percent * (total + apart)


def _runs(batches: Iterator[pa.RecordBatch], least: int = 1 << 15) -> Iterator[pa.Table]:
    """Whole buckets, some at a time, of rows sorted by bucket."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= least:
            table = pa.Table.from_batches(held)
            key = table.column("bucket").to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield table.slice(0, last)
                held, rows = table.slice(last).combine_chunks().to_batches(), len(key) - last
    if held:
        yield pa.Table.from_batches(held)


def _candidates(rows: DataFrame, chunks: int, percent: int, across: bool, turn: int | None = None) -> DataFrame:
    """Pairs a, b to be confirmed, from rows in buckets. Plain: every row with the leaders of its bucket,
    which are the rows that are not near an earlier leader. ``across``: all rows of different ``component``,
    or, with a ``turn``, a few leaders that the bucket draws in it and all rows of other components. Of the
    leaders of a row only the closest count, so there are ``CLOSEST`` pairs for each row at most.
    Rows are compared in blocks of numpy arrays; without a turn ``across`` reports a pair in one bucket only.
    """
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            key, ids, n = (table.column(c).to_numpy() for c in ("bucket", "id", "n"))
            sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(len(key), -1)
            label = table.column("component").to_numpy() if across else ids
            spread = np.frombuffer(b"".join(table.column("spread").to_pylist()), np.uint8).reshape(len(key), -1) if across else sig
            heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[heads, len(key)])
            found: list[tuple[np.ndarray, np.ndarray]] = []

            def compare(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                near = np.zeros(len(i), bool)
                for s in range(0, len(i), 1 << 14):
                    x, y = i[s:s + (1 << 14)], j[s:s + (1 << 14)]
                    near[s:s + (1 << 14)] = _near(sig[x], sig[y], n[x], n[y], key[x], chunks, percent, across and turn is None)
                    if across:
                        at = s + np.flatnonzero(near[s:s + (1 << 14)])
                        near[at] = _may_be_similar(spread[i[at]], spread[j[at]], n[i[at]], n[j[at]], percent)
                found.append((ids[i[near]], ids[j[near]]))
                return near

            small = heads[size == 2]
            small = small[label[small] != label[small + 1]]
            compare(small, small + 1)
            for head, count in zip(heads[size > 2], size[size > 2]):
                left = np.arange(head, head + count)
                if turn is not None:
                    draw = _mix(ids[left].astype(np.uint64) * _FACTORS[turn % 8] + key[left].astype(np.uint64))
                    for leader in left[np.argsort(draw, kind="stable")[:DRAWN]]:
                        other = left[label[left] != label[leader]]
                        compare(np.full(len(other), leader), other)
                    continue
                while len(left) > 1:
                    leader, rest = left[0], left[1:]
                    with_leader = np.full(len(rest), leader)
                    if across:
                        other = label[rest] != label[leader]
                        compare(with_leader[other], rest[other])
                        left = rest
                    else:
                        left = rest[~compare(with_leader, rest)]
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    found = rows.mapInArrow(pairs, "a long, b long").where("a <> b")
    if not across or turn is not None:
        found = _closest(found)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _closest(pairs: DataFrame) -> DataFrame:
    """For each row ``b`` the few leaders ``a`` that it meets in most buckets, of equal ones the smaller."""
    met = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    # a row has at most as many leaders as it is in buckets, times those drawn: a bounded list
    leaders = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "a")))
    return met.groupBy("b").agg(F.slice(leaders, 1, CLOSEST).alias("few")).select(F.explode("few.a").alias("a"), "b")


def _confirm(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in rows_of(batches):
            yield pa.record_batch([batch.column(0), pa.array([shingles(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], ["id", "members"])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(needed, "doc_id", "left_semi")
    sets = stored(texts.mapInArrow(shingle, "id long, members binary"), "shingle-sets")
    of = lambda c: sets.select(F.col("id").alias(c), F.col("members").alias(f"of_{c}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "of_a", "of_b").mapInArrow(similar, "a long, b long").distinct()


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 1e-5) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs of other characters than white space (blank and 9 to 13), A-Z in lower case. A text of
    fewer than ``words`` words is one shingle; a null, empty or blank text has none and is linked with
    nothing. Documents are linked when 100 * intersection >= ``percent`` * union; component_id is the
    smallest doc_id reachable. Rows that share a doc_id are one document and get one component. A null
    doc_id is linked with nothing: its component is null and it is kept. Only doc_id and text are read.
    The result is stored, and the tables of signatures, buckets and pairs are deleted: they take more disk
    than the texts do, and whatever runs next would have them beside its own.
    """
    return stored_alone(docs.sparkSession, lambda: _near_groups(docs, words, percent, miss), "near-groups")[0]


def _near_groups(docs: DataFrame, words: int, percent: int, miss: float) -> DataFrame:
    chunks = chunks_for(percent, miss)
    features = stored(document_sets(docs, words, chunks), "features")
    full = features.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = full.groupBy("set_key").agg(F.min("doc_id").alias("a"))
    members = full.select("set_key", F.col("doc_id").alias("b")).join(same, "set_key").select("a", "b").distinct()
    nodes = full.join(same, (full["set_key"] == same["set_key"]) & (full["doc_id"] == same["a"]), "left_semi").dropDuplicates(["doc_id", "set_key"])
    lone = nodes.select("doc_id", "n_shingles", "signature")
    # rows alone in their bucket are dropped right after the shuffle; the others are few
    together = stored(_index_rows(lone, chunks).repartition("bucket").sortWithinPartitions("bucket", "id").mapInArrow(
        _shared_buckets, "bucket long, id long, n int, signature binary"), "buckets")
    in_order = lambda df: df.repartition("bucket").sortWithinPartitions("bucket", "id")
    near = stored(_confirm(stored(_candidates(in_order(together), chunks, percent, False), "near-candidates"), docs, words, percent), "near-pairs")
    labels = components(near)
    spread = nodes.select(F.col("doc_id").alias("id"), F.col("n_shingles").cast("int").alias("n"), "signature", "spread")
    apart = stored(_still_apart(together, labels).join(spread, ["id", "n", "signature"]), "apart")
    for turn in range(ROUNDS + 1):
        if turn:
            apart = _still_apart(apart, labels)
        drawn = turn if turn < ROUNDS else None
        pairs = stored(_candidates(in_order(apart), chunks, percent, True, drawn).join(near, ["a", "b"], "left_anti"), "rest-pairs")
        found = stored(_confirm(pairs, docs, words, percent), "rest-links") if not pairs.isEmpty() else pairs
        if found.isEmpty():
            if drawn is None or pairs.isEmpty() and apart.isEmpty():
                break
            # no leader found a link: the last pass looks at what is left
            pairs = stored(_candidates(in_order(apart), chunks, percent, True).join(near, ["a", "b"], "left_anti"), "rest-pairs")
            labels = labels if pairs.isEmpty() else _joined(labels, stored(_confirm(pairs, docs, words, percent), "rest-links"))
            break
        labels = _joined(labels, found)
    groups = _joined(labels, members.where("a <> b"))
    return features.join(groups, features["doc_id"] == groups["id"], "left").select(
        features["doc_id"], "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"))


def _still_apart(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components, with their ``component``."""
    labelled = rows.drop("component").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    return stored(labelled.join(mixed, "bucket", "left_semi"), "mixed-buckets")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after new links between documents, by components of the labels that these bring together."""
    of = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    ends = stored(ends.select("a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b")), "label-links")
    lower = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()).select(
        F.col("id").alias("component"), F.col("component").alias("lower"))
    known = labels.union(ends.select(F.explode(F.array(*[F.struct(F.col(c).alias("id"), F.col(f"of_{c}").alias("component")) for c in "ab"])).alias("e")).select("e.*")).distinct()
    return stored(known.join(lower, "component", "left").select("id", F.coalesce("lower", "component").alias("component")), "labels")


def _shared_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by bucket, that have company in theirs."""
    for table in _runs(batches):
        key = table.column("bucket").to_numpy()
        same = key[1:] == key[:-1]
        yield from table.filter(pa.array(np.r_[same, False] | np.r_[False, same])).combine_chunks().to_batches()


def keep_one_of_each_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group the smallest doc_id."""
    kept = near_groups(docs, words, percent).where("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
