"""Suffix-array dedup: remove every byte of a 100-byte string that also starts earlier.

Suffixes that share 100 bytes must meet, wherever their documents are. Every window of 100 bytes has an
anchor, its smallest 32-byte hash, which equal windows share. Anchors that occur twice anywhere are found
by a shuffle of hashes; the stretches of text around those (the windows of one anchor, put together) go to
shards by their anchor. A stretch that a task holds several times is sent once, with all its places. In a
shard the suffix order of its distinct stretches and the common prefixes come from external induced
sorting (``induced_sort``), and of the windows that share 100 bytes all but the earliest are repeats.
Stretches of an anchor that is very frequent are cut finer, by two more anchors near the windows' ends,
so that no shard has to hold everything around a text that a third of all documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchmill.llm.common import rows_of
from merchmill.llm.induced_sort import sorted_buckets

LENGTH, ANCHOR = 100, 32
#: Bytes of text for each shard and each partition of documents.
SHARD_BYTES = 8 << 20
#: Places of an anchor beyond which its stretches are cut finer.
FREQUENT = 2_000
_BLOCK, _LOW = 1 << 20, np.uint64((1 << 22) - 1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_NO_ID = -(1 << 63)  # stands for a null doc_id, before all others


def _hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` (8 or 32) bytes from each place; ``data`` is padded by as many."""
    n = len(data) - size
    word = np.ndarray(len(data) - 7, "<u8", data.data, strides=(1,))
    h = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for i in range(0, size, 8):
        h ^= word[i:i + n]
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return h


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minima of ``width`` keys from each place (fewer at the end)."""
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out, np.r_[out[step:], np.full(step, _NONE)])
        have += step
    return out


def _located(hashes: np.ndarray) -> np.ndarray:
    """Hashes with their place in the lowest bits, so that the first of equal ones is the smallest."""
    return (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)


def anchors(data: np.ndarray, heads: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor's hash) of texts that start at ``heads`` in ``data``, and all hashes."""
    n = len(data)
    hashes = _hashes(np.r_[data, np.zeros(ANCHOR, np.uint8)], ANCHOR)
    at = (_smallest(_located(hashes), length - ANCHOR + 1) & _LOW).astype(np.int64)
    ends = np.repeat(np.r_[heads[1:], n], np.diff(np.r_[heads, n]))
    valid = np.arange(n) + length <= ends
    text = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, n]))
    new = valid & np.r_[True, ~valid[:-1] | (at[1:] != at[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(new)
    count = np.add.reduceat(valid.astype(np.int64), first) if len(first) else np.empty(0, np.int64)
    return first, count, hashes[at[first]], hashes


def _blocks(raw: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, heads, text number, place in the text) of texts put together; longer ones are cut, with overlaps
    so that every window is whole in one cut."""
    data: list[bytes] = []
    of: list[int] = []
    skipped: list[int] = []
    size = 0
    for i, r in enumerate(raw):
        for start in range(0, max(len(r) - length + 1, 0), _BLOCK):
            part = r[start:start + _BLOCK + length - 1]
            if size + len(part) > 2 * _BLOCK:
                yield _put_together(data, of, skipped)
                data, of, skipped, size = [], [], [], 0
            data.append(part)
            of.append(i)
            skipped.append(start)
            size += len(part)
    if data:
        yield _put_together(data, of, skipped)


def _put_together(data: list[bytes], of: list[int], skipped: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data[:-1])]), np.array(of), np.array(skipped))


def _utf8(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of runs of the given lengths, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def _finer(data: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, first window, number of windows, key) of parts of stretches, by the smallest 8-byte hashes in
    the first and the last 40 bytes of a window."""
    if not len(first):
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    low = _smallest(_located(_hashes(np.r_[data, np.zeros(8, np.uint8)], 8)), 40 - 7)
    of, at = np.repeat(np.arange(len(first)), count), _gather(first, count)
    left, right = low[at], low[at + length - 40]
    new = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1]) | (of[1:] != of[:-1])])
    key = (left[new] & ~_LOW) * np.uint64(31) + (right[new] & ~_LOW)
    return of[new], at[new], np.diff(np.r_[new, len(at)]), key ^ key >> np.uint64(31)


def _marks(hashes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of whole stretches, from those of the 32 bytes at every 32nd place and at the end."""
    out = size.astype(np.uint64)
    for skip in range(0, int(size.max(initial=0)), ANCHOR):
        out = (out ^ hashes[first + np.minimum(skip, size - ANCHOR)]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one stretch of each different content, number of each stretch's content): equal marks are compared in full."""
    order = np.lexsort((sizes, marks))
    m, n = marks[order], sizes[order]
    new = np.r_[True, (m[1:] != m[:-1]) | (n[1:] != n[:-1])] if len(order) else np.empty(0, bool)
    other, like = order[~new], order[new][np.cumsum(new)[~new] - 1]
    bytes_before = np.cumsum(sizes[other])
    differs = np.zeros(len(starts), bool)
    for s in range(0, int(bytes_before[-1]) if len(other) else 0, _BLOCK):
        here = slice(*np.searchsorted(bytes_before, [s, s + _BLOCK], side="left"))
        a, b, size = other[here], like[here], sizes[other[here]]
        if len(a):
            equal = data[_gather(starts[a], size)] == data[_gather(starts[b], size)]
            differs[a] = ~np.logical_and.reduceat(equal, np.cumsum(size) - size)
    new |= differs[order]  # a mark shared by chance: on its own, which the suffix order puts right
    number = np.empty(len(starts), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def anchor_places(keyed: DataFrame, length: int) -> DataFrame:
    """anchor, k1, k2, first: the anchors of all documents and their first windows."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            raw = _utf8(batch.column(2))
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for data, heads, of, skipped in _blocks(raw, length):
                first, _, seed, _ = anchors(data, heads, length)
                part = np.searchsorted(heads, first, side="right") - 1
                yield pa.record_batch([pa.array(seed.view(np.int64)), pa.array(k1[of[part]]), pa.array(k2[of[part]]), pa.array(first - heads[part] + skipped[part], pa.int32())],
                                      ["anchor", "k1", "k2", "first"])

    return keyed.mapInArrow(find, "anchor long, k1 long, k2 int, first int")


def repeated_places(places: DataFrame) -> DataFrame:
    """k1, k2, places: for each document those of its anchors that occur twice or more anywhere; a place of a
    frequent anchor counts as ``-1 - place``."""
    n = F.count("*").over(Window.partitionBy("anchor"))  # counts; the rows of an anchor may spill, none is held whole
    many = places.withColumn("n", n).where("n > 1")
    return many.groupBy("k1", "k2").agg(F.collect_list(F.when(F.col("n") > FREQUENT, -1 - F.col("first")).otherwise(F.col("first"))).alias("places"))


def stretches(found: DataFrame, length: int, shards: int) -> DataFrame:
    """Rows for shards, each of many stretches: their bytes, sizes, marks, how many places each has, and the
    places (k1, k2, start), from rows of k1, k2, text, places."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1024):
            raw = _utf8(batch.column(2))
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            wanted = batch.column(3)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            value = wanted.flatten().to_numpy().astype(np.int64)
            often_too = value < 0
            value = owner << 40 | np.where(often_too, -1 - value, value)
            for data, heads, of, skipped in _blocks(raw, length):
                first, count, seed, hashes = anchors(data, heads, length)
                part = np.searchsorted(heads, first, side="right") - 1
                mine = of[part] << 40 | (first - heads[part] + skipped[part])
                often, plain = np.isin(mine, value[often_too]), np.isin(mine, value[~often_too])
                within, f2, n2, key2 = _finer(data, first[often], count[often], length)
                at, windows = np.r_[first[plain], f2], np.r_[count[plain], n2]
                text, key = np.r_[part[plain], part[often][within]], np.r_[seed[plain], key2]
                yield from _sent(data, at, windows + length - 1, key % np.uint64(shards), hashes,
                                 np.stack([k1[of[text]], k2[of[text]], at - heads[text] + skipped[text]], axis=1).astype(np.int64))

    return found.mapInArrow(cut, "shard long, bytes binary, sizes binary, marks binary, counts binary, places binary")


def _sent(data: np.ndarray, at: np.ndarray, size: np.ndarray, shard: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each shard; a content that occurs several times is sent once."""
    marks = _marks(hashes, at, size)
    # a content's anchor, and so its shard, is always the same
    some, number = _distinct(data, at, size, marks ^ shard)
    turn = np.argsort(shard[some], kind="stable")
    rank = np.empty(len(some), np.int64)
    rank[turn] = np.arange(len(some))
    some, number = some[turn], rank[number]
    places, counts = places[np.argsort(number, kind="stable")], np.bincount(number, minlength=len(some))
    ends, upto = np.flatnonzero(np.r_[np.diff(shard[some]) != 0, len(some) > 0]) + 1, np.r_[0, np.cumsum(counts)]
    rows, a = [], 0
    for b in ends.tolist():
        x = some[a:b]
        rows.append((int(shard[x[0]]), data[_gather(at[x], size[x])].tobytes(), size[x].astype("<i4").tobytes(), marks[x].tobytes(),
                     counts[a:b].astype("<i4").tobytes(), places[upto[a]:upto[b]].tobytes()))
        a = b
    columns = list(zip(*rows)) or [[]] * 6
    yield pa.record_batch([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                          ["shard", "bytes", "sizes", "marks", "counts", "places"])


def repeats_in_shard(data: np.ndarray, sizes: np.ndarray, marks: np.ndarray, counts: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Rows k1, k2, start, bytes of repeats, from stretches put together and all their places."""
    starts = np.cumsum(sizes) - sizes
    some, number = _distinct(data, starts, sizes, marks)
    sizes, starts, owner = sizes[some], starts[some], np.repeat(number, counts)
    order = np.lexsort((places[:, 2], places[:, 1], places[:, 0], owner))
    owner, places = owner[order], places[order]
    fresh = np.r_[True, (owner[1:] != owner[:-1]) | (places[1:] != places[:-1]).any(1)]
    owner, places = owner[fresh], places[fresh]
    lead = np.r_[True, owner[1:] != owner[:-1]]
    lowest = places[lead]
    # every window of a later place is in the first place too
    later = np.column_stack([places[~lead], sizes[owner[~lead]]])
    # bytes of UTF-8 are below 248: one more leaves 0 to end a stretch
    heads = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(sizes), np.uint8)
    text[_gather(heads, sizes)] = data[_gather(starts, sizes)] + np.uint8(1)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    inside = (np.arange(len(text)) - heads[of]).astype(np.int32)
    full = inside + length <= sizes[of]
    repeated = np.zeros(len(text), bool)
    for at, shared in sorted_buckets(text, length):
        group = np.cumsum(np.r_[True, shared[1:] < length])
        at, group = at[full[at]].astype(np.int64), group[full[at]]
        many = np.bincount(group)[group] > 1 if len(group) else np.empty(0, bool)
        at, group = at[many], group[many]
        low = lowest[of[at]]
        order = np.lexsort((low[:, 2] + inside[at], low[:, 1], low[:, 0], group))
        group = group[order]
        repeated[at[order][np.r_[False, group[1:] == group[:-1]][: len(group)]]] = True
    hit = np.flatnonzero(repeated)
    new = np.r_[True, (np.diff(hit) != 1) | (of[hit[1:]] != of[hit[:-1]])][: len(hit)]
    a, b = hit[new], hit[np.r_[new[1:], True][: len(hit)]]
    low = lowest[of[a]]
    return np.concatenate([later, np.column_stack([low[:, 0], low[:, 1], low[:, 2] + inside[a], b - a + length])])


def merged_spans(rows: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(k1, k2 of each document, its spans as pairs start, end of 32-bit numbers), from rows k1, k2, start, bytes.

    Spans that overlap or touch are one.
    """
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new_doc = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)][: len(rows)]
    # ends of different documents are kept apart by a step that is larger than any text
    step = (np.cumsum(new_doc) - 1) << 32
    reach = np.maximum.accumulate(rows[:, 2] + rows[:, 3] + step) if len(rows) else np.empty(0, np.int64)
    new = new_doc | np.r_[True, rows[1:, 2] + step[1:] > reach[:-1]][: len(rows)]
    spans = np.column_stack([rows[new, 2], (reach - step)[np.r_[new[1:], True][: len(rows)]]]).astype("<i4")
    heads = np.flatnonzero(new_doc[new])
    return rows[new_doc, :2], [spans[a:b].tobytes() for a, b in zip(heads, np.r_[heads[1:], len(spans)])]


def repeats(sent: DataFrame, length: int) -> DataFrame:
    """k1, k2, spans: the repeats that a shard found in a document, one row for each of both."""
    def sort_shard(table: pa.Table) -> pa.Table:
        read = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        rows = repeats_in_shard(read("bytes", np.uint8), read("sizes", "<i4").astype(np.int64), read("marks", np.uint64),
                                read("counts", "<i4"), read("places", np.int64).reshape(-1, 3), length)
        keys, spans = merged_spans(rows)
        return pa.table([pa.array(keys[:, 0], pa.int64()), pa.array(keys[:, 1], pa.int32()), pa.array(spans, pa.binary())], ["k1", "k2", "spans"])

    return sent.groupBy("shard").applyInArrow(sort_shard, "k1 long, k2 int, spans binary")


def _spans(found: list[bytes] | None) -> list[tuple[int, int]]:
    """Maximal removed runs (start, end), sorted, from what the shards found."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(map(tuple, np.frombuffer(b"".join(found or ()), "<i4").reshape(-1, 2).tolist())):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def _keys() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("k1"), F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 32).cast("int").alias("k2")]


def removed_spans(docs: DataFrame, length: int = LENGTH, carried: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(k1, k2, text of all documents, dealt by k1 and k2; k1, k2, spans of those that have repeats).

    With ``carried`` columns the dealt rows have ``others`` too, a struct of them and of ``text`` being null.
    """
    others = F.struct(*[docs[c] for c in carried], docs["text"].isNull().alias("_text_is_null")).alias("others")
    keyed = docs.select(*_keys(), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *([others] if carried else []))
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    # one shuffle of the texts serves both joins: both take all its columns, so that Spark reuses it
    dealt = keyed.repartition(shards, "k1", "k2")
    places = repeated_places(anchor_places(keyed.select("k1", "k2", "text"), length))
    found = dealt.join(places, ["k1", "k2"]).select("k1", "k2", "text", "places", *(["others"] if carried else []))
    spans = repeats(stretches(found, length, shards), length).groupBy("k1", "k2").agg(F.collect_list("spans").alias("spans"))
    return dealt, spans


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept (binary).

    Texts are UTF-8 bytes, null is empty; matches don't cross documents. A byte goes if a string of
    ``length`` bytes over it also starts earlier: in a document of smaller doc_id, or earlier in the same.
    A null doc_id comes first; different texts of one doc_id are in the order of a hash, and rows that repeat
    doc_id and text are one document, so each keeps the same. Only doc_id and text are read.
    """
    dealt, spans = removed_spans(docs, length)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            ids = [None if k == _NO_ID else k for k in batch.column(0).to_pylist()]
            rows = []
            for raw, found in zip(_utf8(batch.column(1)), batch.column(2).to_pylist()):
                gone = _spans(found)
                kept = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in gone]], [*[s for s, _ in gone], len(raw)]))
                rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.record_batch([pa.array(ids, pa.int64()), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                  ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return dealt.join(spans, ["k1", "k2"], "left").select("k1", "text", "spans").mapInArrow(
        keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` with what ``remove_repeats`` leaves of their texts; other columns stay.

    No row goes, not even one whose text is empty now. A character of which a cut took bytes goes whole. A
    null text stays null, and a column n_chars counts the characters that are left.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    carried = [n for n in kinds if n != "text"]
    dealt, spans = removed_spans(docs, length, carried)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = []
            for raw, found, null in zip(_utf8(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).field("_text_is_null").to_pylist()):
                gone = _spans(found)
                kept = b"".join(raw[a:b] for a, b in zip([0, *[e for _, e in gone]], [*[s for s, _ in gone], len(raw)]))
                texts.append(None if null else kept.decode("utf-8", "ignore"))
            yield pa.record_batch([pa.array(texts, pa.string()), batch.column(2)], ["cleaned", "others"])

    row = ", ".join([*(f"`{n}`: {kinds[n]}" for n in carried), "_text_is_null: boolean"])
    cleaned = dealt.join(spans, ["k1", "k2"], "left").select("text", "spans", "others").mapInArrow(
        rewrite, f"cleaned string, others struct<{row}>")
    changed = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast(kinds.get("n_chars", "long"))}
    return cleaned.select(*[changed[n].alias(n) if n in changed else F.col("others")[n].alias(n) for n in kinds])
