"""Token ids as raw binary shards, with a minimal perfect hash index for access by document key.

A store is a folder. ``shards/`` holds the ids of all documents in ascending doc_id order, little-endian
and without headers, as 2 bytes an id where the vocabulary allows it, else 4; each document ends with the
end id 0. Spark's text writer makes the files: a document's ids are one value, and its line end is the
end id. The last value of a shard is its footer: key, whether the key is null, and length of each document.

``manifest/`` has one row for each shard. ``index/`` has one row for each bucket of some ``BUCKET`` keys:
a hash function without collisions (levels of bits: a key that is alone at its place in a level has found
its place, the others go on to the next level) that numbers the n keys 0 to n - 1, and under that number
a 32-bit fingerprint of the key, its shard, place in the shard, place in all ids, and length. Looking a
key up takes two levels on average, then one read at a known offset.

A document's key is (doc_id, copy): rows that repeat a doc_id are numbered from 0 in the order of the
64-bit hashes of their texts, then of the texts.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchmill.llm.common import rows_of, stored, token_encoder, vocabulary_paths

MAGIC = b"IDSHARD1"
#: Keys of a bucket on average, bits of a level for each key in it, and levels tried at most.
BUCKET, GAMMA, LEVELS = 1 << 14, 2, 64
#: Bytes of ids that a reading task turns into one Arrow batch, unless one document has more.
READ_BYTES = 16 << 20

ENTRY = "doc_id long, copy long, shard int, place long, start long, n_tokens long"


# --- writing ---------------------------------------------------------------------------------

@functools.lru_cache(maxsize=4)
def id_width(json_path: str) -> int:
    """Bytes of an id: 2 where all ids of the vocabulary fit."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(json_path).get_vocab_size() <= 1 << 16 else 4


def write_shards(docs: DataFrame, path: str, paths: tuple[str, str] | None = None) -> None:
    """Write ``path/shards`` from doc_id and text; null and empty texts have the end id alone.

    Rows are range-partitioned by doc_id, then by text hash, then by a row id, so that neither a repeated
    doc_id nor a repeated row has to lie in one task. A null doc_id comes first.
    """
    paths = paths or vocabulary_paths()
    width = id_width(paths[0])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(*paths)
        keys, lengths = [], []
        for batch in rows_of(batches):
            ids = [encode(t) if t else b"" for t in batch.column(1).to_pylist()]
            if width == 2:
                ids = [np.frombuffer(i, "<u4").astype("<u2").tobytes() for i in ids]
            keys.append(batch.column(0))
            lengths.append(np.array([len(i) // width + 1 for i in ids], "<i8"))
            yield pa.record_batch([pa.array(ids, pa.binary())], ["value"])
        if keys:
            yield pa.record_batch([pa.array([_footer(pa.chunked_array(keys), np.concatenate(lengths))], pa.binary())], ["value"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order, "text")
    values = ranged.mapInArrow(encoded, "value binary").select(F.col("value").cast("string"))
    values.write.options(lineSep="\0" * width, compression="none").text(f"{path}/shards")


def _footer(keys: pa.ChunkedArray, lengths: np.ndarray) -> bytes:
    null = keys.is_null().to_numpy().astype("u1")
    known = keys.fill_null(0).to_numpy().astype("<i8")
    counts = np.array([len(lengths), lengths.sum()], "<i8")
    return b"".join([known.tobytes(), null.tobytes(), lengths.tobytes(), counts.tobytes(), MAGIC])


def file_system(path: str):
    """The pyarrow file system of a path and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1)) if "://" in path else (fs.LocalFileSystem(), path)


def _read_footer(file, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, null flags, lengths) of an open shard; only its end is read."""
    end = file.size() - width
    file.seek(end - 24)
    tail = file.read(24)
    if tail[16:] != MAGIC:
        raise ValueError("a shard doesn't end with its footer")
    n = int(np.frombuffer(tail[:8], "<i8")[0])
    file.seek(end - 24 - 17 * n)
    rest = file.read(17 * n)
    return np.frombuffer(rest[: 8 * n], "<i8"), np.frombuffer(rest[8 * n:9 * n], "u1"), np.frombuffer(rest[9 * n:], "<i8")


def _shard_files(path: str) -> list[str]:
    from pyarrow import fs

    store, folder = file_system(f"{path}/shards")
    names = [x.base_name for x in store.get_file_info(fs.FileSelector(folder)) if x.base_name.startswith("part-") and x.size]
    return sorted(names, key=_part)


def _part(name: str) -> int:
    """The number of the task that wrote a file; tasks have ascending ranges of keys."""
    return int(name.split("-")[1])


# --- manifest --------------------------------------------------------------------------------

def write_manifest(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Read the footers' sums and store one row for each shard: shard, file, n_docs, n_ids, ids_before,
    copies_before (documents of earlier shards that have the key this one begins with).

    The rows, one for each file as in Spark's own listing, are put in order by the driver.
    """
    files = _shard_files(path)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(f"{path}/shards")
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{folder}/{name}") as file:
                    keys, null, lengths = _read_footer(file, width)
                last = int(((keys == keys[-1]) & (null == null[-1])).sum())
                out.append((name, len(keys), int(lengths.sum()), None if null[0] else int(keys[0]), None if null[-1] else int(keys[-1]), last))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, [pa.string()] + [pa.int64()] * 5)],
                                  ["file", "n_docs", "n_ids", "first", "last", "last_run"])

    named = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism)))
    rows = named.mapInArrow(sums, "file string, n_docs long, n_ids long, first long, last long, last_run long").collect()
    rows.sort(key=lambda r: _part(r["file"]))
    out, ids, last, run = [], 0, (), 0
    for shard, r in enumerate(rows):
        before = run if last == (r["first"],) else 0
        out.append((shard, r["file"], r["n_docs"], r["n_ids"], ids, before))
        run = r["last_run"] + (before if r["last_run"] == r["n_docs"] else 0)
        last, ids = (r["last"],), ids + r["n_ids"]
    manifest = spark.createDataFrame(out, "shard int, file string, n_docs long, n_ids long, ids_before long, copies_before long")
    manifest.write.parquet(f"{path}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{path}/manifest")


def shard_entries(manifest: DataFrame, path: str, width: int) -> DataFrame:
    """doc_id, copy, shard, place, start, n_tokens of every document, from the footers."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(f"{path}/shards")
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{folder}/{r['file']}") as file:
                    keys, null, lengths = _read_footer(file, width)
                n = len(keys)
                heads = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])])
                copy = np.arange(n) - np.repeat(heads, np.diff(np.r_[heads, n]))
                copy[: heads[1] if len(heads) > 1 else n] += r["copies_before"]
                place = np.cumsum(lengths) - lengths
                columns = [pa.array(keys, mask=null.astype(bool)), pa.array(copy), pa.array(np.full(n, r["shard"], "i4")),
                           pa.array(place), pa.array(place + r["ids_before"]), pa.array(lengths)]
                yield from pa.Table.from_arrays(columns, ["doc_id", "copy", "shard", "place", "start", "n_tokens"]).to_batches(1 << 16)

    parts = max(1, 4 * manifest.sparkSession.sparkContext.defaultParallelism)
    return manifest.select("shard", "file", "ids_before", "copies_before").repartition(parts, "shard").mapInArrow(entries, ENTRY)


# --- the index -------------------------------------------------------------------------------

def key_hashes() -> list[Column]:
    """Two 64-bit hashes of a key (doc_id, copy)."""
    return [F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "copy").alias(f"h{seed}") for seed in (1, 2)]


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """A fresh 64-bit hash for each level."""
    with np.errstate(over="ignore"):
        x = a + b * np.uint64(2 * level + 1) + np.uint64(level) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level sizes in words, words of bits, number of each key) for keys with the hashes ``a`` and ``b``."""
    left, sizes, words = np.arange(len(a)), [], []
    number, placed = np.zeros(len(a), np.int64), 0
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError("keys repeat, or share a hash of 128 bits")
        size = -(-GAMMA * len(left) // 64)
        at = (_mix(a[left], b[left], len(sizes)) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * size) == 1
        rank = np.cumsum(alone) - 1
        done = alone[at]
        number[left[done]] = placed + rank[at[done]]
        placed += int(done.sum())
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~done]
    return np.array(sizes, "<i4"), np.concatenate(words) if words else np.zeros(0, "<u8"), number


def hash_numbers(sizes: np.ndarray, words: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of each key by the function of ``build_hash``; -1 where a key that isn't among them found no place."""
    before = np.cumsum(np.bitwise_count(words)) - np.bitwise_count(words)
    number, left, base = np.full(len(a), -1, np.int64), np.arange(len(a)), 0
    for level, size in enumerate(sizes.tolist()):
        at = _mix(a[left], b[left], level) % np.uint64(64 * size)
        word, bit = base + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        hit = (words[word] >> bit) & np.uint64(1) == 1
        low = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
        number[left[hit]] = before[word[hit]] + np.bitwise_count(low)
        left, base = left[~hit], base + size
    return number


COLUMNS = {"fingerprint": "<u4", "shard": "<i4", "place": "<i8", "start": "<i8", "n_tokens": "<i8"}
INDEX = "bucket long, n long, sizes binary, words binary, " + ", ".join(f"{c} binary" for c in COLUMNS)


def write_index(entries: DataFrame, path: str, n_docs: int) -> DataFrame:
    """Write ``path/index`` from ``shard_entries``. Buckets go by key hash, so none grows with the data or a hot id."""
    buckets = max(1, -(-n_docs // BUCKET))
    kinds = [c for c in COLUMNS if c != "fingerprint"]
    rows = entries.select(*key_hashes(), *kinds).withColumn("bucket", F.pmod("h1", F.lit(buckets)))

    def build(bucket: tuple, group: pa.Table) -> pa.Table:
        a, b = (group[h].to_numpy().view(np.uint64) for h in ("h1", "h2"))
        sizes, words, number = build_hash(a, b)
        order = np.empty(len(a), np.int64)
        order[number] = np.arange(len(a))
        values = {c: group[c].to_numpy() for c in kinds} | {"fingerprint": (b >> np.uint64(32))}
        row = [bucket[0].as_py(), len(a), sizes.tobytes(), words.tobytes(), *(values[c][order].astype(t).tobytes() for c, t in COLUMNS.items())]
        return pa.table([pa.array([v]) for v in row], ["bucket", "n", "sizes", "words", *COLUMNS])

    index = rows.groupBy("bucket").applyInArrow(build, INDEX)
    index.write.parquet(f"{path}/index")
    return entries.sparkSession.read.schema(index.schema).parquet(f"{path}/index")


def write_store(docs: DataFrame, path: str, paths: tuple[str, str] | None = None) -> None:
    """Write shards, manifest and index of ``docs`` (doc_id, text; other columns are left) to a new folder.

    No documents give a store without shards and without index rows. ``path`` must be one that executors share.
    """
    paths = paths or vocabulary_paths()
    width = id_width(paths[0])
    write_shards(docs, path, paths)
    manifest = write_manifest(docs.sparkSession, path, width)
    n_docs = manifest.agg(F.sum("n_docs")).first()[0] or 0
    write_index(shard_entries(manifest, path, width), path, n_docs)


# --- reading ---------------------------------------------------------------------------------

def locate(keys: DataFrame, path: str) -> DataFrame:
    """doc_id, copy, shard, place, start, n_tokens of the distinct ``keys`` (doc_id, copy) that the store holds.

    Each bucket of the index meets its keys in one task. A key that the store has is always found. One that
    it lacks gives no row, but for a chance of 2^-32 that its fingerprint is that of the key at its place.
    """
    spark = keys.sparkSession
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    # the number of buckets follows from the number of documents, as in write_index
    n_docs = spark.read.parquet(f"{path}/manifest").agg(F.sum("n_docs")).first()[0] or 0
    buckets = max(1, -(-n_docs // BUCKET))
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy")).distinct()
    wanted = wanted.select("*", *key_hashes()).withColumn("bucket", F.pmod("h1", F.lit(buckets)))

    def find(group: pa.Table, rows: pa.Table) -> pa.Table:
        empty = not group.num_rows or not rows.num_rows
        a, b = (group[h].to_numpy().view(np.uint64) for h in ("h1", "h2"))
        row = {} if empty else rows.to_pylist()[0]
        number = np.full(len(a), -1) if empty else hash_numbers(np.frombuffer(row["sizes"], "<i4"), np.frombuffer(row["words"], "<u8"), a, b)
        columns = {c: np.frombuffer(b"" if empty else row[c], t) for c, t in COLUMNS.items()}
        found = np.flatnonzero(number >= 0)
        found = found[columns["fingerprint"][number[found]] == b[found] >> np.uint64(32)]
        at = number[found]
        here = group.select(["doc_id", "copy"]).take(pa.array(found))
        return pa.table([*here.columns, *(pa.array(columns[c][at]) for c in COLUMNS if c != "fingerprint")],
                        ["doc_id", "copy", "shard", "place", "start", "n_tokens"])

    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(find, ENTRY)


def read_ids(located: DataFrame, path: str, width: int, with_ids: bool = False) -> DataFrame:
    """The rows of ``locate`` with ids_crc32 (unsigned, of the ids as little-endian unsigned 32-bit) and ids if wanted.

    Tasks take runs of places of a shard, in order, and read each document at its offset.
    """
    spark = located.sparkSession
    files = spark.read.parquet(f"{path}/manifest").select("shard", "file")
    rows = located.join(files, "shard").withColumn("run", F.expr(f"place div {READ_BYTES}"))
    rows = rows.repartition("shard", "run").sortWithinPartitions("shard", "place").drop("run")
    schema = ENTRY + ", ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(f"{path}/shards")
        file, name = None, None
        for batch in rows_of(batches):
            names, places, lengths = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "place", "n_tokens"))
            first, sums, ids, held = 0, [], [], 0
            for i, (wanted, place, length) in enumerate(zip(names, places, lengths)):
                if wanted != name:
                    file = file and file.close()
                    file, name = store.open_input_file(f"{folder}/{wanted}"), wanted
                file.seek(place * width)
                raw = np.frombuffer(file.read(length * width), f"<u{width}").astype("<u4")
                if len(raw) != length:
                    raise ValueError(f"{wanted} ends before the ids of a document")
                sums.append(zlib.crc32(raw))
                if with_ids:
                    ids.append(raw.astype("<i4"))
                    held += raw.nbytes
                    if held > READ_BYTES:
                        yield out(batch.slice(first, i + 1 - first), sums, ids)
                        first, sums, ids, held = i + 1, [], [], 0
            yield out(batch.slice(first), sums, ids)
        if file:
            file.close()

    def out(batch: pa.RecordBatch, sums: list[int], ids: list) -> pa.RecordBatch:
        names = ["doc_id", "copy", "shard", "place", "start", "n_tokens"]
        columns = [batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(sums, pa.int64())]
        return pa.record_batch([*columns, pa.array(ids, pa.list_(pa.int32()))] if with_ids else columns,
                               [*names, "ids_crc32", "ids"][: len(columns) + with_ids])

    return rows.mapInArrow(read, schema)


def all_keys(docs: DataFrame) -> DataFrame:
    """doc_id, copy: one row for each row of ``docs``. Copies of a hot id are numbered in blocks, never in one array."""
    block = 1 << 12
    counts = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count("*").alias("n"))
    blocks = counts.select("doc_id", "n", F.explode(F.expr(f"sequence(0L, (n - 1) div {block})")).alias("block"))
    return blocks.select("doc_id", F.explode(F.expr(f"sequence(block * {block}, least(n, (block + 1) * {block}) - 1)")).alias("copy"))


def round_trip(docs: DataFrame, path: str, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, copy, shard of every row of ``docs``, looked up by key and read from the files.

    Written with ``write_store`` to ``path``. Null and empty texts have the end id alone; a null doc_id
    comes first; rows that repeat a doc_id follow each other. No rows give none.
    """
    paths = paths or vocabulary_paths()
    write_store(docs, path, paths)
    found = stored(locate(all_keys(docs), path), "token-entries")
    return read_ids(found, path, id_width(paths[0])).select("doc_id", "start", "n_tokens", "ids_crc32", "copy", "shard")
