"""Bulk-synchronous best-fit packing of token pieces into sequences of bounded length.

Sizes are bounded by the sequence length, so a range-sorted list of any number of pieces or gaps is a list
of at most ``limit`` runs of equal size. The rounds work on these runs: each round takes the longest run
of pieces left, sweeps to the successor in the sorted gaps (the smallest gap that is large enough), lets
the pieces of lowest rank take the gaps of lowest rank, moves the gaps to their new size and repeats.
Pieces are ranked inside their run by a distributed sort, and the matched runs are then applied to all
pieces by their rank. What reaches the driver is one count for each size, never pieces or sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchmill.llm.common import rows_of, stored, token_encoder, vocabulary_paths

LIMIT, END_ID = 2048, 0


def token_pieces(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, paths: tuple[str, str] | None = None,
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of the pieces of each row of ``docs``.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Only a document longer
    than ``limit`` is cut, into pieces of ``limit``, of which the first may be shorter.
    """
    paths = paths or vocabulary_paths()
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(*paths)
        for batch in rows_of(batches):
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = (encode(text) if text else b"") + end
                n = len(ids) // 4
                stop = n % limit or min(n, limit)
                start = piece = 0
                while start < n:
                    part = ids[4 * start:4 * stop]
                    out.append((doc, piece, start, stop - start, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype("i4")] if with_ids else [])))
                    start, stop, piece = stop, stop + limit, piece + 1
            columns = list(zip(*out)) or [[]] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)],
                                  ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def match_runs(counts: dict[int, int], limit: int = LIMIT) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over runs: rows (length, first rank, sequences, columns, first sequence, offset).

    The piece of rank r of a row goes to sequence first + (r - rank) % sequences, at the offset plus
    length times (r - rank) // sequences. Longest runs first; each takes the smallest gap that holds it.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, how many)
    order: list[int] = []  # gaps that occur, sorted
    used, rows = 0, []

    def give(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        if not 0 < length <= limit:
            raise ValueError(f"a piece of {length} ids doesn't fit into {limit}")
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                new = -(-left // (limit // length))
                give(limit, used, new)
                used += new
                at = bisect.bisect_left(order, length)
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            take = min(n, left)
            columns = min(gap // length, left // take)
            rows.append((length, rank, take, columns, first, limit - gap))
            rank, left = rank + take * columns, left - take * columns
            give(gap - length * columns, first, take)
            give(gap, first + take, n - take)
    return rows


def pack(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset.

    Every sequence is filled from 0 without gaps and holds ``limit`` ids at most. Repeated rows are packed
    each; no rows give none.
    """
    spark, columns = pieces.sparkSession, pieces.columns
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row per size
    plan = np.array(match_runs(counts, limit), np.int64).reshape(-1, 6)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    # rank in the run: place in the range partition plus what the partitions before it hold of that length
    spread = pieces.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            if not len(lengths):
                continue
            heads = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]])
            rank = np.arange(len(lengths)) - np.repeat(heads, np.diff(np.r_[heads, len(lengths)]))
            if lengths[0] == last:
                rank[: heads[1] if len(heads) > 1 else None] += seen
            last, seen = lengths[-1], rank[-1] + 1
            yield pa.record_batch([*batch.columns, pa.array(rank, pa.int64())], [*batch.schema.names, "rank_here"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    here = stored(spread.withColumn("range_no", F.spark_partition_id()).mapInArrow(
        place, f"{kinds}, range_no int, rank_here long"), "ranked-pieces")
    before = Window.partitionBy("length").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition and each size, not for each piece
    offsets = here.groupBy("length", "range_no").agg(F.count("*").alias("n")).select(
        "length", "range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before"))
    ranked = here.join(offsets, ["length", "range_no"]).select(*columns, (F.col("rank_here") + F.col("ranks_before")).alias("rank"))
    shared = spark.sparkContext.broadcast(plan)  # rows grow with the number of sizes, not of pieces

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = shared.value
        key = runs[:, 0] << 44 | runs[:, 1]
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            row = runs[np.searchsorted(key, lengths << 44 | rank, side="right") - 1] if len(rank) else runs[:0]
            at = rank - row[:, 1]
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(row[:, 4] + at % np.maximum(row[:, 2], 1), pa.int64()),
                 pa.array(row[:, 5] + lengths * (at // np.maximum(row[:, 2], 1)), pa.int64())],
                [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(apply, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, limit: int = LIMIT, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: all documents, packed."""
    return pack(stored(token_pieces(docs, limit, paths=paths), "pieces"), limit)
