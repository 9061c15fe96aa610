"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text is cut before each run of blanks. No piece holds a whitespace marker behind another character, so
the best segmentation of a text is that of its parts, and equal parts are segmented once a batch. A blank
becomes the marker, a text starts with one more, and a character without a piece becomes its bytes; so
does the marker's own character, which keeps decoding exact for every text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import rows_of

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
_PARTS = re.compile(r" +[^ ]*")
_NO_UTF8 = b"\xff"  # stands for a marker that the text itself holds
_SHORT = 64  # parts up to so many bytes are segmented side by side
_KNOWN_PARTS = 200_000  # segmentations kept beside a task; only speed depends on it


@dataclass(frozen=True)
class Pieces:
    """Pieces with log scores in a double-array trie: the child of state s by byte c is t = base[s] + c if check[t] = s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # id of the piece that ends at a state, else -1
    scores: np.ndarray
    surface: list[bytes]  # what an id decodes to
    byte_ids: np.ndarray
    unknown: float  # log score of a character without a piece


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value) of a trie over ``keys``. State 0 is the root; no byte of a key may be missing."""
    size = 1 << 12
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    check[0] = -2
    todo = [(0, sorted(keys), 0)]
    free = wide = 1
    while todo:
        state, below, depth = todo.pop()
        children: dict[int, list[bytes]] = {}
        for k in below:
            if len(k) == depth:
                value[state] = keys[k]
            else:
                children.setdefault(k[depth], []).append(k)
        if not children:
            continue
        codes = np.sort(np.fromiter(children, np.int64))
        while check[free] != -1:
            free += 1
        at, seen, width = -1, free if len(codes) == 1 else max(free, wide), 256
        while at < 0:  # look at more and more free places for the first child
            while seen + width + 512 > len(check):
                base, check, value = (np.r_[a, np.full(len(a), fill, np.int32)] for a, fill in ((base, 0), (check, -1), (value, -1)))
            tries = seen + np.flatnonzero(check[seen:seen + width] == -1) - codes[0]
            tries = tries[tries >= 0]
            fits = tries[(check[tries[:, None] + codes[1:]] == -1).all(1)]
            at = int(fits[0]) if len(fits) else -1
            seen, width = seen + width, width * 2
        if len(codes) > 1:  # later nodes don't look again at places where this one didn't fit
            wide = max(wide, at - 1024)
        base[state] = at
        check[at + codes] = state
        todo += [(at + c, ks, depth + 1) for c, ks in children.items()]
    return base, check, value


def load_pieces(path: str | None = None) -> Pieces:
    """Pieces of a SentencePiece model file.

    Scores of a unigram model are taken as they are. A BPE model has ranks instead: a rank r then counts as
    the log score -ln(r + 2), by Zipf's law, in steps of 1/1024, and pieces without a rank as the rarest.
    """
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    ranked = proto.trainer_spec.model_type != proto.trainer_spec.UNIGRAM
    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    scores, keys, surface, byte_ids = np.zeros(n), {}, [b""] * n, np.full(256, -1, np.int32)
    for i in range(n):
        piece, raw = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            surface[i] = bytes([int(piece[3:5], 16)])
            byte_ids[surface[i][0]] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {i} has a marker behind another character")
            surface[i] = piece.replace(MARKER, " ").encode()
            keys[piece.encode()] = i
            scores[i] = raw if not ranked else round(-log((-raw if raw > -n else n) + 2) * 1024) / 1024
    used = list(keys.values())
    return Pieces(*double_array(keys), scores, surface, byte_ids, float(scores[used].min()) - UNKNOWN_PENALTY)


def _part_bytes(part: str) -> bytes:
    raw = part.encode("utf-8", "replace")
    if MARKER in part:
        raw = raw.replace(MARKER.encode(), _NO_UTF8)
    return raw.replace(b" ", MARKER.encode())


def _character_length(lead: int) -> int:
    return 4 if 0xF0 <= lead < 0xFF else 3 if 0xE0 <= lead < 0xF0 else 2 if 0xC0 <= lead < 0xE0 else 1


_LENGTHS = np.array([_character_length(c) for c in range(256)], np.int64)


class Segmenter:
    """Texts -> ids, best segmentations by summed log scores; of equal sums the one with the longest last piece."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.known = pieces, {}
        self.lists = None

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids as little-endian 32-bit integers for each text; none for null and empty texts."""
        cut = [_PARTS.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > _KNOWN_PARTS:
            self.known = {}
        self._learn(list(set().union(*cut).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, parts)) for parts in cut]

    def _learn(self, parts: list[str]) -> None:
        raw = sorted(((_part_bytes(p), p) for p in parts), key=lambda x: len(x[0]))
        ends = 0
        while ends < len(raw) and len(raw[ends][0]) <= _SHORT:
            ends += 1
        for s in range(0, ends, 4096):
            block = raw[s:min(s + 4096, ends)]
            for (_, part), ids in zip(block, self._side_by_side([b for b, _ in block])):
                self.known[part] = ids
        for b, part in raw[ends:]:
            self.known[part] = self._alone(b)

    def _ids(self, raw: bytes, path: list[tuple[int, int, int]]) -> bytes:
        out: list[int] = []
        for start, end, piece in reversed(path):
            if piece >= 0:
                out.append(piece)
            else:
                character = raw[start:end]
                out += [int(self.pieces.byte_ids[c]) for c in (MARKER.encode() if character == _NO_UTF8 else character)]
        return np.array(out, "<i4").tobytes()

    def _side_by_side(self, raws: list[bytes]) -> list[bytes]:
        p, n = self.pieces, len(raws)
        sizes = np.array([len(r) for r in raws])
        longest = int(sizes.max())
        text = np.frombuffer(b"".join(r.ljust(longest, b"\0") for r in raws), np.uint8).reshape(n, longest).astype(np.int64)
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        back, piece = np.zeros((n, longest + 1), np.int16), np.full((n, longest + 1), -1, np.int32)
        for i in range(longest):
            rows = np.flatnonzero((best[:, i] > -np.inf) & (sizes > i))
            if not len(rows):
                continue
            lacking = np.ones(n, bool)  # no piece for the character that starts here
            one = i + _LENGTHS[text[rows, i]]
            first_end = np.zeros(n, np.int64)
            first_end[rows] = one
            live, state, score, j = rows, np.zeros(len(rows), np.int64), best[rows, i], i
            while len(live):
                after = p.base[state] + text[live, j]
                go = (p.check[after] == state) & (sizes[live] > j)
                live, state, score = live[go], after[go].astype(np.int64), score[go]
                j += 1
                ids = p.value[state]
                hit = ids >= 0
                if hit.any():
                    at, gain = live[hit], score[hit] + p.scores[ids[hit]]
                    lacking[at[first_end[at] == j]] = False
                    better = gain > best[at, j]
                    at = at[better]
                    best[at, j], back[at, j], piece[at, j] = gain[better], i, ids[hit][better]
                if j == longest:
                    break
            bare = lacking[rows] & (one <= sizes[rows])
            rows, one = rows[bare], one[bare]
            gain = best[rows, i] + p.unknown
            better = gain > best[rows, one]
            rows, one = rows[better], one[better]
            best[rows, one], back[rows, one], piece[rows, one] = gain[better], i, -1
        out = []
        back_rows, piece_rows = back.tolist(), piece.tolist()
        for r, raw in enumerate(raws):
            path, end = [], len(raw)
            while end:
                start = back_rows[r][end]
                path.append((start, end, piece_rows[r][end]))
                end = start
            out.append(self._ids(raw, path))
        return out

    def _alone(self, raw: bytes) -> bytes:
        p = self.pieces
        if self.lists is None:
            self.lists = p.base.tolist(), p.check.tolist(), p.value.tolist(), p.scores.tolist()
        base, check, value, scores = self.lists
        n, low = len(raw), float("-inf")
        best, back = [0.0] + [low] * n, [(0, -1)] * (n + 1)
        for i in range(n):
            here = best[i]
            if here == low:
                continue
            one, lacking, state, j = i + _character_length(raw[i]), True, 0, i
            while j < n:
                after = base[state] + raw[j]
                if check[after] != state:
                    break
                state, j = after, j + 1
                if (id_ := value[state]) >= 0:
                    lacking &= j != one
                    if here + scores[id_] > best[j]:
                        best[j], back[j] = here + scores[id_], (i, id_)
            if lacking and here + p.unknown > best[one]:
                best[one], back[one] = here + p.unknown, (i, -1)
        path, end = [], n
        while end:
            start, id_ = back[end]
            path.append((start, end, id_))
            end = start
        return self._ids(raw, path)


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """The text of ``ids``: markers become blanks, byte pieces bytes, and the first marker goes."""
    raw = b"".join(map(pieces.surface.__getitem__, ids.tolist()))
    return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_byte_tokens, decoded_equal, and ids (array<int>),
    or with ``digests`` their ids_crc32 (little-endian 32-bit) instead.

    Whole texts are encoded and decoded again; decoded_equal says whether that gives the text. Null and
    empty texts have no ids and are equal. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(path))  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        segment = Segmenter(pieces)
        is_byte = np.zeros(len(pieces.scores), bool)
        is_byte[pieces.byte_ids[pieces.byte_ids >= 0]] = True
        for batch in rows_of(batches):
            texts = batch.column(1).to_pylist()
            coded = segment.encode(texts)
            ids = [np.frombuffer(c, "<i4") for c in coded]
            last = pa.array([zlib.crc32(c) for c in coded], pa.int64()) if digests else pa.array(ids, pa.list_(pa.int32()))
            yield pa.record_batch([
                batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                pa.array([decode(i, pieces) == (t or "") for i, t in zip(ids, texts)], pa.bool_()), last],
                ["doc_id", "n_tokens", "n_byte_tokens", "decoded_equal", "ids_crc32" if digests else "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, n_byte_tokens long, decoded_equal boolean, " + ("ids_crc32 long" if digests else "ids array<int>"))


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from rows of doc_id, ids. Null ids count as none and give an empty text."""
    shared = coded.sparkSession.sparkContext.broadcast(load_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            yield pa.record_batch([batch.column(0), pa.array(
                [decode(np.array(i or [], np.int32), shared.value) for i in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
