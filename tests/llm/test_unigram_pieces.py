"""Encoding against the public library's own unigram search, all segmentations, and decoding back."""

from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from merchmill.llm import unigram_pieces as u

TEXTS = ["", " ", "  two  blanks ", "Hello world", "a\nb\tc", "né ∑ 你好 ▁ literal", "\x00\x01", "Oneaea " * 40, "x" * 300, "🙂🙂 é", "   lead",
         "tail   ", "日本語" * 60, "#$%&& !!", "The quick brown fox\n\njumps over"]


@pytest.fixture(scope="module")
def pieces():
    return u.load_pieces()


@pytest.fixture(scope="module")
def library(pieces):
    """The same pieces and scores as a unigram model of the public library."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    for i, p in enumerate(proto.pieces):
        p.score = float(pieces.scores[i])
        if p.type == p.USER_DEFINED:
            p.type = p.NORMAL
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def ids_of(pieces, texts):
    return [np.frombuffer(x, "<i4").tolist() for x in u.Segmenter(pieces).encode(texts)]


def test_equals_the_library(pieces, library):
    texts = [t for t in TEXTS if u.MARKER not in t]
    assert ids_of(pieces, texts) == library.encode(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("abet hn\né你🙂 .") | st.characters(exclude_categories=["Cs"], exclude_characters="▁"), max_size=90), max_size=8))
def test_any_text_as_the_library_and_back(pieces, library, texts):
    found = ids_of(pieces, texts)
    assert [u.decode(np.array(i, np.int32), pieces) for i in found] == texts
    plain = [t for t in texts if "\x00" not in t]
    assert ids_of(pieces, plain) == library.encode(plain)


def test_decodes_every_text_exactly(pieces):
    for text, ids in zip(TEXTS, ids_of(pieces, TEXTS)):
        assert u.decode(np.array(ids, np.int32), pieces) == text


def test_best_of_all_segmentations(pieces):
    table = {pieces.surface[i]: pieces.scores[i] for i in range(len(pieces.scores)) if pieces.surface[i] and i not in set(pieces.byte_ids.tolist())}

    @lru_cache(None)
    def best(text):
        if not text:
            return 0.0
        options = [table[text[:k].encode()] + best(text[k:]) for k in range(1, len(text) + 1) if text[:k].encode() in table]
        if text[0].encode() not in table:
            options.append(pieces.unknown + best(text[1:]))
        return max(options)

    for text in ("there", "ononing", "heitung", "zé∑b"):
        ids = ids_of(pieces, [text])[0]
        is_byte = np.isin(ids, pieces.byte_ids)
        unknown = sum(1 for c in text if c.encode() not in table)
        assert sum(pieces.scores[ids][~is_byte]) + unknown * pieces.unknown == pytest.approx(best(" " + text))


def test_long_and_short_parts_agree(pieces, monkeypatch):
    side = ids_of(pieces, TEXTS)
    monkeypatch.setattr(u, "_SHORT", 0)
    assert ids_of(pieces, TEXTS) == side


def test_documents(spark):
    docs = spark.createDataFrame([(1, "one two", 5), (2, None, 6), (None, "", 7), (2, "x ▁", 8)], "doc_id long, text string, ids long")
    rows = {(r.doc_id, r.n_tokens > 0): r for r in u.encode_documents(docs).collect()}
    assert len(rows) == 4 and all(r.decoded_equal for r in rows.values())
    assert rows[(2, False)].ids == [] and rows[(2, True)].n_byte_tokens == 3
    back = u.decode_documents(u.encode_documents(docs)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == [("1", "one two"), ("2", ""), ("2", "x ▁"), ("None", "")]
    assert u.encode_documents(docs.limit(0)).count() == 0
    assert u.encode_documents(docs, digests=True).columns[-1] == "ids_crc32"
