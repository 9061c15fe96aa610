from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from merchmill.llm import packing, token_counts
from merchmill.llm.common import token_encoder, vocabulary_paths

TEXTS = ["", None, "one two", "x <|endoftext|> y", "it's  two\n\n blanks \t.", "né 你好 🙂 İ", " lead", "\x00\x1f 　 odd", "a" * 9000,
         "word " * 5000, "tail  "]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_paths()[0])


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 's\n\t.1é你<|endoftext|>") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_fast_ids_are_the_tokenizer_ones(tokenizer, text):
    ids = np.frombuffer(token_encoder(*vocabulary_paths())(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def docs_of(spark):
    return spark.createDataFrame([(i, t, i, "p") for i, t in enumerate(TEXTS)] + [(None, "one two", 0, "q"), (2, "one two", 0, "q")],
                                 "doc_id long, text string, length int, piece string").repartition(3)


def test_pieces_and_places(spark, tokenizer):
    rows = packing.pack_documents(docs_of(spark)).collect()
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, text in enumerate(TEXTS):
        if i == 2:
            continue
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert sum(p.length for p in pieces) == len(ids) and all(p.length == 2048 for p in pieces[1:])
        assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()
        assert [p.ids_crc32 for p in pieces] == [crc32(ids[p.start:p.start + p.length].tobytes()) for p in pieces]
    assert len(by_doc[2]) == 2 and len(by_doc[None]) == 1
    fits(rows, 2048)
    assert packing.pack_documents(docs_of(spark).limit(0)).count() == 0


def fits(rows, limit):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= limit
    return len(sequences)


def best_fit_decreasing(lengths, limit):
    gaps = []
    for n in sorted(lengths, reverse=True):
        at = min((i for i, g in enumerate(gaps) if g >= n), key=lambda i: gaps[i], default=None)
        if at is None:
            gaps.append(limit - n)
        else:
            gaps[at] -= n
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_runs_pack_as_well_as_best_fit_one_by_one(lengths):
    counts = Counter(lengths)
    placed = Counter()
    sequences = defaultdict(int)
    for length, rank, n, columns, first, offset in packing.match_runs(counts, 50):
        for r in range(n * columns):
            assert rank + r == placed[length]
            placed[length] += 1
            assert sequences[first + r % n] == offset + length * (r // n)
            sequences[first + r % n] += length
    assert placed == counts and all(v <= 50 for v in sequences.values())
    assert len(sequences) == best_fit_decreasing(lengths, 50)


def test_many_pieces_of_one_size_are_ranked_over_partitions(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 = 0 THEN 700 ELSE id % 900 + 1 END AS length").repartition(7)
    rows = packing.pack(df).collect()
    assert len(rows) == 3000
    lengths = [r.length for r in rows]
    assert fits(rows, 2048) == best_fit_decreasing(lengths, 2048) <= sum(lengths) / 2048 * 1.01 + 1


def test_totals_for_every_limit(spark, tokenizer):
    got = {r.context_limit: r for r in token_counts.token_counts(docs_of(spark)).collect()}
    lengths = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in [*TEXTS, "one two", "one two"]]
    assert got.keys() == set(lengths)
    for limit, r in got.items():
        assert r.docs == lengths.count(limit) and r.docs_over == sum(n > limit for n in lengths)
        assert r.tokens_upto == sum(n for n in lengths if n <= limit)
        assert r.tokens_truncated == sum(min(n, limit) for n in lengths)
        assert r.tokens_lost == sum(lengths) - r.tokens_truncated
        assert r.quantile == pytest.approx(sum(n <= limit for n in lengths) / len(lengths))
    assert token_counts.token_counts(docs_of(spark).limit(0)).count() == 0
