import hashlib
import random

import numpy as np
import pytest

from merchmill.llm import suffix_dedup

LENGTH = 100


def expected(rows):
    """doc_id -> what ``remove_repeats`` returns; rows in the order of doc_id, null first."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - LENGTH + 1):
            window = raw[i:i + LENGTH]
            if window in seen:
                gone[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(window)
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def made_rows(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, common = prose(60), prose(40)
    rows = [(i, prose(rng.randint(0, 80))) for i in range(60)]
    rows += [(100 + i, prose(20) + " " + common + " " + prose(rng.randint(0, 20))) for i in range(40)]
    rows += [(200 + i, passage[i:] + prose(5)) for i in range(5)] + [(300, passage), (301, passage), (302, passage + passage)]
    rows += [(400, "ab" * 500), (401, "ab" * 300), (402, "a" * 1000), (403, None), (404, ""), (405, "short"), (None, passage + " last"), (406, passage[:99]),
             (407, passage[:100]), (408, rows[0][1] * 2), (409, "你好" * 100)]
    return rows


@pytest.mark.parametrize("frequent", [2_000, 3])
def test_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)  # few: stretches of common anchors are cut finer
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4_000)
    rows = made_rows()
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, k1 int, places string").repartition(4)
    got = {r[0]: (*r[1:5], bytes(r[5])) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == expected(rows)


def test_repeated_rows_are_one_document(spark):
    text = made_rows()[110][1] or "x" * 150
    rows = [(1, text), (1, text), (2, text)]
    got = sorted((r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    gone = expected([(1, text), (2, text)])
    assert got == [(1, gone[1][1]), (1, gone[1][1]), (2, gone[2][1])]


def test_rows_keep_their_columns(spark):
    rows = made_rows()
    docs = spark.createDataFrame([(i, t, "en", None, 7, i) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, spans long")
    cleaned = suffix_dedup.without_repeats(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    want = expected(rows)
    for r in cleaned.collect():
        assert (r.text or "") == want[r.doc_id][4].decode("utf-8", "ignore") and r.spans == r.doc_id and r.lang == "en"
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert suffix_dedup.without_repeats(docs.limit(0)).count() == 0


def test_windows_belong_to_one_anchor_however_long_texts_are_cut(monkeypatch):
    rng = np.random.default_rng(5)
    raw = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (5000, 99, 100, 3000, 0)]

    def windows():
        found = []
        for data, heads, of, skipped in suffix_dedup._blocks(raw, LENGTH):
            first, count, _, _ = suffix_dedup.anchors(data, heads, LENGTH)
            part = np.searchsorted(heads, first, side="right") - 1
            found += [(int(of[p]), int(f - heads[p] + skipped[p]) + k) for f, n, p in zip(first, count, part) for k in range(n)]
        return sorted(found)

    every = [(i, k) for i, r in enumerate(raw) for k in range(len(r) - LENGTH + 1)]
    assert windows() == every
    monkeypatch.setattr(suffix_dedup, "_BLOCK", 700)
    assert windows() == every


def test_spans_of_a_document_are_merged_and_kept_apart_from_the_next():
    import numpy as np

    rows = np.array([[1, 0, 50, 100], [1, 0, 150, 10], [1, 0, 10, 5], [1, 1, 0, 9], [2, 1, 4, 3], [1, 0, 60, 5], [-3, 0, 1, 2]], np.int64)
    keys, spans = suffix_dedup.merged_spans(rows)
    assert keys.tolist() == [[-3, 0], [1, 0], [1, 1], [2, 1]]
    assert [np.frombuffer(s, "<i4").reshape(-1, 2).tolist() for s in spans] == [[[1, 3]], [[10, 15], [50, 160]], [[0, 9]], [[4, 7]]]
    assert suffix_dedup.merged_spans(rows[:0])[1] == []


def test_a_very_long_text_through_the_job(spark):
    import hashlib

    words = [hashlib.md5(str(i).encode()).hexdigest() for i in range(40_000)]
    long, part = " ".join(words), " ".join(words[20_000:20_050])
    rows = [(1, long), (2, f"before {part} after"), (3, part)]
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == 0 and got[3] == len(part) and len(part) <= got[2] <= len(part) + 2
