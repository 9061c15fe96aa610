"""Tables stored on the way to a result, and what is left of them."""

from __future__ import annotations

import os

from merchmill.llm import minhash_dedup
from merchmill.llm.common import shared_folder


def test_near_groups_leave_only_their_result_on_disk(spark):
    """The tables of signatures, buckets and pairs go; else the next stage of a pipeline runs beside them."""
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    texts = [" ".join(f"w{(i // 3) * 50 + k}" for k in range(40)) + f" end{i % 3}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = minhash_dedup.near_groups(docs)
    left = set(os.listdir(folder)) - before
    assert {n.rsplit("-", 1)[0] for n in left} == {"llm-near-groups"} and len(left) == 1, left
    assert {r.doc_id: r.component_id for r in groups.collect()} == {i: i - i % 3 for i in range(60)}
