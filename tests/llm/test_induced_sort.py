import numpy as np
import pytest

from merchmill.llm.induced_sort import sorted_buckets


@pytest.mark.parametrize("seed", range(40))
def test_order_and_common_prefixes_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, depth = int(rng.integers(2, 300)), int(rng.integers(1, 60))
    text = rng.integers(1, int(rng.integers(2, 6)), n).astype(np.uint8)
    if seed % 3 == 0:
        text = np.tile(text[:7], 60)[:n]
    for z in rng.integers(1, n, 4):
        if z < n - 1 and text[z - 1] and text[z + 1]:
            text[z] = 0
    text = np.r_[text, np.uint8(0)]
    raw, order, shared = bytes(text), [], []
    for places, prefixes in sorted_buckets(text, depth, held=40 if seed % 2 else 1 << 20):  # few held: queues spill
        order += places.tolist()
        shared += [0, *prefixes[1:].tolist()]
    assert sorted(order) == list(range(len(raw)))
    for before, here, common in zip(order, order[1:], shared[1:]):
        a, b = raw[before:][:depth], raw[here:][:depth]
        assert a >= b
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common == k
