import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from merchmill.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if c is None else float(c) for c in v], 1, "d") for i, v in rows], SCHEMA).repartition(3)


def lloyd(rows, k, rounds, d):
    """Every distance in every round, in whole numbers of Python."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [x for _, x in sorted(kept, key=key)[:k]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda: [min((apart(x, c), j) for j, c in enumerate(centroids)) for _, x in kept]
    for _ in range(rounds):
        found = nearest()
        for j in range(len(centroids)):
            own = [x for (_, x), (_, at) in zip(kept, found) if at == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    found = nearest()
    inertia = [sum(d for d, at in found if at == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i is not None, i or 0), j, d, inertia[j], sum(inertia), digest[j]) for (i, _), (d, j) in zip(kept, found))


def got(df):
    return sorted(((r.vec_id is not None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_against_every_distance(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + random.normal(size=8) * 0.4).tolist()) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 520)] + [(7, rows[3][1])] * 5 + [(None, rows[1][1])]  # copies, repeated ids, no id
    rows += [(900, None), (901, []), (902, [1.0] * 7), (903, [1.0] * 7 + [None]), (904, [float("nan")] * 8), (905, [float("-inf")] * 8)]
    df = clustering.cluster_vectors(frame(spark, rows), centroids=6, rounds=5, dimensions=8)
    assert got(df) == lloyd(rows, 6, 5, 8)
    assert df.agg({"measured": "sum"}).first()[0] < 0.5 * 526 * 6  # the bounds spared distances in the last round


def test_ties_few_rows_and_empty_clusters(spark):
    ties = [(i, [float(i % 2), 0.0]) for i in range(12)]  # equal centroids: the smaller number wins, the other stays empty
    df = clustering.cluster_vectors(frame(spark, ties), centroids=4, rounds=3, dimensions=2)
    assert got(df) == lloyd(ties, 4, 3, 2)
    few = [(5, [0.5, -0.5]), (6, [1.5, 2.0])]
    assert got(clustering.cluster_vectors(frame(spark, few), dimensions=2)) == lloyd(few, 16, 3, 2)
    assert got(clustering.cluster_vectors(frame(spark, few).where("false"), dimensions=2)) == []


def test_large_entries(spark):
    big = [(i, [(-1) ** i * 2.0 ** 20 + i, float(i)]) for i in range(30)]
    assert got(clustering.cluster_vectors(frame(spark, big), centroids=3, dimensions=2)) == lloyd(big, 3, 3, 2)
    with pytest.raises(Exception, match="beyond"):
        clustering.cluster_vectors(frame(spark, [(1, [2.0 ** 22, 0.0])]), dimensions=2).collect()


def test_starts_beyond_the_first_hash_bound(spark):
    """More rows than the bound lets pass in one go, and a count that needs it raised."""
    rows = [(i % 3, [float(i % 5), float(i % 7)]) for i in range(900)]  # three ids only: their hashes may all lie high
    vectors = clustering.whole_vectors(frame(spark, rows), "vec_id", "embedding", 2)
    key = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    want = sorted((key(i), [64 * int(c) for c in v]) for i, v in rows)[:16]
    assert clustering.smallest_by_hash(vectors, 16) == [x for _, x in want]


vectors = st.lists(st.lists(st.integers(-50, 50), min_size=3, max_size=3), min_size=1, max_size=40)


@settings(max_examples=80, deadline=None)
@given(vectors, st.lists(st.lists(st.lists(st.integers(-50, 50), min_size=3, max_size=3), min_size=4, max_size=4), min_size=1, max_size=6))
def test_bounds_never_change_an_assignment(rows, centroids):
    """Centroids that jump anywhere, and back: after every round each row has the nearest, smallest numbered one."""
    x, history = np.array(rows), np.array([centroids[0]])
    state = clustering.first_assign(x, history[-1])
    for moved in [*centroids[1:], centroids[0]]:
        history = np.concatenate([history, [moved]])
        state, _ = clustering.assign(x, state, history)
        assert state["cluster"].tolist() == clustering.squared(x, history[-1]).argmin(1).tolist()


def test_a_centroid_that_comes_back_loosens_nothing():
    x = np.array([[0, 0], [10, 0]])
    there, away = [[0, 0], [10, 0]], [[0, 400], [10, 400]]
    state = clustering.first_assign(x, np.array(there))
    after, measured = clustering.assign(x, state, np.array([there, away, there]))
    assert measured == 0 and after["cluster"].tolist() == [0, 1]
