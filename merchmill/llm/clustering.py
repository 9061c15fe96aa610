"""Exact rounds of nearest-centroid clustering with ns-bounds.

Each row keeps, beside its centroid and a distance to it, a lower bound on its distance to every centroid,
all as they were measured, with the round of the measurement. The centroids of all rounds are kept. In a
later round a distance measured in round t can have changed by no more than the norm of the centroid's total
displacement since t, which is at most, and for a centroid that turns back far below, the sum of its moves
of each round. Where these loosened bounds don't show that the row stays, its own distance is measured
again, and after it the distances to just those centroids whose bound isn't above it; equal distances go to
the smaller number. All distances that decide are squared whole numbers, so the assignment is exact.

The rows with their bounds are a table in the shared folder, written anew in each round; what reaches the
driver is a sum of vectors for each centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import stored
from merchmill.llm.whitening import matrix, whole_number

CENTROIDS, DIMENSIONS, ROUNDS, SEED = 16, 64, 3, 1
#: Largest whole number: a squared distance in 64 dimensions then fits in 64 bits.
LARGEST = 1 << 27
#: Relative slack that covers the roundings of a bound.
SLACK = 1e-9


def whole_vectors(embeddings: DataFrame, id_column: str, column: str, dimensions: int) -> DataFrame:
    """id, x: rows with exactly ``dimensions`` entries, none null or non-finite, as floor(64 * entry).

    Other rows are left out. An entry that gives more than 2^27 either way is an error.
    """
    number = lambda c: c.cast("double")
    finite = lambda c: F.coalesce(~F.isnan(number(c)) & (F.abs(number(c)) < float("inf")), F.lit(False))
    kept = embeddings.where(F.size(column) == dimensions).where(F.forall(column, finite))
    return kept.select(F.col(id_column).cast("long").alias("id"), F.transform(column, lambda c: whole_number(c, LARGEST).cast("int")).alias("x"))


def smallest_by_hash(vectors: DataFrame, count: int, seed: int = SEED) -> list[list[int]]:
    """``x`` of the ``count`` rows with the smallest SHA-256 of "seed:id", in order; of one id the smaller vector first.

    A null id is hashed as "null". Hashes are spread evenly: a bound that lets about 64 rows more than
    wanted pass keeps all others out of the sort, and is raised should too few pass.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    hashed, bits = vectors.withColumn("key", key), 40
    share = min(1.0, (count + 64) / max(1, vectors.count()))
    while True:
        below = hashed if share >= 1 else hashed.where(F.col("key") < f"{int(share * (1 << bits)):0{bits // 4}x}")
        # rows of one id share a key, so the sort itself is by key and vector, each repeated row counted
        grouped = below.groupBy("key", "x").agg(F.count("*").alias("n")).orderBy("key", "x").limit(count).collect()
        found = [list(r["x"]) for r in grouped for _ in range(min(r["n"], count))][:count]
        if len(found) == count or share >= 1:
            return found
        share = min(1.0, share * 8)


def _exact_as_float(x: np.ndarray, c: np.ndarray) -> bool:
    """Whether all sums of products stay below 2^53, so that floating-point ones are exact."""
    return max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0))) < 1 << 22 and x.shape[1] <= 1 << 6


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of ``x`` to each row of ``c``, whole numbers."""
    if _exact_as_float(x, c):
        x, c = x.astype(float), c.astype(float)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([squared_each(x, row) for row in c], 1)


def squared_each(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of ``x`` to its own row of ``c``, or to the only one."""
    apart = x.astype(np.int64) - c
    return (apart * apart).sum(1)


def drifts(history: np.ndarray) -> np.ndarray:
    """[t, j]: the norm of centroid j's displacement from round t to the last one, rounded up."""
    apart = (history[-1] - history).astype(float)
    return np.sqrt((apart ** 2).sum(2)) * (1 + SLACK)


def assign(x: np.ndarray, state: dict[str, np.ndarray], history: np.ndarray) -> tuple[dict[str, np.ndarray], int]:
    """The state of the rows after a round with the centroids ``history[-1]``, and how many distances were measured.

    ``state``: cluster, distance (squared, measured in ``own_round``), own_round, lower (distance to each
    centroid, measured in ``lower_round``), lower_round.
    """
    now, centroids = len(history) - 1, history[-1]
    rows, k = len(x), len(centroids)
    cluster, own = state["cluster"].copy(), state["distance"].copy()
    own_round, lower, lower_round = state["own_round"].copy(), state["lower"].copy(), state["lower_round"].copy()
    moved = drifts(history)
    each = np.arange(rows)
    bound = np.maximum(0, lower * (1 - SLACK) - moved[lower_round, np.arange(k)])
    bound[each, cluster] = np.inf
    upper = (np.sqrt(own) + moved[own_round, cluster]) * (1 + SLACK)
    least = bound.min(1, initial=np.inf)
    # failed: the bounds don't prove that the row stays, so its own distance is measured
    failed = np.flatnonzero(~(upper < least) & (own_round < now))
    measured = len(failed)
    own[failed] = squared_each(x[failed], centroids[cluster[failed]])
    own_round[failed] = now
    lower[failed, cluster[failed]] = np.sqrt(own[failed])
    lower_round[failed, cluster[failed]] = now
    upper[failed] = np.sqrt(own[failed]) * (1 + SLACK)
    open_rows = failed[~(upper[failed] < least[failed])]
    if len(open_rows):
        near = ~(upper[open_rows, None] < bound[open_rows])
        near[np.arange(len(open_rows)), cluster[open_rows]] = True
        best, best_of = np.full(len(open_rows), np.iinfo(np.int64).max), np.zeros(len(open_rows), np.int64)
        for j in range(k):  # smaller numbers first, so that an equal distance doesn't replace one
            at = np.flatnonzero(near[:, j])
            if not len(at):
                continue
            row = open_rows[at]
            d = squared_each(x[row], centroids[j])
            measured += len(row)
            lower[row, j], lower_round[row, j] = np.sqrt(d), now
            closer = d < best[at]
            best[at[closer]], best_of[at[closer]] = d[closer], j
        cluster[open_rows], own[open_rows] = best_of, best
    return {"cluster": cluster, "distance": own, "own_round": own_round, "lower": lower, "lower_round": lower_round}, measured


def first_assign(x: np.ndarray, centroids: np.ndarray) -> dict[str, np.ndarray]:
    """The state after measuring every distance to the first centroids."""
    d = squared(x, centroids) if len(x) else np.zeros((0, len(centroids)), np.int64)
    cluster = d.argmin(1)
    return {"cluster": cluster, "distance": d[np.arange(len(x)), cluster], "own_round": np.zeros(len(x), np.int64),
            "lower": np.sqrt(d.astype(float)), "lower_round": np.zeros(d.shape, np.int64)}


STATE = "id long, x binary, cluster int, distance long, own_round byte, lower binary, lower_round binary, measured long"


def _assigned(rows: DataFrame, history: np.ndarray, first: bool) -> DataFrame:
    """The table of rows with the state after a round; ``rows`` has x as an array in the first round."""
    k, d = history.shape[1:]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if first:
                x, measured = matrix(batch, 1), n * k
                state = first_assign(x, history[-1])
            else:
                read = lambda c, t: np.frombuffer(b"".join(batch.column(c).to_pylist()), t).reshape(n, -1)
                x = read(1, "<i4")
                state, measured = assign(x, {
                    "cluster": batch.column(2).to_numpy().astype(np.int64), "distance": batch.column(3).to_numpy().copy(),
                    "own_round": batch.column(4).to_numpy().astype(np.int64), "lower": read(5, "<f8"), "lower_round": read(6, "u1").astype(np.int64),
                }, history)
            cut = lambda m, t: pa.array([r.tobytes() for r in np.ascontiguousarray(m, t)], pa.binary())
            yield pa.record_batch([
                batch.column(0), cut(x, "<i4") if first else batch.column(1), pa.array(state["cluster"], pa.int32()), pa.array(state["distance"], pa.int64()),
                pa.array(state["own_round"], pa.int8()), cut(state["lower"], "<f8"), cut(state["lower_round"], "u1"),
                pa.array(np.r_[measured, np.zeros(n - 1, np.int64)])],
                ["id", "x", "cluster", "distance", "own_round", "lower", "lower_round", "measured"])

    return rows.mapInArrow(step, STATE)


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid at floor(sum / count) of its rows; one without rows stays. Sums are exact.

    A task adds up its rows; (centroid, dimension) sums of the tasks meet in a shuffle.
    """
    k, d = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, cluster = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(-1, d), batch.column(0).to_numpy()
                for j in np.unique(cluster):
                    own = x[cluster == j]
                    total[j] += np.r_[own.sum(0, dtype=np.int64), len(own)]
        at = np.flatnonzero(total[:, d])
        yield pa.record_batch([pa.array(at, pa.int32()), *(pa.array(c) for c in total[at].T)], ["cluster", *(f"s{i}" for i in range(d + 1))])

    parts = rows.select("cluster", "x").mapInArrow(sums, "cluster int, " + ", ".join(f"s{i} long" for i in range(d + 1)))
    whole = [F.sum(F.col(f"s{i}").cast("decimal(28,0)")).alias(f"s{i}") for i in range(d + 1)]
    moved = centroids.copy()
    for r in parts.groupBy("cluster").agg(*whole).collect():  # one row per centroid
        count = int(r[f"s{d}"])
        moved[r["cluster"]] = [int(r[f"s{i}"]) // count for i in range(d)]
    return moved


SQL = """
WITH k AS (SELECT vec_id, [floor(64 * c::DOUBLE)::BIGINT for c in embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len([c for c in embedding if c IS NOT NULL AND isfinite(c)]) = 64),
v AS (SELECT row_number() OVER () AS r, vec_id, x FROM k),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, 'null')), x) - 1 AS j, x AS c FROM v QUALIFY j < 16),
""" + "".join(f"""
a{t} AS (SELECT r, vec_id, x, j, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x, c)])::BIGINT AS d
  FROM v CROSS JOIN c{t} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1),
s{t} AS (SELECT j, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{t}, (SELECT unnest(range(1, 65)) AS i) GROUP BY j, i),
c{t + 1} AS (SELECT c{t}.j, coalesce(m, c) AS c FROM c{t} LEFT JOIN (
  SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM s{t} GROUP BY j) AS f ON f.j = c{t}.j),
""" for t in range(ROUNDS)) + f"""
a AS (SELECT r, vec_id, x, j, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(x, c)])::BIGINT AS d
  FROM v CROSS JOIN c{ROUNDS} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)
SELECT vec_id, j::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a
"""


def cluster_vectors(embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, id_column: str = "vec_id", column: str = "embedding",
                    dimensions: int = DIMENSIONS, seed: int = SEED, stop_early: bool = True) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, measured of every usable row.

    Starts from ``smallest_by_hash``; with fewer rows than ``centroids`` there are as many centroids as rows.
    Each round assigns all rows and moves the centroids, and at the end all rows are assigned once more.
    Rounds after one that moved nothing are skipped, as they change nothing. Repeated rows and repeated ids
    count each; a null id is returned as such; no usable rows give none. ``measured`` says, in one row of
    each batch, how many distances the last assignment had to measure there.
    """
    vectors = stored(whole_vectors(embeddings, id_column, column, dimensions), "cluster-vectors")
    spark = embeddings.sparkSession
    start = smallest_by_hash(vectors, centroids, seed)
    schema = f"{id_column} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, measured long"
    if not start:
        return spark.createDataFrame([], schema)
    history = np.array([start], np.int64)
    rows = stored(_assigned(vectors, history, first=True), "clustered")
    for _ in range(rounds):
        moved = _moved(rows, history[-1])
        if stop_early and (moved == history[-1]).all():
            break
        history = np.concatenate([history, moved[None]])
        rows = stored(_assigned(rows, history, first=False), "clustered")
    # rows that a bound kept have the distance of an earlier round: measure it
    last = history[-1]
    now = len(history) - 1

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4").reshape(batch.num_rows, last.shape[1])
            cluster, d = batch.column(2).to_numpy(), batch.column(3).to_numpy().copy()
            old = np.flatnonzero(batch.column(4).to_numpy() < now)
            d[old] = squared_each(x[old], last[cluster[old]])
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(d), batch.column(5)], [id_column, "cluster", "distance", "measured"])

    final = rows.select("id", "x", "cluster", "distance", "own_round", "measured").mapInArrow(
        distances, f"{id_column} long, cluster int, distance long, measured long")
    final = stored(final, "cluster-distances")
    inertia = {r["cluster"]: int(r["s"]) for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # one row per centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last.tolist()]
    found = [(j, inertia.get(j, 0), sum(inertia.values()), digests[j]) for j in range(len(last))]
    of_cluster = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(of_cluster), "cluster").select(
        id_column, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "measured")
