"""Embedding whitening by shifted CholeskyQR over distributed rows.

The fit list (each distinct vector once) is a stored table. One pass gives its count and exact sums. Then
a Gram pass multiplies the centred rows, after the triangular solves of the earlier passes, into a matrix
of D x D; its Cholesky factor (of the matrix plus a small multiple of the identity where it isn't safely
positive definite, which is the shift) makes the rows nearly orthonormal in the next pass. The factors of
all passes multiplied are the R of the centred rows' QR decomposition, and the singular value decomposition
of R gives the components: singular value^2 / n is the eigenvalue, the right singular vector the component.
Only matrices of D x D reach the driver; rows never do.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchmill.llm.common import stored

#: x = floor(SCALE * entry) + OFFSET
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Largest entry times SCALE: sums and differences of larger ones would not be exact in 64 bits.
LARGEST = 1 << 44
#: Gram passes at most; the third one of well-conditioned rows finds nothing left to do.
PASSES, ORTHONORMAL = 6, 1e-11
#: Eigenvalues below this share of the greatest are what roundings leave of a direction without variance.
NO_VARIANCE = 1e-22


def whole_vectors(embeddings: DataFrame, id_column: str = "vec_id", column: str = "embedding", dimensions: int | None = None) -> DataFrame:
    """id, x: rows with a vector of finite entries, as whole numbers.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are those whose
    length isn't ``dimensions`` (by default the most frequent length above 0, of equally frequent ones
    the greater). An entry beyond 2^44 / 64 either way is an error.
    """
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    kept = embeddings.where(F.coalesce(F.size(column) > 0, F.lit(False))).where(F.forall(column, lambda c: F.coalesce(finite(c), F.lit(False))))
    if dimensions is None:
        top = kept.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
        dimensions = top["d"] if top else 0
    return kept.where(F.size(column) == dimensions).select(
        F.col(id_column).alias("id"), F.transform(column, lambda c: whole_number(c) + OFFSET).alias("x"))


def whole_number(c: Column, largest: int = LARGEST) -> Column:
    scaled = F.lit(float(SCALE)) * c.cast("double")
    return F.when(F.abs(scaled) <= largest, F.floor(scaled)).otherwise(F.raise_error(F.lit(f"an entry is beyond {largest // SCALE}")).cast("long"))


def matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    """The rows of a list column of equal lengths."""
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def total_rows(rows: DataFrame, of_batch: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all batches of ``of_batch(x)``, a matrix with ``width`` columns.

    Each task adds up its own batches; the tasks' matrices are added row by row in a shuffle.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of_batch(matrix(batch, 0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(len(total), dtype="i4")), *(pa.array(c) for c in total.T.astype(float))],
                                  ["i", *(f"v{k}" for k in range(width))])

    parts = rows.select("x").mapInArrow(add, "i int, " + ", ".join(f"v{k} double" for k in range(width)))
    # the sum of a column doesn't depend much on the tasks' order; row i of every task meets in one group
    found = parts.groupBy("i").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(width)]).orderBy("i").collect()  # one row per matrix row
    return np.array([list(r)[1:] for r in found], float)


class Centre:
    """n and the sums S of the fit list, and x - S / n without the rounding of large numbers."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n * x - S)^2 of each row, exact."""
        n, apart = self.n, x - self.whole
        if int(np.abs(apart).max(initial=0)) >> 24 or x.shape[1] > 1 << 10:
            return [sum((n * a - r) ** 2 for a, r in zip(row, self.rest)) for row in apart.tolist()]
        # n^2 a^2 - 2 n a r + r^2, summed: each sum in 64 bits, r taken in parts of 16 bits
        squares, crossed = (apart ** 2).sum(1).tolist(), [0] * len(apart)
        for low in range(0, max(n, 2).bit_length(), 16):
            part = apart @ np.array([r >> low & 0xFFFF for r in self.rest], np.int64)
            crossed = [c + (p << low) for c, p in zip(crossed, part.tolist())]
        alone = sum(r * r for r in self.rest)
        return [n * n * s - 2 * n * c + alone for s, c in zip(squares, crossed)]


class Whitening:
    """What a fit keeps: centre, eigenvalues and components (a row each), trace, identity error."""

    def __init__(self, centre: Centre, values: np.ndarray, vectors: np.ndarray, trace: float):
        self.centre, self.values, self.vectors, self.trace = centre, values, vectors, trace
        self.identity_error, self.passes = 0.0, 0

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def factor(gram: np.ndarray, n: int) -> np.ndarray:
    """An upper triangular R with R^T R = gram, or gram plus the shift where Cholesky breaks down."""
    d = len(gram)
    scale = np.abs(np.diag(gram)).max()
    # what makes the factor of rows with rounding errors exist: some 11 (n d + d (d + 1)) roundings
    shift = min(1e-2, 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2) * scale
    least = 1e-10 * scale
    while True:
        try:
            lower = np.linalg.cholesky(gram)
            if (np.diag(lower) ** 2).min() > least:
                return lower.T
        except np.linalg.LinAlgError:
            pass
        gram, least, shift = gram + max(shift, 1e-13 * scale) * np.eye(d), 0.0, 10 * shift


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct ``x`` of ``vectors``; None where there are none.

    Components are numbered by falling eigenvalue. Directions without variance can't be whitened and
    are left out, so there may be fewer than ``components``.
    """
    rows = stored(vectors.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    first = rows.first()
    if first is None:
        return None
    d = len(first["x"])
    places = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    found = places.orderBy("i").collect()  # one row per dimension
    centre = Centre(found[0]["n"], [int(r["s"]) for r in found])
    factors: list[np.ndarray] = []
    trace, passes = 0.0, 0
    while passes < PASSES:
        known = list(factors)

        def gram_of(x: np.ndarray) -> np.ndarray:
            q = centre.rows(x)
            for r in known:  # one solve after the other: their product's inverse would lose what the shift cost
                q = np.linalg.solve(r.T, q.T).T
            return q.T @ q

        gram = total_rows(rows, gram_of, d)
        if passes == 0:
            trace = float(np.trace(gram)) / centre.n
            if trace == 0:  # one vector, or none apart from others
                return _fitted(rows, Whitening(centre, np.zeros(0), np.zeros((0, d)), 0.0), 0, passes)
        passes += 1
        if np.abs(gram - np.eye(d)).max() <= ORTHONORMAL:
            break
        factors.append(factor(gram, centre.n))
    r_all = functools.reduce(lambda product, r: r @ product, factors, np.eye(d))
    _, singular, vectors_t = np.linalg.svd(r_all)
    values = singular ** 2 / centre.n
    kept = min(components, int((values > NO_VARIANCE * values[0]).sum()))
    return _fitted(rows, Whitening(centre, values[:kept], vectors_t[:kept], trace), kept, passes)


def _fitted(rows: DataFrame, fitted: Whitening, kept: int, passes: int) -> Whitening:
    """With the identity error, from a pass over the whitened fit list."""
    fitted.passes = passes
    if kept:
        def covariance(x: np.ndarray) -> np.ndarray:
            y = fitted.project(x)
            return np.vstack([y.T @ y, y.sum(0)])

        total = total_rows(rows, covariance, kept) / fitted.centre.n
        fitted.identity_error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(kept)).max())
    return fitted


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding",
             dimensions: int | None = None) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row.

    ``n`` is the size of the fit list; ``deviation`` (decimal, as its square of n outgrows 64 bits on large
    tables) the exact sum over dimensions of (n x - S)^2; ``explained`` the eigenvalue's share of the trace.
    Repeated rows count once in the fit and are returned each. A null id is returned as such. Tables
    without usable rows, and fit lists without variance, give no rows.
    """
    vectors = stored(whole_vectors(embeddings, id_column, column, dimensions), "whole-vectors")
    schema = f"{id_column} long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fitted = fit(vectors, components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if fitted is None or not batch.num_rows or not len(fitted.values):
                continue
            x, kept = matrix(batch, 1), len(fitted.values)
            y, rows = fitted.project(x), batch.num_rows * len(fitted.values)
            yield pa.record_batch([
                batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), kept))),
                pa.array(np.tile(np.arange(1, kept + 1, dtype="i4"), batch.num_rows)),
                pa.array(np.full(rows, fitted.centre.n)),
                pa.array([v for v in fitted.centre.deviation(x) for _ in range(kept)], pa.decimal128(38, 0)),
                pa.array(y.ravel()), pa.array(np.tile(fitted.values / fitted.trace, batch.num_rows)),
                pa.array(np.full(rows, fitted.identity_error))],
                [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col("id").cast("long"), "x").mapInArrow(project, schema)
