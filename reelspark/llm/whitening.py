"""Whitening of embeddings: eigenvectors in single precision, refined in a higher one.

The covariance is summed by Spark: each task adds up the products of its centred vectors,
and the sums of one row of the matrix meet in one task. Only the matrix, the square of
the number of dimensions, comes to the driver. Its eigenvectors are found in float32 and
corrected by matrix products alone (Ogita and Aishima): the residuals of orthogonality
and of diagonality give each iteration its correction, and the error squares each time.
Eigenvalues too close for that are a cluster: their vectors are only made orthonormal,
the matrix is solved anew inside the space they span, and iterations go on.

Entries become whole numbers, so sums, covariances (of vectors shifted by whole means)
and deviations are exact for entries of ordinary size, and alike in any order of rows.

Defined cases: vectors that are null, of another length than most (the shorter one on a
tie), empty, or that hold a null, non-finite or too large entry (beyond ``LARGEST``) take
no part. Zero vectors do, rows without an id too, repeated rows count as often as they
come. A component without variance has whitened values of null, and without any variance
explained is null as well; identity_error is over the components that have some (null
without any). A deviation beyond a long is null. There are as many components as
dimensions, if those are fewer. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspark.llm.common import sliced, written

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 40)
COMPONENTS = 8
#: Rounds after which refinement stops in any case; four suffice without clusters.
ROUNDS = 12
#: An eigenvalue below this part of the largest is no variance but rounding.
RANK = 1e-13
#: Entries of a batch of vectors that is worked on at a time.
ENTRIES = 1 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x (doubles) of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    inside = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    rows = rows.where(F.coalesce(inside, F.lit(False)) & (F.size("x") > 0))
    common = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("x") == (common["n"] if common else 0))


def _whole(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their whole numbers."""
    for part in sliced(iter([batch]), max(1, ENTRIES // dims)):
        x = part["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
        yield part, np.floor(SCALE * x).astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Moments:
    """Rows, the sum, least and largest value per dimension: exact."""

    n: int
    sums: list[int]
    least: list[int]
    most: list[int]

    @property
    def base(self) -> np.ndarray:
        """The whole part of each mean."""
        return np.array([s // self.n for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the sums hold beyond n times the base: at least 0 and below n."""
        return np.array([s % self.n for s in self.sums], dtype=np.int64)


def moments(rows: DataFrame) -> Moments | None:
    """None for no rows."""
    first = rows.select(F.size("x")).first()
    if first is None:
        return None
    dims = first[0]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, dtype=object)
        least, most = np.full(dims, 1 << 62), np.full(dims, -(1 << 62))
        for batch in batches:
            for _, x in _whole(batch, dims):
                if len(x):
                    n += len(x)
                    # values stay below 2**51, so 4096 of them fit a long
                    for at in range(0, len(x), 4096):
                        sums = sums + x[at : at + 4096].sum(axis=0).astype(object)
                    least, most = np.minimum(least, x.min(axis=0)), np.maximum(most, x.max(axis=0))
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(range(dims), pa.int32()),
                    "n": pa.array([n] * dims, pa.int64()),
                    "total": pa.array([str(s) for s in sums]),
                    "least": least,
                    "most": most,
                }
            )

    parts = rows.select("x").mapInArrow(add, "i int, n long, total string, least long, most long")
    found = (
        parts.groupBy("i")
        .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("least").alias("a"), F.max("most").alias("b"))
        .orderBy("i")
        .collect()
    )
    return Moments(found[0]["n"], [int(r["total"]) for r in found], [r["a"] for r in found], [r["b"] for r in found])


def covariance(rows: DataFrame, known: Moments) -> np.ndarray:
    """The covariance matrix (divisor n) in long double."""
    dims, base = len(known.sums), known.base

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            for _, x in _whole(batch, dims):
                d = (x - base).astype(np.float64)
                total += d.T @ d
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(dims), pa.int32()), "products": pa.array([r.tobytes() for r in total], pa.binary())}
        )

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, total = 0, np.zeros(dims)
        for batch in rows:
            i = batch["i"][0].as_py()
            for blob in batch["products"]:
                total += np.frombuffer(blob.as_buffer())
        yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "products": [total.tobytes()]})

    schema = "i int, products binary"
    found = rows.select("x").mapInArrow(multiply, schema).groupBy("i").applyInArrow(add, schema).collect()
    matrix = np.empty((dims, dims), dtype=np.longdouble)
    for row in found:
        matrix[row["i"]] = np.frombuffer(row["products"])
    past = known.rest.astype(np.longdouble) / known.n
    matrix = matrix / known.n - np.outer(past, past)
    return (matrix + matrix.T) / 2


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow each other at no more than a distance."""
    order = np.argsort(values)
    ends = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [g for g in np.split(order, ends) if len(g) > 1]


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One iteration: new vectors, eigenvalues, the distance that tells eigenvalues
    apart, and the size of the correction."""
    dims = len(a)
    r = np.eye(dims, dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    apart = 2 * (np.linalg.norm(off.astype(np.float64)) + np.abs(values).max() * np.linalg.norm(r.astype(np.float64)))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > apart
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ e, values, apart, float(np.abs(e).max())


def refined(a: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of a symmetric matrix, from
    approximate eigenvectors, in the precision of ``a``."""
    scale = np.abs(a).max()
    if not scale:
        return np.zeros(len(a), dtype=a.dtype), np.eye(len(a), dtype=a.dtype)
    a, x = a / scale, start.astype(a.dtype)
    enough = 64 * float(np.finfo(a.dtype).eps) * len(a)
    for _ in range(rounds):
        x, values, apart, size = _corrected(a, x)
        groups = _clusters(values.astype(np.float64), apart)
        for group in groups:
            # the space is right to the order of the correction: solve inside it, with
            # the middle of the cluster taken off, so that its differences keep their digits
            middle = values[group].mean()
            inner = x[:, group].T @ (a @ x[:, group] - middle * x[:, group])
            turn = np.linalg.eigh(((inner + inner.T) / 2).astype(np.float64))[1]
            x[:, group] = x[:, group] @ turn.astype(a.dtype)
        if size < enough:
            break
    # close eigenvalues divide the rounding of the last correction: orthonormal once more
    x = x + x @ (np.eye(len(a), dtype=a.dtype) - x.T @ x) / 2
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order], values[order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return values * scale, x * np.where(signs < 0, -1, 1)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors: found in float32, refined in the
    precision of the matrix."""
    scale = np.abs(matrix).max() or 1
    return refined(matrix, np.linalg.eigh((matrix / scale).astype(np.float32))[1])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = usable(vectors)
    known = moments(rows)
    if known is None:
        return vectors.sparkSession.createDataFrame([], names)
    dims, n, base, rest = len(known.sums), known.n, known.base, known.rest
    matrix = covariance(rows, known)
    values, axes = eigen(matrix)
    count = min(components, dims)
    trace = float(np.trace(matrix))
    lasting = [j for j in range(count) if trace > 0 and values[j] > RANK * values[0]]
    scaled = (axes[:, lasting] / np.sqrt(values[lasting])).astype(np.float64)
    past = rest.astype(np.float64) / n
    widest = max(max(b - q, q - a) for a, b, q in zip(known.least, known.most, base.tolist())) + 1
    fits = dims * (n * widest) ** 2 < 1 << 63

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _whole(batch, dims):
                d = x - base
                spread = (d if fits else d.astype(object)) * n - rest
                deviation = (spread * spread).sum(axis=1).tolist()
                out = np.full((len(x), count), np.nan)
                out[:, lasting] = (d - past) @ scaled
                ends = pa.array(np.arange(0, len(x) * count + 1, count), pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part["vec_id"].cast(pa.int64()),
                        "deviation": pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                        "w": pa.ListArray.from_arrays(ends, pa.array(out.reshape(-1))),
                    }
                )

    wide = written(rows.mapInArrow(project, "vec_id long, deviation long, w array<double>"), "whitened")
    pairs = list(combinations_with_replacement(lasting, 2))
    error = None
    if pairs:
        # covar_pop centres its values as it goes
        at = [F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))) for i, j in pairs]
        error = max(abs(v - (i == j)) for v, (i, j) in zip(wide.agg(*at).first(), pairs))
    share = F.array(*(F.lit(float(max(values[j], 0)) / trace if trace > 0 else None).cast("double") for j in range(count)))
    return wide.select("vec_id", "deviation", F.posexplode("w").alias("j", "v")).select(
        "vec_id",
        (F.col("j") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.nanvl("v", F.lit(None).cast("double")).alias("whitened"),
        F.get(share, F.col("j")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
