"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then Jacobi rotations of the factor."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm.common import table
from queuelog.llm.topk import finite

#: Whole numbers below this are exact as doubles.
EXACT = 2.0**53
#: Rows that meet in one product.
STEP = 2048


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, l)`` with ``a[order][:, order] = l @ l.T``; ``l`` is lower trapezoidal with as many
    columns as ``a`` has rank, the largest remaining diagonal entry first each time."""
    a, n = np.array(a, float), len(a)
    order, l = np.arange(n), np.zeros((n, n))
    least = n * np.finfo(float).eps * max(np.diag(a).max(initial=0.0), 0.0)
    for k in range(n):
        left = np.diag(a)[k:] - (l[k:, :k] ** 2).sum(1)
        p = k + int(np.argmax(left))
        if left[p - k] <= least:
            return order, l[:, :k]
        order[[k, p]] = order[[p, k]]
        a[[k, p]] = a[[p, k]]
        a[:, [k, p]] = a[:, [p, k]]
        l[[k, p], :k] = l[[p, k], :k]
        l[k, k] = np.sqrt(left[p - k])
        l[k + 1 :, k] = (a[k + 1 :, k] - l[k + 1 :, :k] @ l[k, :k]) / l[k, k]
    return order, l


def _pairings(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of a tournament: every pair of columns once, none twice in a round."""
    seats, rounds = list(range(n + n % 2)), []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(min(p), max(p)) for p in zip(seats[:half], seats[: half - 1 : -1]) if max(p) < n]
        rounds.append(tuple(np.array(x, int) for x in zip(*pairs)) if pairs else (np.empty(0, int),) * 2)
        seats = [seats[0], seats[-1], *seats[1:-1]]
    return rounds


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """``(e, u)`` of ``l @ l.T`` by falling ``e``: columns of ``l`` are rotated against each other until
    all are orthogonal; their squared norms are the eigenvalues, the normalised columns the vectors."""
    l = np.array(l, float)
    rounds = _pairings(l.shape[1])
    for _ in range(sweeps):
        turned = False
        for i, j in rounds:
            x, y = l[:, i], l[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > 1e-15 * np.sqrt(xx * yy)
            if not turn.any():
                continue
            turned = True
            i, j, x, y = i[turn], j[turn], x[:, turn], y[:, turn]
            zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            l[:, i], l[:, j] = c * (x - t * y), c * (y + t * x)
        if not turned:
            break
    e = (l * l).sum(0)
    order = np.argsort(-e, kind="stable")
    return e[order], l[:, order] / np.sqrt(e[order])


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a covariance by falling size and unit eigenvectors as columns; of each vector the
    largest entry is positive. Directions without variance are left out."""
    order, l = pivoted_cholesky(v)
    e, u = one_sided_jacobi(l)
    back = np.empty_like(u)
    back[order] = u
    if u.size:
        back *= np.sign(back[np.abs(back).argmax(0), np.arange(back.shape[1])])
    return e, back


@dataclass
class Whitening:
    """A fitted model: ``n`` vectors with whole-number sums ``sums``; all else follows from V."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: int
    offset: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n for whole numbers x: the whole part is taken off first, exactly."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        return (x - np.array(whole, float)) - np.array(rest, float) / self.n

    def whiten(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, :k] / np.sqrt(self.values[:k])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n*x - S)^2, exact; null beyond what a long holds."""
        far = max(np.abs(x).max(initial=0) * self.n, *map(abs, self.sums))
        if 2 * far < 2**62 and len(self.sums) * (2.0 * far) ** 2 < 2**62:
            return ((self.n * x.astype(np.int64) - np.array(self.sums, np.int64)) ** 2).sum(1).tolist()
        spread = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]
        return [d if d < 2**63 else None for d in spread]


def _matrix(lists: pa.Array, scale: int, offset: int, dim: int | None = None) -> np.ndarray:
    """floor(scale * c) + offset for each entry, as doubles; shorter vectors end in zeros."""
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    wide = int(sizes.max(initial=0)) if dim is None else dim
    x = np.zeros((len(lists), wide))
    x[np.arange(wide) < sizes[:, None]] = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    return np.floor(scale * x) + offset


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            yield batch.slice(at, STEP)


def _usable(rows: DataFrame, vec_id: str, vector: str, scale: int, offset: int) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    small = F.forall(v, lambda c: F.abs(c) <= (EXACT / 2 - abs(offset)) / abs(scale))
    return rows.select(F.col(vec_id).alias("vec_id"), v.alias("v")).where(finite(F.col("v")) & small)


def _summed(rows: DataFrame, make, first: str) -> dict[int, list[int]]:
    """What ``make`` says of each partition, as rows of whole numbers by position, added up.
    Comes back with one entry per row of the model, whatever the number of vectors."""
    parts = rows.mapInArrow(make, f"{first} int, at int, part decimal(38,0)")
    sums = parts.groupBy(first, "at").agg(F.sum("part").alias("part"))
    out: dict[int, list[int]] = {}
    for r in sorted(sums.collect()):
        out.setdefault(r[0], []).append(int(r[2]))
    return out


def _entries(values: np.ndarray, first: str) -> pa.RecordBatch:
    """A matrix of whole numbers as rows of (row, column, number)."""
    i, j = np.indices(values.shape)
    numbers = [int(x) for x in values.ravel()]
    return pa.RecordBatch.from_arrays(
        [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(numbers, pa.decimal128(38, 0))], [first, "at", "part"]
    )


def fit(
    rows: DataFrame, *, scale: int = 1024, offset: int = 100_000, vec_id: str = "vec_id", vector: str = "embedding"
) -> Whitening | None:
    """The model of all usable vectors of ``rows``; None without any, or when none has an entry.

    Two passes: sums of the whole numbers x, then the scatter of x centred before multiplying. x is
    centred by the whole part of its mean, so products are whole numbers and their sums exact; the part
    of the mean left, below one, comes off as n times its square. Tasks send one matrix each, and the
    driver holds two matrices of the vector's length squared.
    """
    rows = _usable(rows, vec_id, vector, scale, offset)
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not size["n"] or not size["dim"]:
        return None
    n, dim = size["n"], size["dim"]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(dim, object)
        for batch in _steps(batches):
            x = _matrix(batch.column(0), scale, offset, dim)
            exact = np.abs(x).max(initial=0) * len(x) < EXACT
            held = held + np.array([int(s) for s in x.sum(0)] if exact else [sum(map(int, c)) for c in x.T], object)
        yield _entries(held[None, :], "part_of")

    sums = _summed(rows.select("v"), total, "part_of")[0]
    whole = np.array([s // n for s in sums], float)

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, small = np.zeros((dim, dim), object), np.zeros((dim, dim))
        room = EXACT
        for batch in _steps(batches):
            y = _matrix(batch.column(0), scale, offset, dim) - whole
            most = float(np.abs(y).max(initial=0)) ** 2 * len(y)
            if most >= EXACT:  # beyond doubles
                y = y.astype(np.int64).astype(object)
                held = held + y.T @ y
                continue
            if most > room:
                held, small, room = held + small.astype(np.int64).astype(object), np.zeros((dim, dim)), EXACT
            small += y.T @ y
            room -= most
        yield _entries(held + small.astype(np.int64).astype(object), "row")

    products = _summed(rows.select("v"), scatter, "row")
    rest = [s % n for s in sums]
    # n * sum(y y') - r r' is n^2 V, in whole numbers
    v = np.array([[(n * products[i][j] - rest[i] * rest[j]) / (n * n) for j in range(dim)] for i in range(dim)], float)
    values, vectors = eigen(v)
    return Whitening(n, sums, values, vectors, float(np.trace(v)), scale, offset)


def whitened(
    rows: DataFrame, *, components: int = 8, scale: int = 1024, offset: int = 100_000, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row of
    ``rows`` and each of the first ``components`` components.

    An entry c becomes x = floor(scale * c) + offset. Rows whose vector is null, or holds null or
    non-finite entries or some so large that x is beyond 2^52, take no part; shorter vectors count as
    ending in zeros, rows without vec_id stay, repeated rows are rows. Components without
    variance are left out, so fewer than ``components`` may come, or none: then there are no rows, as for
    an empty table. ``deviation`` is null where it passes a long. Other columns are ignored.
    """
    out = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit(rows, scale=scale, offset=offset, vec_id=vec_id, vector=vector)
    k = min(components, len(model.values)) if model else 0
    if not k:
        return rows.sparkSession.createDataFrame([], out)
    usable, dim = _usable(rows, vec_id, vector, scale, offset), len(model.sums)

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((k + 1, k))
        for batch in _steps(batches):
            w = model.whiten(_matrix(batch.column(0), scale, offset, dim), k)
            products[:k] += w.T @ w
            products[k] += w.sum(0)
        i, j = np.indices(products.shape, np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(products.ravel())], ["row", "at", "part"])

    found = usable.select("v").mapInArrow(covariance, "row int, at int, part double").groupBy("row", "at").agg(F.sum("part").alias("part"))
    table_ = np.zeros((k + 1, k))
    for r in found.collect():
        table_[r["row"], r["at"]] = r["part"] / model.n
    error = float(np.abs(table_[:k] - np.outer(table_[k], table_[k]) - np.eye(k)).max())
    explained = model.values[:k] / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            x = _matrix(batch.column(1), scale, offset, dim)
            rows_ = len(x)
            each = np.repeat(np.arange(rows_), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * k, model.n)), pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.whiten(x, k).ravel()), pa.array(np.tile(explained, rows_)), pa.array(np.full(rows_ * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), "v").mapInArrow(project, out)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
