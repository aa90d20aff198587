"""Embedding whitening by refined eigenvectors of the covariance.

Entries c become integers x = floor(1024 c) + 100000. Sums, and so means, are exact. The covariance is summed over the
rows in integers centred at the rounded mean (exact while a sum stays below 2^53) and brought to the mean itself
afterwards, so it doesn't depend on how rows are dealt.

Eigenvectors start in float32 and are corrected in higher precision by Ogita and Aishima's iteration, which needs only
products of matrices: R = I - X'X tells how far they are from being orthonormal, S = X'VX how far from diagonal. The
correction of a pair divides by the difference of its eigenvalues. Pairs too close for that (a cluster) get only the
orthogonal part of it; each cluster is then solved on its own, as the small problem of its columns in higher precision
shifted to its middle, and its columns are turned. The last corrections are computed in extended precision.

Left out: vectors that are null or hold null or non-finite entries (or entries beyond 2^42, whose x no double holds
exactly), empty ones, and those that haven't the most frequent number of entries (of equally frequent ones, the
largest). Rows without an id, and rows that repeat one, are rows like others. Directions without variance, if the first
components reach them, give 0 as ``whitened``. A deviation too large for a long is null. ``explained`` of a table
without variance is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.llm.shared import ship, stored

SCALE, SHIFT = 1024, 100_000  # fixed values
LARGEST = float(1 << 42)
MOST_ENTRIES = 4096  # a covariance of so many entries a side is 128 MB
FAN = 64  # partial sums that are added in one task
BATCH = 4096


def close_pairs(values: np.ndarray, gap: float) -> np.ndarray:
    """Numbers of the clusters of sorted values: neighbours no further apart than ``gap`` are in one."""
    return np.cumsum(np.append(0, np.abs(np.diff(values)) > gap))


def _correct(v: np.ndarray, x: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(corrected columns, eigenvalues, clusters, size of the correction): one iteration, computed as ``kind``."""
    v, x = v.astype(kind), x.astype(kind)
    r = np.eye(x.shape[1], dtype=kind) - x.T @ x
    s = x.T @ (v @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2  # rounding apart, they are symmetric; columns stay orthonormal only if they are
    values = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(-values, kind="stable")
    x, r, s, values = x[:, order], r[np.ix_(order, order)], s[np.ix_(order, order)], values[order]
    off = s - np.diag(np.diag(s)) + values[None, :] * (r - np.diag(np.diag(r)))
    gap = 2 * (np.linalg.norm(off.astype(float)) + float(np.abs(values).max(initial=0)) * np.linalg.norm(r.astype(float)))
    cluster = close_pairs(values.astype(float), gap)
    apart = cluster[:, None] != cluster[None, :]
    difference = np.where(apart, values[None, :] - values[:, None], 1)
    e = np.where(apart, (s + values[None, :] * r) / difference, r / 2)
    return x + x @ e, values, cluster, float(np.abs(e).max(initial=0))


def _turned(v: np.ndarray, x: np.ndarray, values: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """The columns of each cluster, turned to the eigenvectors of their own small problem."""
    x = x.copy()
    for number in np.flatnonzero(np.bincount(cluster) > 1):
        own = np.flatnonzero(cluster == number)
        middle = values[own].mean()
        columns = x[:, own].astype(np.longdouble)
        small = columns.T @ (v.astype(np.longdouble) @ columns - middle * columns)
        inner, turn = np.linalg.eigh(((small + small.T) / 2).astype(float))
        x[:, own] = (columns @ turn[:, np.argsort(-inner)].astype(np.longdouble)).astype(x.dtype)
    return x


def eigenvectors(v: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, eigenvectors as columns) of a symmetric matrix, correct to double precision."""
    v = np.asarray(v, float)
    if not len(v):
        return np.empty(0), np.empty((0, 0))
    scale = float(np.abs(v).max()) or 1.0
    v = v / scale
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(float)
    for _ in range(2):  # the second time, the clusters' columns have been turned
        for _ in range(most):
            x, values, cluster, moved = _correct(v, x, np.float64)
            if moved < 1e-7:  # the next correction is about its square
                break
        x = _turned(v, x, values, cluster)
    for _ in range(most):
        x, values, cluster, moved = _correct(v, x, np.longdouble)
        if moved < 1e-9:
            break
        x = _turned(v, x, values, cluster)
    size = np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values.astype(float), kind="stable")
    return (values.astype(float) * scale)[order], (x / size)[:, order].astype(float)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows whose entries are all there and finite."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return rows.filter(F.col("v").isNotNull()).filter(whole & (F.size("v") > 0)).select(
        "id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT)).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _partial_sums(batches: Iterator[pa.RecordBatch], rows) -> Iterator[pa.RecordBatch]:
    """The matrices that ``rows`` gives of a task's batches, added up, one row for each row of the sum."""
    total = None
    for batch in batches:
        if batch.num_rows:
            own = rows(batch)
            total = own if total is None else total + own
    if total is not None:
        part = TaskContext.get().partitionId() % FAN
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total))), pa.array([part] * len(total), pa.int64()), pa.array([r.tobytes() for r in total], pa.binary())],
            names=["i", "part", "row"],
        )


def summed(rows: DataFrame, matrix) -> np.ndarray | None:
    """The sum over all batches of ``matrix(batch)``, a bounded matrix of doubles; None without rows.

    Tasks add up their own; the rest is added by matrix row and part, then by matrix row, never in one place.
    """
    schema = "i long, part long, row binary"

    def add(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(r) for r in table.column("row").to_pylist())
        return pa.table({"i": table.column("i")[:1], "part": table.column("part")[:1], "row": pa.array([whole.tobytes()], pa.binary())})

    parts = rows.mapInArrow(lambda batches: _partial_sums(batches, matrix), schema)
    both = parts.groupBy("i", "part").applyInArrow(add, schema).groupBy("i").applyInArrow(add, schema)
    found = {r["i"]: np.frombuffer(r["row"]) for r in both.collect()}  # as many rows as a vector has entries
    return np.array([found[i] for i in range(len(found))]) if found else None


class Whitening:
    """A fit: ``n``, exact ``sums``, ``values`` and ``vectors`` (columns) of the covariance, ``trace``, and its error."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8):
        ship(vectors.sparkSession)
        self.id_col, self.kind = id_col, vectors.schema[id_col].dataType
        read = usable(vectors, id_col, vector_col)
        sizes = read.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
        self.size = sizes["size"] if sizes else 0
        if self.size > MOST_ENTRIES:
            raise ValueError(f"vectors of more than {MOST_ENTRIES} entries")
        self.rows = stored(read.filter(F.size("x") == self.size))
        self.n, self.sums = self._sums()
        centre = np.array([round(s / self.n) for s in self.sums], np.int64) if self.n else np.empty(0, np.int64)

        def products(batch: pa.RecordBatch) -> np.ndarray:
            x = _matrix(batch.column("x"))
            parts = ((x[i : i + BATCH] - centre).astype(float) for i in range(0, len(x), BATCH))
            return sum(p.T @ p for p in parts)

        total = summed(self.rows, products)
        off = np.array([(s - int(c) * self.n) / self.n for s, c in zip(self.sums, centre)])
        self.covariance = np.zeros((0, 0)) if total is None else total / self.n - np.outer(off, off)
        self.trace = float(np.trace(self.covariance))
        self.values, self.vectors = eigenvectors(self.covariance)
        self.components = min(components, len(self.values))
        self.identity_error = self._error()

    def _sums(self) -> tuple[int, list[int]]:
        """Rows, and exact sums of each entry: sums of a task's entries are longs, those of all rows are decimals."""
        counted = self.rows.select(F.posexplode("x").alias("place", "x")).groupBy("place").agg(
            F.sum(F.col("x").cast("decimal(20,0)")).alias("sum"), F.count("*").alias("n")
        )
        found = sorted((r["place"], int(r["sum"]), r["n"]) for r in counted.collect())  # a row for each entry of a vector
        return (found[0][2] if found else 0), [s for _, s, _ in found]

    def _projection(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rounded mean, rest of the mean, and directions over the roots of their variances (0 without variance)."""
        k, n = self.components, self.n
        floor = 1e-13 * max(self.trace, 0.0)
        roots = np.sqrt(np.maximum(self.values[:k], 0))
        scaled = self.vectors[:, :k] / np.where(self.values[:k] > floor, roots, np.inf)
        whole = np.array([s // n for s in self.sums], np.int64)
        rest = np.array([(s % n) / n for s in self.sums])
        return whole, rest, scaled

    def _error(self) -> float:
        """Largest absolute entry of the whitened rows' covariance minus the identity."""
        if not self.n:
            return 0.0
        whole, rest, scaled = self._projection()

        def products(batch: pa.RecordBatch) -> np.ndarray:
            w = (_matrix(batch.column("x")) - whole - rest) @ scaled
            return np.column_stack([w.T @ w, w.sum(axis=0)])

        total = summed(self.rows, products) / self.n
        mean = total[:, -1]  # of rows that are centred: next to 0
        return float(np.abs(total[:, :-1] - np.outer(mean, mean) - np.eye(self.components)).max())

    def whitened(self) -> DataFrame:
        """(id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
        fields = [(self.id_col, self.kind), ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()),
                  ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
        schema = T.StructType([T.StructField(c, t) for c, t in fields])
        if not self.n:
            return self.rows.sparkSession.createDataFrame([], schema)
        n, k, sums, error, names = self.n, self.components, self.sums, self.identity_error, [c for c, _ in fields]
        whole, rest, scaled = self._projection()
        explained = self.values[:k] / self.trace if self.trace > 0 else np.zeros(k)
        left = np.array([s % n for s in sums], object)
        small = n < 1 << 31

        def deviations(x: np.ndarray) -> pa.Array:
            y = x - whole
            if small and float(np.abs(y).max(initial=0) + 1) ** 2 * float(n) ** 2 * x.shape[1] < 2**62:
                d = y * n - left.astype(np.int64)
                return pa.array((d * d).sum(axis=1))
            exact = [sum((int(a) * n - b) ** 2 for a, b in zip(row, left)) for row in y]
            return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, BATCH):
                    part = batch.slice(start, BATCH)
                    x = _matrix(part.column("x"))
                    take = pa.array(np.repeat(np.arange(len(x)), k))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                         pa.array(np.full(len(x) * k, n)), deviations(x).take(take),
                         pa.array((((x - whole) - rest) @ scaled).ravel()), pa.array(np.tile(explained, len(x))),
                         pa.array(np.full(len(x) * k, error))],
                        names=names,
                    )

        return self.rows.select("id", "x").mapInArrow(rows, schema)
