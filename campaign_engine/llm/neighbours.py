"""Nearest vectors by largest inner product: query-aware collision counting with virtual rehashing.

Vectors get one more coordinate that gives all the same length, so that the largest inner product is the smallest
distance. Each of ``projections`` random directions is a hash table of one sorted array. A query opens a window around
its own projection in every array; windows widen step by step for growing radii (virtual rehashing: no table is built
anew), and each vector counts in how many windows it lies. A vector at the radius lies in a window with a known
probability; those that reach the expected count less ``slack`` standard deviations are verified by their inner
product, in double precision on the original vectors. A query ends when its last neighbour is within the radius, or
when all vectors have been verified: nothing is capped.

Index rows are dealt to bounded blocks. A block's vectors reach one task in order, which sorts their projections once;
then the queries stream past, so only queries are copied for each block. Where blocks are few, several tasks (``TASKS``
in all) hold a block and share its queries: at most ``TASKS`` blocks of vectors are copied, whatever the input. In a
block, vectors are searched in shells of lengths within a factor of two, longest first, so one very long vector doesn't
widen the windows of all; a shell that can't reach the last neighbour found is passed over, and one of few vectors is
verified whole. Vectors that are
null, empty, zero, or hold null or non-finite components take no part; nor do rows without an id. Rows that repeat an
id are separate candidates; of a query id that repeats, the smallest vector is the query. All vectors must have the
same number of components. A score is summed over the components in their order, in double precision, so it is the
same wherever it is computed.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campaign_engine.llm.shared import ship

INDEX_BLOCK, QUERY_BLOCK = 1 << 16, 512  # rows
BLOCK_BYTES = 1 << 26  # of the vectors of an index block
TASKS = 24
SHELL = 256  # a shell of fewer vectors is no index
WINDOW = 1.25  # half of a window's width, in units of the radius
FIRST, GROWTH = 0.1, 1.08  # radii, in units of the common length


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, one component after another."""
    total = np.zeros(len(vectors))
    for column, value in zip(vectors.T, query):
        total += column * value
    return total


class Index:
    """Sorted projections of the vectors of a shell."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, length: float, projections: int, slack: float, seed: int):
        self.ids, self.vectors, self.length = ids, vectors, length
        self.plain = vectors.astype(np.float32)
        rest = np.sqrt(np.maximum(length**2 - np.square(vectors).sum(axis=1), 0))
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, projections))
        placed = (vectors @ self.directions[:-1] + rest[:, None] * self.directions[-1]).T.astype(np.float32)
        self.order = np.argsort(placed, axis=1).astype(np.int32)
        self.sorted = np.take_along_axis(placed, self.order, axis=1)
        inside = 2 * NormalDist().cdf(WINDOW) - 1
        self.least = int(projections * inside - slack * np.sqrt(projections * inside * (1 - inside)))
        steps = int(np.ceil(np.log(2 / FIRST) / np.log(GROWTH))) + 1
        self.radii = length * FIRST * GROWTH ** np.arange(steps)

    def search(self, own_ids: np.ndarray, queries: np.ndarray, k: int, known: list[tuple]) -> list[tuple]:
        """(ids, scores) of up to k nearest of each query, here and among those ``known``."""
        scaled = queries * (self.length / np.sqrt(np.square(queries).sum(axis=1)))[:, None]
        centres = (scaled @ self.directions[:-1]).T
        edges = np.empty((2, len(self.radii) + 1, len(self.order), len(queries)), np.int32)
        for j, values in enumerate(self.sorted):
            at = np.searchsorted(values, centres[j])
            edges[:, 0, j] = at
            for r, radius in enumerate(self.radii):
                edges[0, r + 1, j] = np.searchsorted(values, centres[j] - WINDOW * radius, "left")
                edges[1, r + 1, j] = np.searchsorted(values, centres[j] + WINDOW * radius, "right")
        return [self._one(own_ids[i], queries[i], edges[:, :, :, i], k, *known[i]) for i in range(len(queries))]

    def _one(self, own: int, query: np.ndarray, edges: np.ndarray, k: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.sqrt(query @ query)
        if len(scores) >= k and scores[k - 1] > size * self.length * (1 + 1e-9):
            return ids, scores
        n = len(self.ids)
        counts, verified, q = np.zeros(n, np.int32), self.ids == own, query.astype(np.float32)
        lower, upper = edges
        for r, radius in enumerate(self.radii):
            rings = [self.order[j, lower[r + 1, j] : lower[r, j]] for j in range(len(self.order))]
            rings += [self.order[j, upper[r, j] : upper[r + 1, j]] for j in range(len(self.order))]
            ring = np.concatenate(rings)
            if len(ring) > n // 4:
                counts += np.bincount(ring, minlength=n)
            else:
                np.add.at(counts, ring, 1)
            last = r == len(self.radii) - 1
            fresh = np.flatnonzero(~verified if last else (counts >= self.least) & ~verified)
            if len(fresh):
                verified[fresh] = True
                near = self.plain[fresh] @ q
                if len(scores) >= k:
                    fresh = fresh[near >= scores[k - 1] - 1e-4 * self.length * size]
                elif len(fresh) > k:
                    fresh = fresh[near >= np.partition(near, -k)[-k] - 1e-4 * self.length * size]
                ids = np.concatenate([ids, self.ids[fresh]])
                scores = np.concatenate([scores, inner(self.vectors[fresh], query)])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            # at this radius, the inner product is length * size - radius^2 * size / (2 * length)
            if len(scores) >= k and scores[k - 1] >= size * (self.length - radius**2 / (2 * self.length)):
                break
        return ids, scores


class Shells:
    """The vectors of a block by length: an index for each factor of two, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int, slack: float, seed: int):
        size = np.sqrt(np.square(vectors).sum(axis=1))
        order = np.argsort(-size, kind="stable")
        self.parts: list[Index | tuple[np.ndarray, np.ndarray]] = []
        start = 0
        while start < len(order):
            length = size[order[start]]
            stop = start + int(np.searchsorted(-size[order[start:]], -length / 2, "right"))
            own = order[start:stop]
            few = len(own) < SHELL
            self.parts.append((ids[own], vectors[own]) if few else Index(ids[own], vectors[own], float(length), projections, slack, seed))
            start = stop

    def search(self, own_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of up to k nearest of each query."""
        found: list[tuple] = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        for part in self.parts:
            if isinstance(part, Index):
                found = part.search(own_ids, queries, k, found)
                continue
            for i, (own, query) in enumerate(zip(own_ids, queries)):
                other = part[0] != own
                ids = np.concatenate([found[i][0], part[0][other]])
                scores = np.concatenate([found[i][1], inner(part[1][other], query)])
                best = np.lexsort((ids, -scores))[:k]
                found[i] = (ids[best], scores[best])
        return (np.repeat(own_ids, [len(f[0]) for f in found]), np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    projections: int = 48, slack: float = 0.9, seed: int = 17,
) -> DataFrame:
    """(query_id, rank, id_col, score) of the k nearest rows of ``vectors`` to each row of ``queries``, not its own id."""
    ship(vectors.sparkSession)

    def usable(rows: DataFrame) -> DataFrame:
        picked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return picked.filter("id is not null and v is not null").filter(whole & F.exists("v", lambda x: x != 0))

    index = usable(vectors)
    asked = usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    found = index.agg(F.count("*"), F.min(F.size("v")), F.max(F.size("v"))).first()
    if found[1] != found[2]:
        raise ValueError("vectors have different numbers of components")
    block_rows = max(1, min(INDEX_BLOCK, BLOCK_BYTES // (8 * (found[1] or 1))))
    index_blocks = max(1, -(-found[0] // block_rows))
    query_blocks = max(1, min(TASKS // index_blocks, -(-asked.count() // QUERY_BLOCK)))

    def block(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    rows = index.select(
        block(index_blocks).alias("index_block"), every(query_blocks).alias("query_block"), "id", "v", F.lit(False).alias("query"),
    ).unionByName(asked.select(
        every(index_blocks).alias("index_block"), block(query_blocks).alias("query_block"), "id", "v", F.lit(True).alias("query"),
    )).withColumn("task", F.col("index_block") * F.lit(query_blocks) + F.col("query_block"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows: of each task first the index vectors, then the queries, of which a batch is held at a time."""
        at, held, shells = None, [], None
        for batch in batches:
            task, query = batch.column("task").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            ids, matrix = batch.column("id").to_numpy(), batch.column("v").flatten().to_numpy().reshape(len(task), -1)
            step = np.flatnonzero((task[1:] != task[:-1]) | (query[1:] != query[:-1])) + 1
            for start, stop in zip([0, *step], [*step, len(task)]):
                if start == stop:
                    continue
                if task[start] != at:
                    at, held, shells = task[start], [], None
                if not query[start]:
                    held.append((ids[start:stop], matrix[start:stop]))
                    continue
                if held:
                    shells = Shells(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), projections, slack, seed)
                    held = []
                for first in range(start, stop, QUERY_BLOCK) if shells else ():
                    some = slice(first, min(stop, first + QUERY_BLOCK))
                    out = shells.search(ids[some], matrix[some], k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        names=["query_id", "id", "score"],
                    )

    dealt = rows.repartitionById(index_blocks * query_blocks, F.col("task")).sortWithinPartitions("task", "query", "id").select("task", "query", "id", "v")
    near = dealt.mapInArrow(search, "query_id long, id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
