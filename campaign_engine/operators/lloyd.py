"""KMeans with all starts and all numbers of clusters in the same passes.

Every start carries its centres to the tasks; a pass reads the vectors once and returns counts and sums of all clusters
of all starts, which are as many as starts x clusters x columns, whatever the number of rows. Starts that have come to
rest drop out. The best start of each number of clusters is then run on until its centres are the means of their rows.
Only the first centres come from a sample: ``SAMPLE_ROWS`` rows with the smallest hashes of the key. Keep the vectors
persisted or stored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.operators.prep import fit_sample

SAMPLE_ROWS = 5_000
REST = 1e-20  # squared move of the centres, against the mean variance, at which the best start ends


@dataclass
class Centres:
    """Centres of one clustering; ``cost`` is the sum of squared distances to the nearest one."""

    centres: np.ndarray
    cost: float
    passes: int

    def transform(self, df: DataFrame, vector: str = "features", name: str = "_cluster") -> DataFrame:
        """Add the number of the nearest centre, the smaller one of ties; null without centres or vector."""
        if not len(self.centres):
            return df.withColumn(name, F.lit(None).cast("int"))
        x = vector_to_array(vector)

        def gap(centre: np.ndarray):
            squares = F.zip_with(x, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b))
            return F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)

        gaps = F.array(*[gap(c) for c in self.centres])
        return df.withColumn(name, (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of the sample, each drawn in proportion to its squared distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [sample[rng.integers(len(sample))]]
    gaps = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < k:
        total = gaps.sum()
        pick = rng.choice(len(sample), p=gaps / total) if total > 0 else 0
        chosen.append(sample[pick])
        gaps = np.minimum(gaps, ((sample - chosen[-1]) ** 2).sum(1))
    return np.array(chosen)


def _pass(rows: DataFrame, sets: Mapping[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each set of centres and each centre: rows, cost and sums of the rows that are nearest to it."""
    width = 2 + next(iter(sets.values())).shape[1]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {s: np.zeros((len(c), width)) for s, c in sets.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for s, centres in sets.items():
                gaps = np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)
                near = gaps.argmin(1)
                for j, total in enumerate(totals[s]):
                    mine = near == j
                    total[0] += mine.sum()
                    total[1] += gaps[mine, j].sum()
                    total[2:] += x[mine].sum(0)
        found = [(s, j, i, v) for s, t in totals.items() for j, line in enumerate(t) for i, v in enumerate(line)]
        columns = zip(*found)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["start", "cluster", "place", "part"])

    parts = rows.mapInArrow(tasks, "start int, cluster int, place int, part double")
    out = {s: np.zeros((len(c), width)) for s, c in sets.items()}
    for r in parts.groupBy("start", "cluster", "place").agg(F.sum("part").alias("part")).collect():  # starts x clusters x columns
        out[r["start"]][r["cluster"], r["place"]] = r["part"]
    return out


def _settle(rows: DataFrame, sets: dict[int, np.ndarray], limit: float, max_iter: int) -> dict[int, Centres]:
    """Move all sets until each has come to rest. A centre without rows stays where it is."""
    done: dict[int, Centres] = {}
    moving = dict(sets)
    for step in range(1, max_iter + 1):
        for s, found in _pass(rows, moving).items():
            counts = found[:, :1]
            moved = np.where(counts > 0, found[:, 2:] / np.maximum(counts, 1), moving[s])
            gap = ((moved - moving[s]) ** 2).sum()
            moving[s] = moved
            done[s] = Centres(moved, float(found[:, 1].sum()), step)
            if gap <= limit:
                del moving[s]
        if not moving:
            break
    return done


def cluster_all(
    vectors: DataFrame, ks: Sequence[int], seed: int, n_init: int, key: str, max_iter: int = 300, tol: float = 1e-4
) -> dict[int, Centres]:
    """The best of ``n_init`` starts for each number of clusters; ``vectors`` has the key and ``features`` of one length.

    Fewer different vectors than clusters leave clusters without rows; an empty table has no centres.
    """
    drawn = fit_sample(vectors.select(key, "features"), key, SAMPLE_ROWS).collect()  # bounded by SAMPLE_ROWS
    if not drawn:
        return {k: Centres(np.zeros((0, 0)), 0.0, 0) for k in ks}
    sample = np.array([r["features"].toArray() for r in drawn])
    rows = vectors.select(vector_to_array("features").alias("x"))
    spread = float(sample.var(0).mean())
    plan = [(k, i) for k in ks for i in range(n_init)]
    raced = _settle(rows, {s: first_centres(sample, k, seed + i) for s, (k, i) in enumerate(plan)}, tol * spread, max_iter)
    best = {k: min((s for s, (other, _) in enumerate(plan) if other == k), key=lambda s: raced[s].cost) for k in ks}
    final = _settle(rows, {k: raced[s].centres for k, s in best.items()}, REST * spread, max_iter)
    return {k: Centres(c.centres, c.cost, c.passes + raced[best[k]].passes) for k, c in final.items()}
