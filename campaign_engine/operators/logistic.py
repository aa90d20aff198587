"""Logistic regression by Newton's method: each step is one pass over all rows.

A task sums the loss, its gradient and its second derivatives over its rows; the sums of a step are as many as a square
of the columns, whatever the number of rows. Five to ten steps are enough, so no sample is drawn. Keep the table stored
or persisted: it is read once a step, and only the named columns are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-9  # largest entry of the mean gradient at which the steps end


@dataclass
class Line:
    """P(1) = 1 / (1 + exp(-(intercept + weights . z))) on standardized columns."""

    columns: list[str]
    scale: dict[str, tuple[float, float]]
    intercept: float
    weights: list[float]
    loss: float
    steps: int

    def stages(self) -> list[SQLTransformer]:
        """Standardizing and scoring as SQL, so that a pipeline of them can be saved and used on streams."""
        scaled = []
        for c in self.columns:
            mean, deviation = self.scale[c]
            scaled.append(f"(`{c}` - {mean!r}D) / {deviation!r}D AS `{c}_z`" if deviation > 0 else f"0.0D AS `{c}_z`")
        terms = [f"{w!r}D * `{c}_z`" for c, w in zip(self.columns, self.weights)]
        margin = " + ".join([f"{self.intercept!r}D", *terms])
        return [
            SQLTransformer(statement=f"SELECT {', '.join(['*', *scaled])} FROM __THIS__"),
            SQLTransformer(statement=f"SELECT *, 1.0D / (1.0D + exp(-({margin}))) AS _p FROM __THIS__"),
            SQLTransformer(
                statement="SELECT *, array(1.0D - _p, _p) AS probability, CAST(_p > 0.5D AS DOUBLE) AS prediction FROM __THIS__"
            ),
        ]


def _matrix(batch: pa.RecordBatch, cols: Sequence[str], scale: Mapping[str, tuple[float, float]]) -> np.ndarray:
    """A column of ones, then the standardized columns; null is NaN."""
    out = np.ones((batch.num_rows, len(cols) + 1))
    for j, c in enumerate(cols):
        mean, deviation = scale[c]
        values = batch.column(j).to_numpy(zero_copy_only=False).astype(float)
        out[:, j + 1] = (values - mean) / deviation if deviation > 0 else values * 0.0
    return out


def _sums(df: DataFrame, cols: Sequence[str], label: str, scale: Mapping, point: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
    """(rows, loss, gradient, second derivatives) at a point, without the penalty."""
    size = len(cols) + 1
    upper = np.triu_indices(size)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + size + len(upper[0]))
        for batch in batches:
            x = _matrix(batch, cols, scale)
            y = batch.column(len(cols)).to_numpy(zero_copy_only=False).astype(float)
            margin = x @ point
            p = 0.5 * (1.0 + np.tanh(margin / 2))
            total[0] += len(y)
            total[1] += (np.logaddexp(0.0, margin) - y * margin).sum()
            total[2 : 2 + size] += x.T @ (p - y)
            total[2 + size :] += (x.T @ (x * (p * (1 - p))[:, None]))[upper]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "part"])

    names = [F.col(f"`{c}`").cast("double") for c in cols]
    slim = df.select(*[c.alias(f"_{i}") for i, c in enumerate(names)], F.col(label).cast("double").alias("_y"))
    parts = slim.mapInArrow(tasks, "place int, part double").groupBy("place").agg(F.sum("part").alias("part"))
    total = np.zeros(2 + size + len(upper[0]))
    for row in parts.collect():  # one row per sum
        total[row["place"]] = row["part"]
    second = np.zeros((size, size))
    second[upper] = total[2 + size :]
    return int(total[0]), float(total[1]), total[2 : 2 + size], second + np.triu(second, 1).T


def fit(
    df: DataFrame, cols: Sequence[str], scale: Mapping[str, tuple[float, float]], label: str = "label", c: float = 1.0,
    max_iter: int = 1000,
) -> Line:
    """Minimum of the summed loss + |weights|^2 / (2 c); the intercept is free.

    ``scale`` has the mean and deviation of each column. A step that raises the loss is halved. An unknown or infinite
    feature or label is an error; an empty table gives zeros.
    """
    cols = list(cols)
    ridge = np.array([0.0, *[1.0 / c] * len(cols)])
    point, step, best = np.zeros(len(cols) + 1), None, None
    taken = 0
    while True:
        rows, loss, gradient, second = _sums(df, cols, label, scale, point)
        loss += 0.5 * float(ridge @ point**2)
        taken += 1
        if not np.isfinite(loss) or not np.isfinite(gradient).all():
            raise ValueError("logistic regression needs known, finite features and labels in all rows")
        if best is not None and step is not None and loss > best[0] + 1e-12 * abs(best[0]) and np.abs(step).max() > 1e-12:
            step = step / 2
            point = best[1] + step
        else:
            best = loss, point
            slope = gradient + ridge * point
            if rows == 0 or np.abs(slope).max() <= TOLERANCE * rows:
                break
            step = -np.linalg.lstsq(second + np.diag(ridge), slope, rcond=None)[0]
            point = point + step
        if taken >= max_iter:
            break
    loss, point = best
    return Line(cols, {x: (float(scale[x][0]), float(scale[x][1])) for x in cols}, float(point[0]), [float(w) for w in point[1:]], loss, taken)


def gradient(df: DataFrame, line: Line, label: str = "label", c: float = 1.0) -> DataFrame:
    """(term, gradient): the mean gradient of the penalized loss at a fitted line, 0 at its minimum."""
    scored = df
    for stage in line.stages():
        scored = stage.transform(scored)
    error = F.col("_p") - F.col(label)
    found = scored.agg(F.count("*").alias("n"), F.avg(error).alias("g"), *[F.avg(error * F.col(f"`{x}_z`")).alias(f"g{i}") for i, x in enumerate(line.columns)])
    terms = [F.struct(F.lit("intercept").alias("term"), F.col("g").alias("gradient"))]
    for i, (x, w) in enumerate(zip(line.columns, line.weights)):
        terms.append(F.struct(F.lit(x).alias("term"), (F.col(f"g{i}") + F.lit(w / c) / F.col("n")).alias("gradient")))
    return found.select(F.inline(F.array(*terms)))
