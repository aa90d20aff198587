"""Forests that learn all rows and are kept: trees grow in tasks, lie in a folder and score tables and streams.

Trees are those of ``shared_forest``. No tree passes through the driver: executors fetch the folder's files as Spark's
shared files, and a task reads one tree after another for each block of its rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.operators.shared_forest import Binned, binned, grown_trees, numbers
from campaign_engine.operators.tree_growth import growth_of, leaves
from campaign_engine.schemas import ID_COL, SEED
from campaign_engine.session import ensure_checkpoint_dir

ROWS_AT_ONCE = 1 << 19  # rows that a task keeps until its trees meet them

_OUT = [T.StructField("probability", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())]


def _trees(files: Sequence[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """(feature, bin, left, value) of one tree at a time."""
    kinds = {"feature": np.int32, "bin": np.int16, "left": np.int32, "values": np.float32}
    for name in files:
        with pq.ParquetFile(SparkFiles.get(name)) as file:
            for batch in file.iter_batches(1, columns=list(kinds)):
                yield tuple(np.frombuffer(batch.column(c)[0].as_py(), t) for c, t in kinds.items())


class KeptForest(Transformer, MLReadable, MLWritable):
    """Adds ``probability`` (of classes 0 and 1, the mean over the trees) and ``prediction``, the likelier class."""

    def __init__(self, path: str, cols: Sequence[str], edges: Sequence[Sequence[float]]):
        super().__init__()
        self.path, self.cols, self.edges = path, list(cols), [np.asarray(e, float) for e in edges]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, edges = dataset.sparkSession, self.edges
        files = []
        for file in sorted(spark.read.parquet(self.path).inputFiles()):
            spark.sparkContext.addFile(file)  # each executor fetches it once
            files.append(file.rsplit("/", 1)[-1])

        def scored(held: list[pa.RecordBatch], x: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            x = np.concatenate(x)
            total, count = np.zeros(len(x)), 0
            for feature, bins, left, value in _trees(files):
                total += value[leaves(feature, bins, left, np.arange(1), x)[0]]
                count += 1
            one, begin = total / count, 0
            for batch in held:
                p = one[begin : begin + batch.num_rows]
                begin += batch.num_rows
                both = pa.ListArray.from_arrays(np.arange(0, 2 * len(p) + 1, 2, dtype=np.int32), np.column_stack([1 - p, p]).ravel())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], both, pa.array((p > 0.5).astype(float))], names=[*batch.schema.names[:-1], "probability", "prediction"]
                )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, x, rows = [], [], 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(batch)
                x.append(binned(batch.column(batch.num_columns - 1), batch.num_rows, edges))
                rows += batch.num_rows
                if rows >= ROWS_AT_ONCE:
                    yield from scored(held, x)
                    held, x, rows = [], [], 0
            if rows:
                yield from scored(held, x)

        schema = T.StructType([*dataset.schema.fields, *_OUT])
        return dataset.select("*", numbers(self.cols).alias("_x")).mapInArrow(run, schema)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: KeptForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        extra = {"cols": self.forest.cols, "edges": [e.tolist() for e in self.forest.edges]}
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, extra)
        self.sparkSession.read.parquet(self.forest.path).write.option("compression", "zstd").parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> KeptForest:
        found = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        return KeptForest(f"{path}/trees", found["cols"], found["edges"])


def fit_forest(
    df: DataFrame, cols: Sequence[str], params: Mapping | None = None, label: str = "label", key: str = ID_COL, seed: int = SEED
) -> PipelineModel:
    """A forest (100 trees by default) that learns all labelled rows, whatever their number; all parameters have their effect."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4().hex}"
    growth, cut, trees = growth_of(dict(params or {}), range(len(cols)))
    data = Binned(df.select(key, label, *cols, F.lit(0).alias("fold")), cols, key, label, "fold")
    try:
        if not data.rows:
            raise ValueError("a forest needs labelled rows to learn")
        grown_trees(data, growth, cut, trees, seed).write.option("compression", "zstd").parquet(path)
    finally:
        data.unpersist()
    return PipelineModel([KeptForest(path, cols, data.edges)])
