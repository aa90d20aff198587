"""Helpers of this subpackage: stored intermediate tables, joins with hot keys, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_engine.session import ensure_checkpoint_dir

HOT_KEYS = 1000  # a key is hot if it has more than this share (1 / HOT_KEYS) of all rows: at most so many are


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for an application; Spark serves the file from the driver."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):
        target = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(target, "w") as out:
            for folder, _, names in os.walk(package):
                for name in (n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def scratch_path(spark: SparkSession) -> str:
    """A new folder in the session's part of the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends there, lost executors lose nothing."""
    path = scratch_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables of this session, once their results are written elsewhere."""
    ensure_checkpoint_dir(spark)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(folder) if files.exists(folder) else []:
        if status.getPath().getName().startswith("table-"):
            files.delete(status.getPath(), True)


def lookup(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has each key once and in ``count`` how many rows have it.

    Keys with over a thousandth of all rows, at most a thousand of them, are broadcast, so their rows aren't
    shuffled; all other keys are joined by a shuffle. The plan is the same for every input: where no key is hot, the
    broadcast table has no rows. ``table`` must be cheap to read (stored).
    """
    limit = max(100, (table.agg(F.sum(count)).first()[0] or 0) // HOT_KEYS)
    hot, cold = table.filter(F.col(count) > limit), table.filter(F.col(count) <= limit)
    among_hot = rows.join(F.broadcast(hot), key)
    marked = rows.join(F.broadcast(hot.select(key, F.lit(True).alias("own_hot"))), key, "left")
    others = marked.filter("own_hot is null").drop("own_hot").join(cold, key)
    return among_hot.unionByName(others)


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``links`` (a, b: long): label is the smallest node that can be reached.

    Alternating large-star and small-star steps; each is a minimum per node and a join, and the links stay as
    many as before or become fewer. No node's links are gathered.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == state:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = state
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n")))
        large = stored(lookup(both, least, "u", "n").filter("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = stored(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        edges = stored(
            lookup(down, least, "u", "n").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
        )


def slices(texts: pa.Array, limit: int = 1 << 25) -> Iterator[pa.Array]:
    """The texts (null: empty) as binary arrays of at most ``limit`` bytes each, or of one text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield texts.slice(start, stop - start)
        start = stop
