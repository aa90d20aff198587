"""Token ids of documents in files of Simple-8b words, in ascending order of the document ids.

A file set is a folder of Parquet files, one for each range of document ids; Spark's committer makes it whole or
absent, on any store. Each row is a segment, a run of documents: ``part`` (range), ``segment`` (number in it),
``before`` (ids before it in its part), ``ids`` (number of ids), ``docs`` and ``counts`` (the documents and how many
ids each has), ``words``, ``escapes`` and ``places`` (little-endian arrays of ``simple8b.encode``). Segments hold up
to 4 MB of text, or one longer document.

Null and empty texts have the end id only. Null document ids come first. Rows that repeat an id stay separate rows;
those of one id are ordered by a hash of their text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from campaign_engine.llm import simple8b
from campaign_engine.llm.shared import ship, slices
from campaign_engine.llm.tokens import loaded

SEGMENT_BYTES = 1 << 22


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents with ``end_id`` after each."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def _schema(id_type: T.DataType) -> T.StructType:
    columns = [("part", T.IntegerType()), ("segment", T.IntegerType()), ("before", T.LongType()), ("ids", T.LongType()),
               ("docs", T.ArrayType(id_type)), ("counts", T.ArrayType(T.LongType())), ("words", T.BinaryType()),
               ("escapes", T.BinaryType()), ("places", T.BinaryType())]
    return T.StructType([T.StructField(n, t) for n, t in columns])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write a file set to ``path`` (a new folder of a store that all executors share)."""
    ship(docs.sparkSession)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number, before = loaded(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text"), SEGMENT_BYTES):
                ids, counts = with_end(*encoder.encode(texts), end_id)
                packed = [x.astype(x.dtype.newbyteorder("<")).tobytes() for x in simple8b.encode(ids)]
                own = batch.column("id").slice(done, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before]), pa.array([len(ids)]),
                     pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                     pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(counts)),
                     *(pa.array([p], pa.binary()) for p in packed)],
                    names=["part", "segment", "before", "ids", "docs", "counts", "words", "escapes", "places"],
                )
                done, number, before = done + len(texts), number + 1, before + len(ids)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    made = sorted_rows.mapInArrow(segments, _schema(docs.schema[id_col].dataType))
    made.write.option("compression", "zstd").parquet(path)


def _opened(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a segment, and how many each of its documents has."""
    at = lambda name: batch.column(name)[row]
    words, escapes = (np.frombuffer(at(n).as_py(), "<u8") for n in ("words", "escapes"))
    places = np.frombuffer(at("places").as_py(), "<u4").reshape(-1, 2)
    return simple8b.decode(words, escapes, places, at("ids").as_py()), at("counts").values.to_numpy()


def _starts(files: DataFrame) -> DataFrame:
    """Each part's number of ids before it: one row for each part, as many as there are files."""
    totals = files.groupBy("part").agg(F.sum("ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))


def _with_starts(files: DataFrame) -> DataFrame:
    return files.join(F.broadcast(_starts(files)), "part").withColumn("first", F.col("part_start") + F.col("before"))


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, ids): the ids of each document and the number of ids of all documents before it."""
    ship(spark)
    files = spark.read.parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, counts = _opened(batch, row)
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int64)))
                start = pa.array(ends - counts + batch.column("first")[row].as_py())
                yield pa.RecordBatch.from_arrays([batch.column("docs")[row].values, start, lists], names=[id_col, "start", "ids"])

    kind = files.schema["docs"].dataType.elementType
    fields = [T.StructField(id_col, kind), T.StructField("start", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))]
    return _with_starts(files).mapInArrow(documents, T.StructType(fields))


def digests(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of each document of a file set, without its ids leaving the reader."""
    ship(spark)
    files = spark.read.parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, counts = _opened(batch, row)
                ends, data = np.cumsum(counts), memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(data[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                start = pa.array(ends - counts + batch.column("first")[row].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("docs")[row].values, start, pa.array(counts), pa.array(crc, pa.int64())],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )

    kind = files.schema["docs"].dataType.elementType
    fields = [T.StructField(id_col, kind)] + [T.StructField(n, T.LongType()) for n in ("start", "n_tokens", "ids_crc32")]
    return _with_starts(files).mapInArrow(documents, T.StructType(fields))
