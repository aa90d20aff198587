"""Documents as token ids packed into sequences of bounded length by the sum-of-squares rule.

A document is its ids and an end id; only one longer than a sequence is cut, into pieces of full length and a rest.
Each piece goes where the squared counts of open sequences per remaining gap then sum up to least: into an open
sequence with a certain gap, or into a new one. Full sequences don't count. Pieces are placed from long to short.

Rows of pieces (no ids) are dealt by their place in the stored table, so evenly whatever they hold, to groups of about
``group`` pieces; each group packs on its own, at most
about a gap's worth of open sequences remaining in each, so that sequences are few and no task holds all pieces.
Null and empty texts are an end id alone. Rows that repeat an id are packed as separate documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.llm.shared import ship, slices, stored
from campaign_engine.llm.token_files import with_end
from campaign_engine.llm.tokens import loaded

def packed(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length (1 to size), by the sum-of-squares rule."""
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    counts = np.zeros(size + 1, np.int64)  # of open sequences by gap; those of gap 0 are closed
    open_: list[list[int]] = [[] for _ in range(size + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        # from gap g to g - length, the sum of squares changes by 2 (counts[g - length] - counts[g]) + 2
        change = 2 * (counts[: size + 1 - length] - counts[length:]) + 2
        change[0] = 1 - 2 * counts[length]  # a sequence that is filled leaves the sum
        change[counts[length:] == 0] = np.iinfo(np.int64).max
        rest = size - length
        best = int(change.argmin())
        if change[best] > (2 * counts[rest] + 1 if rest else 0):
            number, made, gap = made, made + 1, size
        else:
            gap = best + length
            number = open_[gap].pop()
            counts[gap] -= 1
        sequence[i], offset[i] = number, size - gap
        if gap > length:
            open_[gap - length].append(number)
            counts[gap - length] += 1
    return sequence, offset


def pieces(
    docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", table: int = 800_000
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32) of each piece of each document."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(tokenizer, table)
        for batch in batches:
            done = 0
            for texts in slices(batch.column("text"), 1 << 22):
                ids, counts = with_end(*encoder.encode(texts), end_id)
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(counts)
                n = -(-counts // size)
                doc = np.repeat(np.arange(len(counts)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * size
                length = np.minimum(size, counts[doc] - start)
                first = (ends - counts)[doc] + start
                crc = [zlib.crc32(data[4 * f : 4 * (f + c)]) for f, c in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(done, len(texts)).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())],
                    names=[id_col, "piece", "start", "length", "ids_crc32"],
                )
                done += len(texts)

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, T.StructType(fields))


def pack(
    docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    group: int = 40_000, table: int = 800_000,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``, their place there.

    ``table``: chunks that a worker remembers, about 150 bytes each. Workers outlive the stage, so a job of many stages
    may want fewer.
    """
    rows = stored(pieces(docs, tokenizer, size, end_id, id_col, text_col, table))
    groups = max(1, -(-rows.count() // group))

    def place(table: pa.Table) -> pa.Table:
        sequence, offset = packed(table.column("length").to_numpy(), size)
        base = (table.column("own_group")[0].as_py() if table.num_rows else 0) << 40
        return table.drop_columns(["own_group"]).append_column("sequence_id", pa.array(sequence + base)).append_column(
            "offset", pa.array(offset)
        )

    schema = T.StructType([*rows.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    dealt = rows.withColumn("own_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("own_group").applyInArrow(place, schema)
