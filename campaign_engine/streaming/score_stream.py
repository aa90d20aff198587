"""Batch prediction on records that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from campaign_engine.operators.supervised import ConversionModel, predict_conversion
from campaign_engine.schemas import DEFAULT_THRESHOLD, ID_COL


def read_records(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1_000) -> DataFrame:
    """Record files (parquet) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def score_stream(
    model: ConversionModel,
    records: DataFrame,
    path: str,
    checkpoint: str,
    threshold: float = DEFAULT_THRESHOLD,
    key: str = ID_COL,
) -> StreamingQuery:
    """Score what has arrived and stop. Stateless, so the file sink writes every record exactly once."""
    scored = predict_conversion(model, records, threshold, key)
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
