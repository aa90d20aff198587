"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from campaign_engine.operators.identity import with_client_id
from campaign_engine.plans import cleaning
from campaign_engine.schemas import ENCODED_SCHEMA, ID_COL


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    options: Mapping | None = None,
) -> DataFrame:
    """Table in a columnar or text format. Workbooks have to be exported to CSV or parquet first."""
    if fmt not in ("parquet", "orc", "csv", "json"):
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    return reader.options(**dict(options or {})).load(path)


def read_clean(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Clean table, with ``client_id`` made from the key if it is not stored."""
    df = spark.read.parquet(path)
    return df if ID_COL in df.columns or key is None else with_client_id(df, key)


def read_encoded(spark: SparkSession, path: str, schema: T.StructType = ENCODED_SCHEMA) -> DataFrame:
    """Coded table from CSV with a declared schema, so that no pass is spent on inference."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def write_outputs(clean: DataFrame, coded: DataFrame, clean_path: str, coded_path: str) -> None:
    clean.write.mode("overwrite").parquet(clean_path)
    coded.write.mode("overwrite").csv(coded_path, header=True)


def write_results(df: DataFrame, path: str) -> None:
    """Ranked search results as JSON lines."""
    df.write.mode("overwrite").json(path)


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has finished writing a table there; errors of the store are raised, not taken for absence."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder.suffix("/_SUCCESS"))


def ensure_outputs(
    spark: SparkSession, raw: DataFrame, paths: Mapping[str, str], force: bool = False, profile: str = "bootstrap"
) -> dict[str, str]:
    """Build what is missing: both tables stored - reuse; only the clean one - encode it; else, or with
    ``force``, rebuild from raw. Returns what was done per table."""
    has_clean = not force and _finished(spark, paths["clean"])
    if has_clean and _finished(spark, paths["encoded"]):
        return {"clean": "reused", "encoded": "reused"}
    if not has_clean:
        cleaning.clean(raw, profile).write.mode("overwrite").parquet(paths["clean"])
    stored = spark.read.parquet(paths["clean"])
    coded, _ = cleaning.encoded(stored, profile)
    coded.write.mode("overwrite").csv(paths["encoded"], header=True)
    return {"clean": "reused" if has_clean else "built", "encoded": "built"}


