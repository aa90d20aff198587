"""Side tables kept as small JSON objects: the translation dictionary and the exchange-rate cache."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_engine.schemas import FX_BASE, FX_QUOTE

OBJECT_CHARS = 50_000


def dictionary_rows(objects: DataFrame, col: str = "value") -> DataFrame:
    """(src, tgt, text, translated) from JSON objects with keys ``src|tgt|text``.

    Keys with fewer than three parts, values that are not strings and broken objects are dropped. An object of over
    ``OBJECT_CHARS`` characters that can't be parsed is an error, not a broken one: it may be beyond the parser's
    limits. Large dictionaries are kept as entries, see ``read_entries``.
    """
    value = F.try_parse_json(col)
    message = F.lit("a dictionary object is too large to parse or broken: store it as entries")
    checked = F.when(value.isNull() & (F.length(col) > OBJECT_CHARS), F.raise_error(message).cast("variant")).otherwise(value)
    parsed = objects.select(checked.alias("v"))
    pairs = parsed.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("v").outer()))
    parts = F.split("key", r"\|", 3)
    is_text = F.schema_of_variant("value") == "STRING"
    return pairs.filter((F.size(parts) == 3) & is_text).select(
        parts[0].alias("src"),
        parts[1].alias("tgt"),
        parts[2].alias("text"),
        F.try_variant_get("value", "$", "string").alias("translated"),
    )


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Dictionary files, one JSON object each."""
    return dictionary_rows(spark.read.text(path, wholetext=True))


def write_entries(dictionary: DataFrame, path: str) -> None:
    """A dictionary as JSON lines, one entry each."""
    dictionary.select("src", "tgt", "text", "translated").write.mode("overwrite").json(path)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """A dictionary of any size, kept as JSON lines with one entry each."""
    return spark.read.json(path, schema="src string, tgt string, text string, translated string")


def rate_rows(objects: DataFrame, col: str = "value") -> DataFrame:
    """(base, quote, rate, as_of, source) from cache objects; broken ones give no row."""
    kind = "struct<fx_usd_clp:struct<rate:double,source:string,cached_at:string>>"
    entry = F.from_json(col, kind)["fx_usd_clp"]
    return objects.select(entry.alias("e")).filter(F.col("e").isNotNull()).select(
        F.lit(FX_BASE).alias("base"),
        F.lit(FX_QUOTE).alias("quote"),
        F.col("e.rate").alias("rate"),
        F.try_to_timestamp("e.cached_at").alias("as_of"),
        F.col("e.source").alias("source"),
    )


def read_rates(spark: SparkSession, path: str) -> DataFrame:
    """Exchange-rate cache files, one JSON object each."""
    return rate_rows(spark.read.text(path, wholetext=True))
