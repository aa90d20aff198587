"""Dictionary translation and the list of texts still to be translated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.functions.text import is_human_text, strip
from campaign_engine.operators.shape import bounded_broadcast

# Supported languages, the default one and the size of a work list for one call of the service.
LANGUAGES = ("es", "en")
DEFAULT_LANG = "es"
WORKLIST_ROWS = 450
DICTIONARY_ROWS = 100_000


def normalize_lang(lang: str | None) -> str:
    return lang if lang in LANGUAGES else DEFAULT_LANG


def _direction(source: str, target: str) -> Column:
    return (F.col("src") == source) & (F.col("tgt") == target)


def translate(df: DataFrame, col: str, dictionary: DataFrame, source: str = "es", target: str | None = "en") -> DataFrame:
    """Replace texts found in the dictionary; missing, empty and same-language texts stay."""
    target = normalize_lang(target)
    if source == target:
        return df
    words = dictionary.filter(_direction(source, target) & (F.col("translated") != ""))
    words = words.groupBy(F.col("text").alias("_text")).agg(F.max("translated").alias("_translated"))
    joined = df.join(bounded_broadcast(words, DICTIONARY_ROWS), F.col(col) == F.col("_text"), "left")
    return joined.withColumn(col, F.coalesce("_translated", col)).select(*df.columns)


def translation_worklist(
    df: DataFrame, col: str, dictionary: DataFrame, source: str = "es", target: str = "en", limit: int | None = None
) -> DataFrame:
    """Distinct human texts that the dictionary lacks, in text order; all of them unless there is a ``limit``."""
    texts = df.select(strip(F.col(col)).alias("text")).filter(is_human_text(F.col("text"))).distinct()
    known = dictionary.filter(_direction(source, target)).select("text").distinct()
    missing = texts.join(known, "text", "left_anti").orderBy("text")
    return missing if limit is None else missing.limit(limit)
