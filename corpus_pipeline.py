"""A training corpus from documents: toxic texts out, one of each group of near copies, no benchmark passages, secrets
masked, packed into sequences. Each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from campaign_engine.llm import decontaminate, near_duplicates, packing, secret_scan, toxicity
from campaign_engine.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return toxicity.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates.deduplicated(docs, shingle=5, percent=80)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty lies in windows of benchmark items."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets: one for live-looking ones, another for widely copied examples."""
    return secret_scan.masked(docs, owner_col="source", repository_col="doc_id")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), size=2048, end_id=0, table=300_000)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", keep_civil),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_unseen),
    ("secrets", mask_secrets),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
