"""Toxicity of texts: FTRL-proximal logistic regression over hashed words, stems, pairs and skip-grams (see ftrl)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm import ftrl

MODEL = ftrl.Model(grams=2, skips=(1,), stem=5, alpha=1.0, l1=5.0, l2=0.0, epochs=4, fit_rows=12_000)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def held_out(id_col: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """Rows whose labels are never learnt; rows without an id aren't held out, and never learnt either."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def _model(docs: DataFrame, labels: DataFrame, model: ftrl.Model, id_col: str, text_col: str, label_col: str) -> list:
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(~held_out(F.col("id")))
    return ftrl.train(docs, rows, model, id_col, text_col)


def scores(
    docs: DataFrame, labels: DataFrame, model: ftrl.Model = MODEL, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", threshold: float = THRESHOLD,
) -> DataFrame:
    """(id_col, held_out, score, predicted) of each row; ``predicted`` is 1 from ``threshold`` on."""
    weights = _model(docs, labels, model, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = rows.withColumn("score", ftrl.score(F.col("text"), weights, model, docs))
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, model: ftrl.Model = MODEL, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    weights = _model(docs, labels, model, id_col, text_col, label_col)
    return docs.filter(ftrl.score(F.col(text_col), weights, model, docs) < threshold)
