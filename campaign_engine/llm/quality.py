"""Quality of texts: FTRL logistic regression over hashed word n-grams, with signs and repetition as words (see ftrl)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm import ftrl
from campaign_engine.llm.toxicity import held_out

MODEL = ftrl.Model(grams=2, symbols=True, scaled=True, alpha=1.0, l1=0.3, l2=0.0, epochs=2)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0


def scores(
    docs: DataFrame, labels: DataFrame, model: ftrl.Model = MODEL, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """(id_col, held_out, score, predicted) of each row; ``predicted`` is 1 from ``threshold`` on."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    weights = ftrl.train(docs, known.filter(~held_out(F.col("id"), FOLDS, HELD_OUT)), model, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = rows.withColumn("score", ftrl.score(F.col("text"), weights, model, docs))
    return scored.select(
        F.col("id").alias(id_col), held_out(F.col("id"), FOLDS, HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
