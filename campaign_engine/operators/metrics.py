"""Exact metrics of binary scores, predictions and regressions.

Everything is derived from counts per distinct score, so rows meet once, in a map-side combined ``groupBy``.
Tables with one class or without rows give null or zero metrics, never an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.functions.numeric import known, ratio, reaches, round_places
from campaign_engine.operators.order_stats import EXACT_ROWS, running_totals, running_totals_by
from campaign_engine.operators.shape import stack_tagged

CELLS = ("tn", "fp", "fn", "tp")


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row (tn, fp, fn, tp)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def _report(cells: DataFrame) -> DataFrame:
    """Classification report out of one row of confusion cells."""
    tn, fp, fn, tp = (F.col(c) for c in CELLS)
    total = tn + fp + fn + tp

    def per_class(hit: Column, false_alarm: Column, miss: Column) -> tuple[Column, Column, Column, Column]:
        precision, recall = ratio(hit, hit + false_alarm), ratio(hit, hit + miss)
        return precision, recall, ratio(2 * hit, 2 * hit + false_alarm + miss), hit + miss

    zero, one = per_class(tn, fn, fp), per_class(tp, fp, fn)
    accuracy = ratio(tp + tn, total)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [ratio(a * zero[3] + b * one[3], total) for a, b in zip(zero[:3], one[:3])]
    rows = {
        "0": zero,
        "1": one,
        "accuracy": (accuracy, accuracy, accuracy, total),
        "macro avg": (*macro, total),
        "weighted avg": (*weighted, total),
    }
    structs = [
        F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1_score"),
            s.alias("support"),
        )
        for name, (p, r, f, s) in rows.items()
    ]
    return cells.select(F.inline(F.array(*structs)))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, precision, recall, f1_score, support) per class, accuracy and the two averages; 0/0 is 0."""
    return _report(confusion(df, label, pred))


def with_prediction(df: DataFrame, score: str, threshold: float, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, reaches(F.col(score), threshold).cast("int"))


def report_at(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Report of ``score >= threshold``, with the threshold in front."""
    report = class_report(with_prediction(df, score, threshold, "_pred"), label, "_pred")
    return report.select(F.lit(float(threshold)).alias("threshold"), "*")


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def _counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg) per distinct score; a NaN score is missing, as null is."""
    y = F.col(label) == 1
    number = known(F.col(score).cast("double"))
    return df.filter(number.isNotNull() & F.col(label).isNotNull()).groupBy(number.alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )


def _cumulative(df: DataFrame, label: str, score: str, limit: int) -> DataFrame:
    """Counts per score with running totals from the highest score down, and the class totals."""
    return running_totals(_counts(df, label, score), "score", ["pos", "neg"], True, limit)


def roc_curve(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, with the starting point (0, 0) that no score reaches."""
    points = _cumulative(df, label, score, limit).select(
        F.try_divide("cum_neg", "total_neg").alias("fpr"),
        F.try_divide("cum_pos", "total_pos").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(None).cast("double").alias("threshold")
    )
    return start.unionByName(points)


def _auc() -> Column:
    """Positives of a score win against all negatives below it and half of those beside it."""
    won = F.col("pos").cast("double") * (F.col("total_neg") - F.col("cum_neg") + F.col("neg") / 2)
    pairs = F.first("total_pos").cast("double") * F.first("total_neg")
    return F.try_divide(F.sum(won), pairs)


def _ap() -> Column:
    """Sum of (recall step x precision); the recall step of a score is its own positives."""
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return F.sum(F.try_divide("pos", "total_pos") * precision)


def roc_auc(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """Probability that a positive outscores a negative, ties counting half."""
    return _cumulative(df, label, score, limit).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """Average precision as a step sum, not as a trapezoid."""
    return _cumulative(df, label, score, limit).agg(_ap().alias("avg_precision"))


def ranking_metrics(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """Both ranking metrics in one pass: (roc_auc, avg_precision)."""
    return _cumulative(df, label, score, limit).agg(_auc().alias("roc_auc"), _ap().alias("avg_precision"))


def ranking_metrics_by(df: DataFrame, keys: Sequence[str], label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """(keys, roc_auc, avg_precision) of every group at once, from one keyed running total."""
    y, number = F.col(label) == 1, known(F.col(score).cast("double"))
    counts = df.filter(number.isNotNull() & F.col(label).isNotNull()).groupBy(*keys, number.alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")
    )
    points = running_totals_by(counts, keys, "score", ["pos", "neg"], True, limit)
    return points.groupBy(*keys).agg(_auc().alias("roc_auc"), _ap().alias("avg_precision"))


def pr_curve(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """(precision, recall, threshold) per distinct score, with the end point (1, 0)."""
    points = _cumulative(df, label, score, limit).select(
        F.try_divide("cum_pos", F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide("cum_pos", "total_pos").alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold")
    )
    return points.unionByName(end)


def best_f1(df: DataFrame, label: str, score: str, limit: int = EXACT_ROWS) -> DataFrame:
    """One row (threshold, precision, recall, f1): the highest F1, the lowest threshold on a tie."""
    curve = pr_curve(df, label, score, limit).filter(F.col("threshold").isNotNull())
    p, r = F.col("precision"), F.col("recall")
    scored = curve.withColumn("f1", 2 * p * r / (p + r + 1e-10))
    return scored.orderBy(F.desc("f1"), "threshold").limit(1).select("threshold", "precision", "recall", "f1")


def regression_metrics(df: DataFrame, y: str, prediction: str) -> DataFrame:
    """One row (rmse, r2); the total sum of squares comes from the population variance, in the same pass."""
    actual, error = F.col(y).cast("double"), F.col(y).cast("double") - F.col(prediction)
    sums = df.agg(F.avg(error * error).alias("mse"), F.var_pop(actual).alias("var"))
    return sums.select(F.sqrt("mse").alias("rmse"), (1 - F.try_divide("mse", "var")).alias("r2"))


def metrics_long(reports: Mapping[str, DataFrame], places: int = 3) -> DataFrame:
    """(model, class, metric, value, series) of the two classes of each report."""
    both = stack_tagged(dict(reports), "model").filter(F.col("class").isin("0", "1"))
    named = both.withColumn("class", F.concat(F.lit("Clase "), F.col("class")))
    values = named.unpivot(["model", "class"], ["precision", "recall", "f1_score"], "metric", "value")
    return values.withColumn("value", round_places(F.col("value"), places)).withColumn(
        "series", F.concat_ws(" | ", "model", "class")
    )
