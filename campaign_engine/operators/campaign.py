"""Campaign operators on scored customers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campaign_engine.functions.numeric import known, reaches, round_places
from campaign_engine.operators.columns import band_scores, select_existing
from campaign_engine.operators.order_stats import EXACT_ROWS, running_totals
from campaign_engine.operators.shape import join_frequent
from campaign_engine.schemas import DEFAULT_THRESHOLD, TARGET_API_COLS, TARGET_TABLE_COLS, UPSELL_THRESHOLD

SCORE = "conversion_score"


def percentile_rank(df: DataFrame, col: str = SCORE, name: str = "score_percentil", limit: int = EXACT_ROWS) -> DataFrame:
    """(mean rank of the row's ties) / n * 100; null and NaN scores get null.

    Ranks are computed per distinct score and joined back without shuffling the rows of a frequent score.
    """
    number = known(F.col(col).cast("double"))
    counts = df.filter(number.isNotNull()).groupBy(number.alias("_score")).agg(F.count("*").alias("_n"))
    ranks = running_totals(counts, "_score", ["_n"], limit=limit).select(
        "_score", "_n", ((F.col("cum__n") - (F.col("_n") - 1) / 2) / F.col("total__n") * 100).alias(name)
    )
    return join_frequent(df, ranks, number, "_score", "_n").drop("_score", "_n")


def impact_by(df: DataFrame, dim: str, threshold: float = DEFAULT_THRESHOLD, top: int | None = None) -> DataFrame:
    """(dim, mean_score, targets): best mean score first."""
    impact = df.groupBy(dim).agg(
        F.avg(known(F.col(SCORE).cast("double"))).alias("mean_score"), F.count_if(reaches(F.col(SCORE), threshold)).alias("targets")
    )
    ordered = impact.orderBy(F.desc("mean_score"), dim)
    return ordered if top is None else ordered.limit(top)


def campaign_kpis(df: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row: total, targets, coverage %, mean target score, target spend, mean score; 0 without targets."""
    hit = reaches(F.col(SCORE), threshold)
    zero = F.lit(0.0)
    sums = df.agg(
        F.count("*").alias("n_total"),
        F.count_if(hit).alias("n_target"),
        F.coalesce(F.avg(F.when(hit, F.col(SCORE))), zero).alias("mean_target_score"),
        F.coalesce(F.sum(F.when(hit, F.col("total_spent"))), zero).alias("target_spend"),
        F.coalesce(F.avg(known(F.col(SCORE).cast("double"))), zero).alias("mean_score"),
    )
    coverage = F.coalesce(F.try_divide(F.col("n_target") * 100.0, F.col("n_total")), zero)
    return sums.withColumn("coverage", coverage)


def threshold_grid(low: int = 10, high: int = 95) -> list[float]:
    """Thresholds in steps of 0.01."""
    return [i / 100 for i in range(low, high + 1)]


def threshold_sweep(df: DataFrame, grid: Sequence[float]) -> DataFrame:
    """KPIs for every threshold: scores are put between the thresholds once, then summed from the top.

    Customers without a score count in ``n_total``, as in ``campaign_kpis``, but reach no threshold.
    """
    splits = [-math.inf, *grid, math.inf]
    scored = df.filter(known(F.col(SCORE).cast("double")).isNotNull())
    placed = Bucketizer(splits=splits, inputCol=SCORE, outputCol="_slot").transform(scored)
    n_total = df.agg(F.count("*")).scalar()
    slots = placed.groupBy(F.col("_slot").cast("int").alias("slot")).agg(
        F.count("*").alias("n"), F.sum(SCORE).alias("score_sum"), F.sum("total_spent").alias("spend")
    )
    every = df.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("slot"))
    full = every.join(slots, "slot", "left")
    above = Window.orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = full.select(
        "slot",
        F.sum(F.coalesce("n", F.lit(0))).over(above).alias("n_target"),
        F.sum(F.coalesce("score_sum", F.lit(0.0))).over(above).alias("score_sum"),
        F.sum(F.coalesce("spend", F.lit(0.0))).over(above).alias("target_spend"),
        n_total.alias("n_total"),
    )
    zero = F.lit(0.0)
    thresholds = F.array(*[F.lit(float(t)) for t in grid])
    return sums.filter(F.col("slot") > 0).select(
        F.element_at(thresholds, F.col("slot")).alias("threshold"),
        "n_total",
        "n_target",
        F.coalesce(F.try_divide(F.col("n_target") * 100.0, F.col("n_total")), zero).alias("coverage"),
        F.coalesce(F.try_divide("score_sum", "n_target"), zero).alias("mean_target_score"),
        "target_spend",
    )


def upsell_summary(df: DataFrame, base: Column, score: str = SCORE, threshold: float = UPSELL_THRESHOLD) -> DataFrame:
    """One row over the customers on the basic plan: how many reach the threshold, and their share in %."""
    hit = F.count_if(reaches(F.col(score), threshold))
    counts = df.filter(base).agg(F.count("*").alias("n_base"), hit.alias("n_candidates"))
    share = F.coalesce(F.try_divide(F.col("n_candidates") * 100.0, F.col("n_base")), F.lit(0.0))
    return counts.withColumn("share", share)


def top_targets(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, n: int = 50, cols: Sequence[str] = TARGET_API_COLS
) -> DataFrame:
    """The first n targets by score; ties in the order of the id. Planned as a top-k, not as a full sort."""
    targets = df.filter(reaches(F.col(SCORE), threshold))
    return select_existing(targets.orderBy(F.desc(SCORE), "client_id").limit(n), cols)


def target_table(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, n: int = 50) -> DataFrame:
    """The operations table: bands added, percentile to one place, 15 columns."""
    top = top_targets(band_scores(df), threshold, n, TARGET_TABLE_COLS)
    if "score_percentil" in top.columns:
        top = top.withColumn("score_percentil", round_places(F.col("score_percentil"), 1))
    return top


def rank_results(metrics: DataFrame, by: Sequence[str] = ("roc_auc", "avg_precision"), n: int | None = None,
                 name: str = "feature_set") -> DataFrame:
    """Best results first."""
    ordered = metrics.orderBy(*[F.desc(c) for c in by], name)
    return ordered if n is None else ordered.limit(n)
