"""Training job: model, metrics, regressions and the score of every customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from campaign_engine.operators import metrics
from campaign_engine.operators.campaign import percentile_rank
from campaign_engine.operators.columns import select_existing
from campaign_engine.operators.kept_forest import fit_forest
from campaign_engine.operators.prep import feature_defaults, feature_names, kept_sample, split, with_split
from campaign_engine.operators.shape import overlay, stack_tagged
from campaign_engine.operators.shared_forest import Binned, Job, held_out_scores
from campaign_engine.operators.supervised import (
    ConversionModel,
    fit_classifier,
    fit_regressor,
    predict,
    score,
)
from campaign_engine.operators.tree_growth import growth_of
from campaign_engine.schemas import CAMPAIGN_COLS, CAT_COLS, ID_COL, POSITIVE_CLASS, SEED, TARGET_COL
from campaign_engine.session import ensure_checkpoint_dir, in_parallel

# The two classifiers and regressors with their settings.
CLASSIFIERS = {"Random Forest": ("rf", {"n_estimators": 120}), "Regresión Logística": ("lr", {"max_iter": 600})}
REGRESSORS = {"Regresión Lineal": "linear", "Random Forest Regressor": "rf"}


def labelled(coded: DataFrame, clean: DataFrame, positive: str = POSITIVE_CLASS) -> DataFrame:
    """Coded features with ``label`` = 1 for the positive class, taken from the readable table."""
    truth = clean.select(ID_COL, (F.col(TARGET_COL) == positive).cast("double").alias("label"))
    return coded.join(truth, ID_COL)


@dataclass
class Training:
    model: ConversionModel
    held_out: DataFrame
    metrics: DataFrame
    reports: DataFrame
    scores: DataFrame

    def write(self, path: str) -> None:
        """Write all parts; the held-out rows, which metrics and reports read several times, are scored once for them."""
        self.model.save(f"{path}/model")
        self.held_out.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.metrics.write.mode("overwrite").parquet(f"{path}/metrics")
            self.reports.write.mode("overwrite").parquet(f"{path}/reports")
        finally:
            self.held_out.unpersist()
        self.scores.write.mode("overwrite").parquet(f"{path}/campaign_scores")


def train_classifiers(
    data: DataFrame, settings: Mapping[str, tuple[str, dict]] = CLASSIFIERS, seed: int = SEED, fit_rows: int | None = None
) -> tuple[ConversionModel, DataFrame]:
    """(the forest with its feature defaults, (model, client_id, label, conversion_score, prediction) of the test part).

    Models learn the whole training part; ``fit_rows`` bounds the rows of a kept forest.
    """
    cols = feature_names(data, TARGET_COL)
    train, test = split(data, ID_COL, 0.2, seed, "label")
    parts, forest_model = {}, None
    bounded = None if fit_rows is None else kept_sample(train, ID_COL, fit_rows)

    def fit(kind: str, params: dict):
        if kind != "rf":
            return lambda: fit_classifier(train, kind, cols, params, seed=seed)
        return lambda: fit_forest(train, cols, params, seed=seed) if bounded is None else fit_classifier(bounded, kind, cols, params, seed=seed)

    for (name, (kind, _)), fitted in zip(settings.items(), in_parallel([fit(*s) for s in settings.values()])):
        parts[name] = score(fitted, test).select(ID_COL, "label", "conversion_score", "prediction")
        if kind == "rf":
            forest_model = ConversionModel(fitted, feature_defaults(data, cols))
    if forest_model is None:
        raise ValueError("one of the classifiers has to be a forest")
    return forest_model, stack_tagged(parts, "model")


def classifier_metrics(held_out: DataFrame, names: Sequence[str]) -> DataFrame:
    """(model, roc_auc, avg_precision, tn, fp, fn, tp)."""
    rows = {}
    for name in names:
        part = held_out.filter(F.col("model") == name)
        cells = metrics.confusion(part, "label", "prediction")
        ranking = metrics.ranking_metrics(part, "label", "conversion_score")
        rows[name] = ranking.withColumns({c: cells.select(c).scalar() for c in metrics.CELLS})
    return stack_tagged(rows, "model")


def forest_regression(
    data: DataFrame, cols: Sequence[str], target: str, trees: int = 120, depth: int | None = None, seed: int = SEED
) -> DataFrame:
    """Test part with ``prediction``: a forest of full trees, or of some depth, learns the whole training part.

    Its trees grow and predict as jobs on one binned table, so that no model passes through the driver. Rows without a
    target are not predicted.
    """
    folded = with_split(data, ID_COL, 0.2, seed).withColumn("fold", F.when(F.col("is_test"), 0).otherwise(1))
    growth, cut, _ = growth_of({"max_features": max(1, len(cols) // 3), "max_depth": depth}, range(len(cols)), "squares")
    binned = Binned(folded.select(ID_COL, target, "fold", *cols), cols, ID_COL, target, "fold")
    found = held_out_scores(binned, [Job(growth, cut, trees, (0,))], seed).select("hash", F.col("y"), F.col("score").alias("prediction"))
    test = folded.filter("is_test").drop("is_test", "fold").withColumns(
        {"hash": F.xxhash64(ID_COL), "y": F.col(target).cast("double")}
    )
    return test.join(found, ["hash", "y"]).drop("hash", "y")


def train_regressors(
    data: DataFrame, target: str = "total_spent", trees: int = 120, depth: int | None = None, seed: int = SEED
) -> DataFrame:
    """(model, rmse, r2), best first, fitted on the whole training part. Columns computed from the target are not features."""
    cols = feature_names(data, target)
    train, test = split(data, ID_COL, 0.2, seed)
    results = {}
    for name, kind in REGRESSORS.items():
        predicted = (
            predict(fit_regressor(train, kind, cols, target), test) if kind == "linear"
            else forest_regression(data, cols, target, trees, depth, seed)
        )
        results[name] = metrics.regression_metrics(predicted, target, "prediction")
    return stack_tagged(results, "model").orderBy("rmse")


def campaign_scores(model: ConversionModel, coded: DataFrame, clean: DataFrame, seed: int = SEED) -> DataFrame:
    """Score, percentile and readable labels of every customer, training rows included and marked.

    Ranks pass over the scores several times, so the scored rows are kept by a checkpoint: the forest meets each row once.
    """
    ensure_checkpoint_dir(coded.sparkSession)
    marked = with_split(coded, ID_COL, 0.2, seed, "label") if "label" in coded.columns else coded.withColumn("is_test", F.lit(True))
    scored = score(model.pipeline, marked).withColumn("is_train", ~F.col("is_test"))
    slim = select_existing(scored, [*CAMPAIGN_COLS, "conversion_score", "is_train"])
    readable = overlay(slim, clean, ID_COL, [c for c in CAT_COLS if c in clean.columns])
    return percentile_rank(readable.checkpoint())


def train(clean: DataFrame, coded: DataFrame, settings: Mapping[str, tuple[str, dict]] = CLASSIFIERS, seed: int = SEED,
          fit_rows: int | None = None) -> Training:
    """The whole job; forests learn all labelled rows of the training part or ``fit_rows`` of them.

    A coded table that has its ``label`` already, as a stored one, is taken as it is.
    """
    data = coded if "label" in coded.columns else labelled(coded, clean)
    model, held_out = train_classifiers(data, settings, seed, fit_rows)
    reports = stack_tagged(
        {n: metrics.class_report(held_out.filter(F.col("model") == n), "label", "prediction") for n in settings}, "model"
    )
    scores = campaign_scores(model, data, clean, seed)
    return Training(model, held_out, classifier_metrics(held_out, list(settings)), reports, scores)
