"""Classifiers and regressors on named columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from campaign_engine.operators import logistic, metrics
from campaign_engine.operators.kept_forest import fit_forest
from campaign_engine.operators.prep import class_weights, moments, prepare_features, with_fold, with_weight
from campaign_engine.operators.shared_forest import Binned, Job, held_out_scores
from campaign_engine.operators.tree_growth import growth_of
from campaign_engine.schemas import DEFAULT_THRESHOLD, ID_COL, SEED
from campaign_engine.session import in_parallel

MAX_DEPTH = 30
IGNORED = ("min_samples_split", "ccp_alpha")


@dataclass
class Forest:
    """Spark settings of a forest, and what had no counterpart."""

    settings: dict
    weighted: bool
    ignored: dict

    def key(self) -> tuple:
        return (tuple(sorted(self.settings.items())), self.weighted)


def forest(params: Mapping) -> Forest:
    """Map forest parameters to Spark's: depth at most 30, feature shares as text, balanced classes as weights."""
    settings = {"numTrees": int(params.get("n_estimators", 100))}
    depth = params.get("max_depth")
    settings["maxDepth"] = MAX_DEPTH if depth is None else min(int(depth), MAX_DEPTH)
    settings["minInstancesPerNode"] = int(params.get("min_samples_leaf", 1))
    share = params.get("max_features", "sqrt")
    settings["featureSubsetStrategy"] = "all" if share is None else str(share)
    criterion = params.get("criterion", "gini")
    settings["impurity"] = "entropy" if criterion == "log_loss" else criterion
    settings["subsamplingRate"] = float(params.get("max_samples") or 1.0)
    settings["bootstrap"] = bool(params.get("bootstrap", True))
    ignored = {p: params[p] for p in IGNORED if p in params}
    return Forest(settings, params.get("class_weight") is not None, ignored)


@dataclass
class ConversionModel:
    """A fitted pipeline with its feature columns and their defaults."""

    pipeline: PipelineModel
    defaults: dict[str, float]

    @property
    def features(self) -> list[str]:
        return list(self.defaults)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        rows = [(i, c, v) for i, (c, v) in enumerate(self.defaults.items())]
        frame = spark.createDataFrame(rows, "place int, feature string, value double")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/defaults")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ConversionModel:
        rows = spark.read.parquet(f"{path}/defaults").orderBy("place").collect()  # one row per feature
        return cls(PipelineModel.load(f"{path}/pipeline"), {r["feature"]: r["value"] for r in rows})


def fit_classifier(
    df: DataFrame, kind: str, cols: Sequence[str], params: Mapping | None = None, label: str = "label", seed: int = SEED
) -> PipelineModel:
    """``rf`` (100 trees by default) or ``lr`` (standardized, L2 with C = 1, fitted by Newton's method on all rows)."""
    params = dict(params or {})
    if kind == "rf":
        spec = forest(params)
        data = with_weight(df, class_weights(df, label), label) if spec.weighted else df
        stages: list[Transformer] = [VectorAssembler(inputCols=list(cols), outputCol="features")]
        model = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **spec.settings)
        if spec.weighted:
            model.setWeightCol("weight")
    elif kind == "lr":
        scale = moments(df, cols)
        line = logistic.fit(df, cols, scale, label, float(params.get("C", 1.0)), int(params.get("max_iter", 1000)))
        return PipelineModel(line.stages())
    else:
        raise ValueError(f"unknown model {kind!r}: use 'rf' or 'lr'")
    prepared = PipelineModel(stages).transform(data)
    return PipelineModel([*stages, model.fit(prepared)])


@dataclass(frozen=True)
class ForestFit:
    """Fits a kept forest that learns all rows."""

    cols: Sequence[str]
    params: Mapping

    def __call__(self, train: DataFrame) -> PipelineModel:
        return fit_forest(train, self.cols, self.params)

    def fold_accuracy(self, folds: DataFrame, k: int, key: str, label: str, seed: int) -> DataFrame:
        """(fold, accuracy) of forests that learn all rows of the other folds.

        Rows that repeat a key are told apart by their features, so each has its own score.
        """
        growth, cut, trees = growth_of(dict(self.params), range(len(self.cols)))
        row = folds.select("fold", F.xxhash64(key, *self.cols).alias("_row"), F.col(label).cast("double").alias("y"), *self.cols)
        data = Binned(row, self.cols, "_row", "y", "fold")
        try:
            found = held_out_scores(data, [Job(growth, cut, trees, tuple(range(k)))], seed)
            own = row.select("fold", F.xxhash64("_row").alias("hash"), "y").join(found, ["fold", "hash", "y"])
            right = ((F.col("score") > 0.5).cast("double") == F.col("y")).cast("double")
            rows = {r["fold"]: r["accuracy"] for r in own.groupBy("fold").agg(F.avg(right).alias("accuracy")).collect()}  # one row per fold
        finally:
            data.unpersist()
        return folds.sparkSession.createDataFrame([(i, rows.get(i)) for i in range(k)], "fold int, accuracy double")


def fit_regressor(
    df: DataFrame, kind: str, cols: Sequence[str], target: str, trees: int = 120, seed: int = SEED, depth: int = MAX_DEPTH
) -> PipelineModel:
    """``linear`` (least squares) or ``rf``."""
    stage = VectorAssembler(inputCols=list(cols), outputCol="features")
    if kind == "linear":
        model = LinearRegression(labelCol=target, featuresCol="features", regParam=0.0, solver="normal")
    elif kind == "rf":
        model = RandomForestRegressor(labelCol=target, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    else:
        raise ValueError(f"unknown model {kind!r}: use 'linear' or 'rf'")
    return PipelineModel([stage, model.fit(stage.transform(df))])


def score(model: Transformer, df: DataFrame, name: str = "conversion_score") -> DataFrame:
    """P(class 1) and the predicted class of every row."""
    out = model.transform(df)
    keep = [c for c in out.columns if c in df.columns]
    both = F.col("probability") if isinstance(out.schema["probability"].dataType, ArrayType) else vector_to_array("probability")
    return out.select(*keep, both[1].alias(name), F.col("prediction").cast("int").alias("prediction"))


def predict(model: Transformer, df: DataFrame) -> DataFrame:
    """Regression result as ``prediction``."""
    out = model.transform(df)
    return out.select(*df.columns, "prediction")


def predict_conversion(
    model: ConversionModel, records: DataFrame, threshold: float = DEFAULT_THRESHOLD, key: str = ID_COL
) -> DataFrame:
    """(key, conversion_score, is_target) for records with any subset of the features; also on streams."""
    ready = prepare_features(records, model.defaults, [key])
    scored = score(model.pipeline, ready).select(key, "conversion_score")
    return scored.withColumn("is_target", F.col("conversion_score") >= threshold)


def cross_val(
    df: DataFrame,
    fit: Callable[[DataFrame], Transformer],
    k: int,
    key: str = ID_COL,
    label: str = "label",
    seed: int = SEED,
    width: int = 8,
) -> DataFrame:
    """(fold, accuracy) of each held-out fold, up to ``width`` of them side by side; keep ``df`` persisted.

    The forests of a ``ForestFit`` are jobs on one binned table.
    """
    folds = with_fold(df, key, k, seed, label)
    if isinstance(fit, ForestFit):
        return fit.fold_accuracy(folds, k, key, label, seed)

    def one(i: int) -> Callable[[], tuple[int, float]]:
        def run() -> tuple[int, float]:
            model = fit(folds.filter(F.col("fold") != i))
            held = score(model, folds.filter(F.col("fold") == i))
            return i, metrics.accuracy(held, label, "prediction").first()["accuracy"]

        return run

    return df.sparkSession.createDataFrame(in_parallel([one(i) for i in range(k)], width), "fold int, accuracy double")


def fold_summary(folds: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Mean and population deviation over the folds."""
    return folds.agg(F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"), F.count("*").alias("folds"))
