"""Kept forests that learn all rows: fitting, scoring, saving, streams, and the queries that use them."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from campaign_engine.catalog import models
from campaign_engine.operators import kept_forest, prep, shared_forest, supervised
from campaign_engine.operators.tree_growth import grow, growth_of, leaves
from campaign_engine.plans import training
from campaign_engine.schemas import TARGET_COL
from campaign_engine.streaming.score_stream import read_records, score_stream

COLS = ["a", "b", "noise"]


@pytest.fixture(scope="module")
def data(spark):
    """400 rows whose label follows two of three features; some features are missing."""
    rng = np.random.default_rng(11)
    a, b, noise = rng.normal(size=(3, 400))
    rows = [(f"C-{i:05d}", float(a[i]), float(b[i]), float(noise[i]) if i % 9 else None, float(a[i] + b[i] > 0)) for i in range(400)]
    return spark.createDataFrame(rows, "client_id string, a double, b double, noise double, label double").repartition(5).persist()


def scores_of(model, df):
    return {r["client_id"]: r["conversion_score"] for r in supervised.score(model, df).collect()}


def test_scores_are_means_over_trees_of_all_rows(data, monkeypatch):
    params = {"n_estimators": 9, "min_samples_leaf": 2}
    got = scores_of(kept_forest.fit_forest(data, COLS, params), data)
    folded = shared_forest.Binned(data.withColumn("fold", F.lit(0)), COLS, "client_id", "label", "fold")
    rows = data.select("client_id", F.xxhash64("client_id").alias("h"), "label", *COLS).collect()
    x = np.array([[np.searchsorted(e, -np.inf if r[c] is None else r[c], "left") for c, e in zip(COLS, folded.edges)] for r in rows], np.uint8)
    y, h = np.array([r["label"] for r in rows]), np.array([r["h"] for r in rows])
    growth, _, trees = growth_of(params, range(3))
    number = np.arange(trees)
    grown = grow(x, y, growth.weights(h, number, 42), growth.roots(number, 42), growth)
    want = grown.values()[leaves(grown.feature, grown.bin, grown.left, number, x)].mean(axis=0)
    assert [got[r["client_id"]] for r in rows] == pytest.approx(list(want), abs=1e-6) and folded.rows == 400
    monkeypatch.setattr(kept_forest, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(kept_forest, "Binned", lambda *a: shared_forest.Binned(*a, 60))  # upper nodes are split by Spark
    again = scores_of(kept_forest.fit_forest(data, COLS, params), data)
    assert again == pytest.approx(got, abs=1e-6)


def test_kept_forests_are_saved_and_score_streams(spark, data, tmp_path):
    model = supervised.ConversionModel(kept_forest.fit_forest(data, COLS, {"n_estimators": 5}), prep.feature_defaults(data, COLS))
    want = sorted(supervised.predict_conversion(model, data.drop("noise")).collect())
    model.save(str(tmp_path / "model"))
    model.save(str(tmp_path / "model"))  # over the first one
    loaded = supervised.ConversionModel.load(spark, str(tmp_path / "model"))
    assert isinstance(PipelineModel.load(str(tmp_path / "model/pipeline")).stages[0], kept_forest.KeptForest)
    assert sorted(supervised.predict_conversion(loaded, data.drop("noise")).collect()) == want
    data.select("client_id", "a", "b").write.parquet(str(tmp_path / "in"))
    stream = read_records(spark, str(tmp_path / "in"), data.select("client_id", "a", "b").schema)
    score_stream(loaded, stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == want
    assert supervised.score(model.pipeline, data.limit(0)).count() == 0
    with pytest.raises(ValueError, match="labelled rows"):
        kept_forest.fit_forest(data.limit(0), COLS)


@pytest.fixture
def learnt(data, monkeypatch):
    """Rows that each forest learns while queries run on ``data`` with a small ``FIT_ROWS``."""
    found, real = [], shared_forest.Binned
    for place in (kept_forest, supervised):
        monkeypatch.setattr(place, "Binned", lambda *a: found.append(real(*a)) or found[-1])
    clean = data.select("client_id", F.when(F.col("label") == 1, "Annual").otherwise("Monthly").alias(TARGET_COL))
    whole = data.fillna(0.0).withColumn("total_spent", F.col("a"))
    monkeypatch.setattr(models, "coded", lambda *_: whole)
    monkeypatch.setattr(models, "training_tables", lambda *_: (clean, whole))
    monkeypatch.setattr(models, "profile", lambda *_: whole)
    monkeypatch.setattr(models, "BEHAVIOUR_COLS", ["a", "b"])
    monkeypatch.setattr(models, "FIT_ROWS", 40)
    monkeypatch.setattr(training, "CLASSIFIERS", {"Random Forest": ("rf", {"n_estimators": 6}), "Regresión Logística": ("lr", {})})
    return found


def test_campaign_scores_learn_the_whole_training_part(spark, learnt):
    rows = models._campaign_scores(spark, "").collect()
    assert [b.rows for b in learnt] == [320] and len(rows) == 400 and sum(r["is_train"] for r in rows) == 320
    assert all(0 <= r["conversion_score"] <= 1 for r in rows) and len({r["conversion_score"] for r in rows}) > 3


def test_cross_validation_learns_and_scores_every_row(spark, data, learnt):
    rows = models._cv_accuracy(spark, "").collect()
    assert [b.rows for b in learnt] == [400] and [r["fold"] for r in rows] == [0, 1, 2, 3, 4]
    assert all(r["accuracy"] > 0.85 for r in rows)


def test_rows_that_repeat_a_key_have_their_own_scores_in_cross_validation(spark):
    """Of each pair under one key and label, one row follows its feature and one doesn't."""
    rows = [(f"C-{i}", float(i % 2 * 2 - 1), float(i % 2)) for i in range(200)] + [(f"D-{i}", v, 1.0) for i in range(30) for v in (-1.0, 1.0)]
    df = spark.createDataFrame(rows * 2, "client_id string, a double, label double")  # and every row comes twice
    want = {
        r["fold"]: r["right"]
        for r in prep.with_fold(df, "client_id", 3, stratify="label").groupBy("fold").agg(
            F.avg(((F.col("a") > 0).cast("double") == F.col("label")).cast("double")).alias("right")
        ).collect()
    }
    found = supervised.cross_val(df, supervised.ForestFit(["a"], {"n_estimators": 5}), 3).collect()
    assert {r["fold"]: r["accuracy"] for r in found} == pytest.approx(want) and min(want.values()) < 0.97


def test_training_job_learns_the_whole_training_part(spark, learnt):
    rows = models._training_job(spark, "").collect()
    assert [b.rows for b in learnt] == [320] and {r["model"] for r in rows} == set(training.CLASSIFIERS)
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == 80 and r["roc_auc"] > 0.9 for r in rows)
