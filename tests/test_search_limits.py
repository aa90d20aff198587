"""What searches and the training job do no more than once: nodes that pruning takes, copies of rows, codes and scores."""

import math
import threading

import numpy as np
import pytest
from pyspark.ml import Transformer
from pyspark.sql import functions as F

from campaign_engine.catalog import models
from campaign_engine.operators import order_stats, prep, shared_forest, supervised
from campaign_engine.operators.tree_growth import Cut, Growth, cut_values, grow, growth_of, leaves, sample_weights
from campaign_engine.plans import training


def _table(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 255, (n, 5)).astype(np.uint8)
    x[:, 4] = rng.integers(0, 3, n)
    y = (rng.random(n) < np.where(x[:, 0] > 100, 0.3, 0.6)).astype(float)
    return x, y, rng.integers(-(2**62), 2**62, n)


@pytest.mark.parametrize("criterion,weight,least", [("gini", None, 1), ("gini", "balanced_subsample", 3), ("entropy", None, 1), ("squares", None, 2)])
def test_nodes_that_pruning_takes_are_not_split(criterion, weight, least):
    x, y, h = _table(3000, 4)
    y = y + x[:, 1] / 300 if criterion == "squares" else y
    growth, trees = Growth((0, 1, 2, 3, 4), 3, least, criterion, weight), np.arange(4)
    weights = growth.weights(h, trees, 7)
    own = sample_weights(growth, y, weights)
    whole = grow(x, y, weights, growth.roots(trees, 7), growth, own)
    cuts = [Cut(None, 2, 0.004), Cut(9, 5, 0.001)]
    short = grow(x, y, weights, growth.roots(trees, 7), growth, own, **shared_forest._reach(cuts))
    assert len(short.feature) < 0.9 * len(whole.feature)
    for cut in cuts:
        found = [cut_values(t, cut, criterion)[leaves(t.feature, t.bin, t.left, trees, x)] for t in (whole, short)]
        assert np.array_equal(*found)


@pytest.mark.parametrize("criterion,least", [("gini", 1), ("gini", 4), ("entropy", 1)])
def test_best_cut_is_that_of_all_cuts(criterion, least):
    """Of a root, worked out cut by cut; bins of one class alone are in it."""
    rng = np.random.default_rng(9)
    for n in (4, 7, 12, 40):
        x, y = rng.integers(0, 12, (n, 1)).astype(np.uint8), (rng.random(n) < 0.4).astype(float)
        x[:, 0] = np.where(y > 0, x[:, 0] // 2 * 2, x[:, 0])
        growth = Growth((0,), 1, least, criterion, None, 1.0, False)
        tree = grow(x, y, np.ones((1, n), np.int64), growth.roots(np.array([0]), 1), growth, max_depth=1)

        def loss(part):
            p = part.mean()
            return 0.0 if p in (0, 1) else len(part) * (2 * p * (1 - p) if criterion == "gini" else -p * math.log2(p) - (1 - p) * math.log2(1 - p))

        losses = {b: loss(y[x[:, 0] <= b]) + loss(y[x[:, 0] > b]) for b in range(12)
                  if min((x[:, 0] <= b).sum(), (x[:, 0] > b).sum()) >= least and (x[:, 0] == b).any()}
        if not losses or len(set(y)) == 1:
            assert tree.feature[0] == -1
            continue
        best = min(b for b, v in losses.items() if v <= min(losses.values()) + 1e-9)
        assert (tree.feature[0], tree.bin[0]) == (0, best)
        assert tree.rows.tolist() == [n, (x[:, 0] <= best).sum(), (x[:, 0] > best).sum()]


def test_many_rows_are_dealt_to_fewer_tasks(spark, monkeypatch):
    frame = spark.range(4000).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("label"),
                                     (F.col("id") % 2).cast("int").alias("fold"))
    data = shared_forest.Binned(frame, ["a"], "id", "label", "fold")
    job = [shared_forest.Job(*growth_of({"n_estimators": 64, "max_depth": 3}, range(1)), (0, 1))]
    try:
        pieces = {}
        for most in (10**6, 4000):
            monkeypatch.setattr(shared_forest, "COPIED_ROWS", most)
            found = shared_forest._local_pieces(data, job, 1, shared_forest.BLOCK, 2)
            pieces[most] = found.count(), found.agg(F.sum("trees")).first()[0]
    finally:
        data.unpersist()
    assert pieces == {10**6: (8, 128), 4000: (2, 128)}


def test_shares_follow_the_levels_of_trees():
    deep, flat = Growth((0, 1, 2), 1), Growth((0, 1, 2), 1, 2)
    wanted = [shared_forest._Wanted(0, 0, 60, ()), shared_forest._Wanted(1, 0, 60, ())]
    levels = [shared_forest._levels(deep, [Cut()], 50_000), shared_forest._levels(flat, [Cut(4)], 50_000)]
    assert levels[0] > 15 and levels[1] == 4
    shares = shared_forest._shares(wanted, [deep, flat], 6, levels)
    work = [sum((end - first) * levels[i] for i, first, end in s) for s in shares]
    assert max(work) - min(work) <= 2 * max(levels)


def test_all_folds_are_fitted_side_by_side(spark):
    data = spark.range(60).select(F.concat(F.lit("C-"), "id").alias("client_id"), (F.col("id") % 3).cast("double").alias("a"),
                                  (F.col("id") % 2).cast("double").alias("label")).persist()
    meeting = threading.Barrier(5, timeout=60)

    def fit(train):
        meeting.wait()
        return supervised.fit_classifier(train, "rf", ["a"], {"n_estimators": 1, "max_depth": 2})

    assert supervised.cross_val(data, fit, 5).count() == 5


def test_a_coded_table_with_its_label_is_not_labelled_again(spark, monkeypatch, tmp_path):
    rows = [(f"C-{i}", float(i % 7), float(i * 5 % 11), float(i % 4 == 0), "Annual" if i % 4 == 0 else "Monthly") for i in range(200)]
    coded = spark.createDataFrame([r[:4] for r in rows], "client_id string, total_spent double, total_visits double, label double")
    clean = spark.createDataFrame([(r[0], r[4]) for r in rows], "client_id string, subscription_type string")
    settings = {"Random Forest": ("rf", {"n_estimators": 3, "max_depth": 3}), "Regresión Logística": ("lr", {})}
    want = [tuple(r) for r in training.train(clean, coded.drop("label"), settings, fit_rows=100).metrics.orderBy("model").collect()]
    monkeypatch.setattr(training, "labelled", None)
    job = training.train(clean, coded, settings, fit_rows=100)
    job.write(str(tmp_path))
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/metrics").orderBy("model").collect()]
    assert got == want and not job.held_out.is_cached
    assert spark.read.parquet(f"{tmp_path}/campaign_scores").count() == 200


def test_each_customer_is_scored_once(spark):
    met = spark.sparkContext.accumulator(0)

    class Counting(Transformer):
        def _transform(self, df):
            def chance(a):
                met.add(1)
                return [1 - a / 200, a / 200]

            return df.withColumns({"probability": F.udf(chance, "array<double>")("a"), "prediction": F.lit(0.0)})

    coded = spark.createDataFrame([(f"C-{i}", float(i), i % 2) for i in range(200)], "client_id string, a double, gender int")
    clean = spark.createDataFrame([(f"C-{i}", "f" if i % 2 else "m") for i in range(200)], "client_id string, gender string")
    rows = training.campaign_scores(supervised.ConversionModel(Counting(), {"a": 0.0}), coded, clean).collect()
    assert met.value == 200
    want = [(f"C-{i}", "f" if i % 2 else "m", i / 200, (i + 1) / 200 * 100) for i in range(200)]
    got = [(r["client_id"], r["gender"], r["conversion_score"], r["score_percentil"]) for r in rows]
    assert sorted(got) == sorted(want)


def test_a_fit_passes_the_table_behind_its_sample_once(spark):
    met = spark.sparkContext.accumulator(0)

    def count(i):
        met.add(1)
        return float(i % 2)

    df = spark.range(4_000).select(F.concat(F.lit("C-"), "id").alias("client_id"), F.udf(count, "double")("id").alias("label"), "id")
    data = df.select("client_id", "label", F.col("id").cast("double").alias("a"))
    sample = models.to_fit(data)
    supervised.fit_classifier(sample, "rf", ["a"], {"n_estimators": 2, "max_depth": 2})
    assert met.value == 4_000 and sample.count() == models.FIT_ROWS


def test_cuts_of_many_hashes_are_narrowed_before_one_buffer_holds_them(spark, monkeypatch):
    data = spark.range(240_000).select(F.concat(F.lit("C-"), "id").alias("client_id"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    whole = prep.with_split(data, "client_id", 0.2, stratify="label", limit=1_000_000)
    held, narrow = [], order_stats._narrow
    monkeypatch.setattr(order_stats, "_narrow", lambda df, asks: (narrow(df, asks), held.extend(a.inside for a in asks)))
    split = prep.with_split(data, "client_id", 0.2, stratify="label")
    # the class of 160,000 rows is narrowed, that of 80,000 fits a buffer
    assert len(held) == 2 and max(held) < 1_000
    sizes = split.filter("is_test").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in sizes} == {0.0: 32_000, 1.0: 16_000}
    assert split.join(whole.withColumnRenamed("is_test", "was"), "client_id").filter("is_test <> was").isEmpty()
