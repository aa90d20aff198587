"""Splits, clustering, models, tuning, scoring."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from campaign_engine.operators import cluster, lloyd, logistic, metrics, prep, supervised, tune
from campaign_engine.operators.features import ENGINEERED_COLS, add_engineered_features, screening_sets, search_sets
from campaign_engine.plans.training import campaign_scores, train_regressors
from campaign_engine.schemas import NUMERIC_COLS
from campaign_engine.streaming.score_stream import read_records, score_stream

SMALL = {"n_estimators": 8, "max_depth": 4}


@pytest.fixture(scope="module")
def data(spark):
    """400 rows whose label follows two of three features."""
    rng = np.random.default_rng(7)
    a, b, noise = rng.normal(size=400), rng.normal(size=400), rng.normal(size=400)
    rows = [(f"C-{i:05d}", float(a[i]), float(b[i]), float(noise[i]), float(a[i] + b[i] > 0)) for i in range(400)]
    return spark.createDataFrame(rows, "client_id string, a double, b double, noise double, label double").persist()


def test_split_is_exact_disjoint_and_repeatable(data):
    train, test = prep.split(data, "client_id", 0.2, stratify="label")
    assert train.count() + test.count() == 400 and train.join(test, "client_id").count() == 0
    sizes = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    assert {r["label"]: r["count"] for r in test.groupBy("label").count().collect()} == {
        y: round(n * 0.2) for y, n in sizes.items()
    }
    again = prep.split(data.repartition(5), "client_id", 0.2, stratify="label")[1]
    assert again.exceptAll(test).count() == 0
    rough = prep.split(data, "client_id", 0.2, exact=False)[1].count()
    assert 50 < rough < 110


def test_folds_are_even(data):
    folds = prep.with_fold(data, "client_id", 4, stratify="label").groupBy("label", "fold").count().collect()
    for y in (0.0, 1.0):
        counts = [r["count"] for r in folds if r["label"] == y]
        assert len(counts) == 4 and max(counts) - min(counts) <= 1


def test_standardize_uses_population_deviation(data):
    out = prep.standardize(data.withColumn("flat", F.lit(3.0)), ["a", "flat"])
    mean, deviation, flat = out.agg(F.avg("a"), F.stddev_pop("a"), F.max("flat")).first()
    assert mean == pytest.approx(0) and deviation == pytest.approx(1) and flat == 0.0


@pytest.mark.parametrize("kind,params", [("rf", SMALL), ("lr", {"max_iter": 100})])
def test_classifiers_learn_and_repeat(data, kind, params):
    train, test = prep.split(data, "client_id", 0.2, stratify="label")
    runs = []
    for _ in range(2):
        model = supervised.fit_classifier(train, kind, ["a", "b", "noise"], params)
        scored = supervised.score(model, test)
        runs.append(sorted((r["client_id"], r["conversion_score"]) for r in scored.collect()))
    assert runs[0] == runs[1] and all(0 <= s <= 1 for _, s in runs[0])
    assert metrics.roc_auc(scored, "label", "conversion_score").first()[0] > 0.85
    with pytest.raises(ValueError):
        supervised.fit_classifier(train, "svm", ["a"])


def test_cross_validation(data):
    folds = supervised.cross_val(data, lambda t: supervised.fit_classifier(t, "rf", ["a", "b"], SMALL), 3)
    summary = supervised.fold_summary(folds).first()
    assert summary["folds"] == 3 and summary["mean"] > 0.8


def test_search_spaces():
    sizes = {n: len(tune.grid_combinations(tune.SPACES[n])) for n in ("v1", "v2", "v3", "v3_fast")}
    assert sizes == {"v1": 288, "v2": 144, "v3": 96, "v3_fast": 32}
    draws = tune.random_combinations(tune.SPACES["v4"], 30)
    assert len({str(d) for d in draws}) == 30 and draws == tune.random_combinations(tune.SPACES["v4"], 30)


def test_forest_mapping():
    spec = supervised.forest({
        "n_estimators": 9, "max_depth": None, "max_features": 0.5, "criterion": "log_loss", "max_samples": None,
        "class_weight": "balanced", "ccp_alpha": 0.1, "min_samples_split": 4,
    })
    assert spec.settings == {
        "numTrees": 9, "maxDepth": 30, "minInstancesPerNode": 1, "featureSubsetStrategy": "0.5", "impurity": "entropy",
        "subsamplingRate": 1.0, "bootstrap": True,
    }
    assert spec.weighted and spec.ignored == {"ccp_alpha": 0.1, "min_samples_split": 4}


def test_tune_picks_by_the_wanted_metric(data):
    combos = [{**SMALL, "max_depth": 1}, {**SMALL, "class_weight": "balanced"}]
    best, results = tune.tune(data, ["a", "b"], combos, 2, "avg_precision")
    rows = results.collect()
    assert len(rows) == 2 and rows[0]["avg_precision"] >= rows[1]["avg_precision"]
    assert f"max_depth={best['max_depth']}" in rows[0]["params"]


def test_candidates_count_only_by_what_they_say(data):
    """Parameters that once had no effect have one now, and equal forests get equal results."""
    base = {"n_estimators": 6, "max_features": None}
    combos = [base, {**base, "min_samples_split": 60}, {**base, "ccp_alpha": 0.02}, {**base, "max_depth": None}, {**base, "class_weight": "balanced_subsample"}]
    _, results = tune.tune(data, ["a", "b", "noise"], combos, 2)
    rows = {r["candidate"]: r for r in results.collect()}
    assert len(rows) == 5 and rows[0]["roc_auc"] == rows[3]["roc_auc"]
    assert len({round(rows[i]["roc_auc"], 12) for i in (0, 1, 2, 4)}) == 4
    assert all(0.8 < r["roc_auc"] <= 1 and r["roc_auc_std"] >= 0 for r in rows.values())


def test_searches_score_every_row_of_every_fold(spark, data, monkeypatch):
    from campaign_engine.catalog import models

    scored = []
    real = tune.held_out_scores
    monkeypatch.setattr(tune, "held_out_scores", lambda *a: scored.append(real(*a)) or scored[-1])
    monkeypatch.setattr(models, "coded", lambda *_: data)
    monkeypatch.setattr(models, "BEHAVIOUR_COLS", ["a", "b"])
    monkeypatch.setattr(models, "FIT_ROWS", 40)
    monkeypatch.setitem(tune.SPACES, "light", {"n_estimators": [3], "max_depth": [2, 3]})
    assert models._search("light")(spark, "").count() == 2
    kept = tune.Binned(prep.with_fold(data, "client_id", 2, stratify="label"), ["a", "b"], "client_id", "label", "fold")
    assert kept.rows == 400
    job = tune._job(kept, ["a", "b"], {"n_estimators": 3}, [0, 1])
    assert real(kept, [job]).groupBy("hash").count().filter("count = 1").count() == 400
    train, test = prep.split(data, "client_id", 0.2, stratify="label")
    table, detail = tune.compare_versions(train, test, {"v": (["a", "b"], "label")}, [{**SMALL, "max_depth": 1}, SMALL])
    row = table.first()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == 80 and row["roc_auc"] > 0.8 and detail.count() == 5


def test_registered_searches_are_all_named_ones():
    from campaign_engine.catalog import load

    names = {f"{mode}_search_{name}" for name, (mode, *_) in tune.SEARCHES.items()}
    assert names <= load()[0].keys() and len(names) == 8 and "deep_tune_top" in load()[0]


def test_screening_prefers_the_informative_set(data):
    train, test = prep.split(data, "client_id", 0.2, stratify="label")
    ranked = tune.screen(train, test, {"noise": ["noise"], "both": ["a", "b"]}, SMALL).collect()
    assert [r["feature_set"] for r in ranked] == ["both", "noise"]


def test_feature_sets():
    assert len(search_sets(NUMERIC_COLS)) == 55 and len(screening_sets(NUMERIC_COLS)) == 5
    assert len(ENGINEERED_COLS) == 10


def test_engineered_features_survive_zero_divisors(spark):
    row = {c: 0.0 for c in NUMERIC_COLS} | {"marketing_spend_per_user": -1.0, "support_tickets": 0.0}
    out = add_engineered_features(spark.createDataFrame([row])).first()
    assert out["marketing_efficiency"] is None and out["friction_free_customer"] == 1
    assert out["estimated_days_since_signup"] == 1.0


def test_clusters_are_ordered_and_scored(spark):
    rows = [(f"C-{i}", float(10 * (i % 3)), float(i % 3) + float(i % 7) / 20) for i in range(90)]
    df = spark.createDataFrame(rows, "client_id string, last_3_month_purchase_freq double, x double")
    _, out = cluster.fit_kmeans(df, ["last_3_month_purchase_freq", "x"], 3, n_init=3)
    means = {r[0]: r[1] for r in out.groupBy("cluster").agg(F.avg("last_3_month_purchase_freq")).collect()}
    assert means[0] > means[1] > means[2]
    # Silhouette against all pairs, on this small table only.
    pdf = out.select("cluster", "features").toPandas()
    x, y = np.array([v.toArray() for v in pdf.features]), pdf.cluster.to_numpy()
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = d[i][(y == y[i])].sum() / ((y == y[i]).sum() - 1)
        other = min(d[i][y == c].mean() for c in set(y) - {y[i]})
        s.append((other - own) / max(own, other))
    assert cluster.silhouette(out) == pytest.approx(np.mean(s))
    elbow = cluster.elbow(df, ["last_3_month_purchase_freq", "x"], (2, 3), n_init=2).orderBy("k").collect()
    assert elbow[0]["inertia"] > elbow[1]["inertia"]


def test_pca_like_numpy(data):
    points, explained = cluster.pca(data, ["a", "b", "noise"])
    x = np.array([tuple(r)[1:4] for r in data.orderBy("client_id").collect()])
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    top = np.argsort(values)[::-1][:2]
    want = z @ vectors[:, top]
    got = np.array([(r["pc1"], r["pc2"]) for r in points.orderBy("client_id").collect()])
    for j in range(2):
        v = vectors[:, top[j]]
        sign = np.sign(v[np.abs(v).argmax()])
        assert got[:, j] == pytest.approx(sign * want[:, j], abs=1e-6)
    assert [r["explained"] for r in explained.orderBy("component").collect()] == pytest.approx(values[top] / values.sum())


def test_regressors_leave_out_derived_columns(spark):
    rows = [(f"C-{i:05d}", float(i), float(i) / 900, float(i * 3 % 17)) for i in range(120)]
    df = spark.createDataFrame(rows, "client_id string, total_spent double, total_spent_usd double, x double")
    assert prep.feature_names(df, "total_spent") == ["x"]
    out = train_regressors(df, trees=5, depth=3).collect()
    assert len(out) == 2 and all(r["r2"] < 0.9 for r in out)


def test_registered_regressors_learn_the_whole_training_part(spark, data, monkeypatch):
    from campaign_engine.catalog import models
    from campaign_engine.plans import training

    learnt = []
    real = training.Binned
    monkeypatch.setattr(training, "Binned", lambda df, *a: learnt.append(df.filter("fold = 1").count()) or real(df, *a))
    monkeypatch.setattr(models, "coded", lambda *_: data.withColumn("total_spent", F.col("a")))
    monkeypatch.setattr(models, "FIT_ROWS", 40)
    rows = models._rf_regressor(spark, "").collect()
    assert len(rows) == 80
    errors = [(r["prediction"] - r["total_spent"]) ** 2 for r in rows]
    mean = sum(r["total_spent"] for r in rows) / 80
    assert sum(errors) < 0.2 * sum((r["total_spent"] - mean) ** 2 for r in rows)
    models._regression_compare(spark, "")
    assert learnt == [320] * 2


@pytest.fixture(scope="module")
def model(data):
    fitted = supervised.fit_classifier(data, "rf", ["a", "b", "noise"], SMALL)
    return supervised.ConversionModel(fitted, prep.feature_defaults(data, ["a", "b", "noise"]))


def test_ragged_records(spark, data, model, tmp_path):
    records = spark.createDataFrame([("r1", " 1.5 ", None), ("r2", "abc", 2.0), ("r3", None, float("nan"))],
                                    "client_id string, b string, noise double")
    got = supervised.predict_conversion(model, records, 0.0)
    assert got.columns == ["client_id", "conversion_score", "is_target"] and got.count() == 3
    assert all(r["is_target"] for r in got.collect())
    model.save(str(tmp_path / "model"))
    loaded = supervised.ConversionModel.load(spark, str(tmp_path / "model"))
    assert loaded.defaults == model.defaults
    assert sorted(supervised.predict_conversion(loaded, records).collect()) == sorted(
        supervised.predict_conversion(model, records).collect()
    )


def test_stream_scores_like_batch(spark, data, model, tmp_path):
    records = data.select("client_id", "a", "b")
    records.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = read_records(spark, str(tmp_path / "in"), records.schema)
    score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.collect()) == sorted(supervised.predict_conversion(model, records).collect())


def test_campaign_scores_have_readable_labels(spark, data, model):
    coded = data.withColumn("gender", F.lit(0))
    clean = data.select("client_id", F.lit("Male").alias("gender"))
    out = campaign_scores(model, coded, clean)
    row = out.agg(F.min("gender"), F.max("score_percentil"), F.count_if("is_train"), F.count("*")).first()
    assert row[0] == "Male" and row[1] <= 100 and row[2] == 320 and row[3] == 400


def plain_logistic(x, y, c=1.0):
    """Newton's method on standardized columns, all at once."""
    z = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)])
    ridge = np.array([0.0] + [1 / c] * x.shape[1])
    point = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-z @ point))
        point -= np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * point)
    return point


def fitted_line(df, cols, c=1.0):
    return logistic.fit(df, cols, prep.moments(df, cols), c=c)


def test_logistic_equals_plain_newton_for_any_partitioning(data, tmp_path):
    cols = ["a", "b", "noise"]
    rows = np.array([[r[c] for c in (*cols, "label")] for r in data.collect()])
    for c in (0.01, 1.0, 1e6):  # separable classes: without much penalty the weights grow large
        line = fitted_line(data.repartition(7).withColumn("_p", F.lit("clash")).drop("_p"), cols, c)
        want = plain_logistic(rows[:, :3], rows[:, 3], c) if c < 1e6 else None
        if want is not None:
            assert [line.intercept, *line.weights] == pytest.approx(list(want), rel=1e-6, abs=1e-7)
            assert line.steps < 30
        slopes = logistic.gradient(data, line, c=c).collect()
        assert [r["term"] for r in slopes] == ["intercept", *cols] and all(abs(r["gradient"]) < 1e-8 for r in slopes)
    skewed = data.unionAll(data.filter("label = 1").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy"))
    again = np.array([[r[c] for c in (*cols, "label")] for r in skewed.collect()])
    assert [fitted_line(skewed, cols).intercept] == pytest.approx([plain_logistic(again[:, :3], again[:, 3])[0]], rel=1e-6)
    model = supervised.fit_classifier(data, "lr", cols)
    model.write().overwrite().save(str(tmp_path / "lr"))
    loaded = supervised.score(PipelineModel.load(str(tmp_path / "lr")), data)
    assert loaded.columns == [*data.columns, "conversion_score", "prediction"]
    assert loaded.exceptAll(supervised.score(model, data)).count() == 0


def test_logistic_on_odd_tables(spark, data):
    flat = data.withColumn("b", F.lit(2.0))
    line = fitted_line(flat, ["a", "b"])
    assert line.weights[1] == 0.0 and line.weights[0] > 0
    empty = fitted_line(data.limit(0), ["a", "b"])
    assert (empty.intercept, empty.weights) == (0.0, [0.0, 0.0])
    one = supervised.score(supervised.fit_classifier(data.filter("label = 1"), "lr", ["a"]), data)
    assert one.filter("conversion_score < 0.999 OR prediction = 0").count() == 0
    for bad in (None, float("nan"), float("inf")):
        broken = data.withColumn("a", F.when(F.col("client_id") == "C-00003", F.lit(bad)).otherwise(F.col("a")))
        with pytest.raises(ValueError, match="known, finite"):
            logistic.fit(broken, ["a"], {"a": (0.0, 1.0)})


def vectors_of(spark, x, parts=3):
    rows = [(f"C-{i:05d}", *map(float, v)) for i, v in enumerate(x)]
    names = ["client_id", *[f"x{j}" for j in range(len(x[0]))]]
    return prep.assemble(spark.createDataFrame(rows, names).repartition(parts), names[1:])


def test_shared_starts_equal_plain_lloyd(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(m, 0.6, (60, 2)) for m in ((0, 0), (3, 0), (0, 3))] + [np.full((200, 2), 3.0)])  # one hot vector
    vectors = vectors_of(spark, x).persist()
    sample = np.array([r["features"].toArray() for r in prep.fit_sample(vectors, "client_id", 5_000).collect()])

    def plain(k, seed):
        c = lloyd.first_centres(sample, k, seed)
        for _ in range(300):
            near = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
            c = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
        return ((x[:, None] - c) ** 2).sum(-1).min(1).sum(), c

    passes = []
    real = lloyd._pass
    monkeypatch.setattr(lloyd, "_pass", lambda rows, sets: passes.append(len(sets)) or real(rows, sets))
    found = lloyd.cluster_all(vectors, [2, 4], 5, 6, "client_id")
    assert passes[0] == 12 and sorted(passes[: passes.index(2)], reverse=True) == passes[: passes.index(2)]
    for k in (2, 4):
        best = min((plain(k, 5 + i) for i in range(6)), key=lambda r: r[0])
        assert found[k].cost == pytest.approx(best[0], rel=1e-3)
        labels = np.array([r["_cluster"] for r in found[k].transform(vectors).orderBy("client_id").collect()])
        means = np.array([x[labels == j].mean(0) for j in range(k)])
        assert means == pytest.approx(found[k].centres, abs=1e-8)
        assert (((x[:, None] - means) ** 2).sum(-1).argmin(1) == labels).all()
        assert found[k].cost == pytest.approx(((x - means[labels]) ** 2).sum())
    other = lloyd.cluster_all(vectors.repartition(7), [2, 4], 5, 6, "client_id")
    assert all(other[k].centres == pytest.approx(found[k].centres, abs=1e-8) for k in (2, 4))


def test_clusters_of_odd_tables(spark):
    vectors = vectors_of(spark, np.repeat([[1.0, 2.0], [5.0, 5.0]], 10, axis=0))
    found = lloyd.cluster_all(vectors, [4], 1, 2, "client_id")[4]
    assert found.cost == 0.0 and found.transform(vectors).select("_cluster").distinct().count() == 2
    assert lloyd.cluster_all(vectors.limit(0), [3], 1, 2, "client_id")[3].transform(vectors).filter("_cluster IS NOT NULL").count() == 0
    names = "client_id string, last_3_month_purchase_freq double, x double"
    _, out = cluster.fit_kmeans(spark.createDataFrame([("C-1", None, 1.0)], names), ["last_3_month_purchase_freq", "x"], 3)
    assert out.count() == 0 and "cluster" in out.columns


def test_plain_silhouette_is_exact_on_small_tables_and_near_on_samples(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(m, 1.0, (150, 2)) for m in ((0, 0), (4, 0))] + [np.array([[9.0, 9.0]])])
    label = F.when(F.col("x0") > 8, "alone").when(F.col("x0") > 2, "right").otherwise("left")
    vectors = vectors_of(spark, x).withColumn("cluster", label)
    y = np.where(x[:, 0] > 8, 2, np.where(x[:, 0] > 2, 1, 0))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        n_own = (y == y[i]).sum()
        own = d[i][y == y[i]].sum() / max(n_own - 1, 1)
        other = min(d[i][y == c].mean() for c in set(y) - {y[i]})
        s.append(0.0 if n_own == 1 else (other - own) / max(own, other))
    whole = cluster.silhouette_euclidean(vectors).first()
    assert whole["silhouette"] == pytest.approx(np.mean(s)) and whole["error"] == 0.0 and whole["n_sampled"] == 301
    part = cluster.silhouette_euclidean(vectors, sample_rows=100).first()
    assert part["n_sampled"] == 100 and 0 < part["error"] and abs(part["silhouette"] - np.mean(s)) < 4 * part["error"]
    single = cluster.silhouette_euclidean(vectors.filter("cluster = 'left'")).first()
    assert single["silhouette"] is None and single["n"] == (y == 0).sum()
    nothing = cluster.silhouette_euclidean(vectors.withColumn("cluster", F.lit(None).cast("string"))).first()
    assert nothing["silhouette"] is None and nothing["n"] == 0
