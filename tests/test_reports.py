"""Quality, profiling, campaign and metric edge cases."""

import pytest
from pyspark.sql import functions as F

from campaign_engine.operators import aggregate, campaign, localize, metrics, quality
from campaign_engine.schemas import Rule, rules_for


@pytest.fixture(scope="module")
def scores(spark):
    rows = [(i, (i * 37 % 11) % 2, round((i * 53 % 17) / 17, 3), float(i)) for i in range(200)]
    return spark.createDataFrame(rows, "client_id int, label int, conversion_score double, total_spent double").persist()


def test_validation_report(spark):
    df = spark.createDataFrame([("5", "x", 1), ("abc", None, 1), ("200", "y", 1)], "age string, kind string, other int")
    rules = {
        "age": Rule("numeric", True, 0.0, 120.0),
        "kind": Rule("category", False, values=("x",)),
        "gone": Rule("category"),
    }
    report = {(r["column"], r["rule"]): (r["severity"], r["n"]) for r in quality.validate_schema(df, rules).collect()}
    assert report == {
        ("age", "not_numeric"): ("WARNING", 1),
        ("age", "range"): ("WARNING", 1),
        ("kind", "null"): ("ERROR", 1),
        ("kind", "values"): ("WARNING", 1),
        ("gone", "missing"): ("ERROR", 1),
        ("other", "extra"): ("WARNING", 1),
    }
    verdict = quality.verdict(quality.validate_schema(df, rules)).first()
    assert tuple(verdict) == (False, 2, 4)
    valid, rejected = quality.quarantine(df, {"age": rules["age"], "kind": rules["kind"]})
    assert valid.count() == 1 and sorted(len(r["reasons"]) for r in rejected.collect()) == [2, 2]


def test_quality_of_copies_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "b")], "a int, b string")
    row = quality.quality_metrics(df).first()
    assert (row["total_rows"], row["duplicate_rows"], row["null_ratio"]) == (4, 2, 37.5)
    empty = quality.quality_metrics(df.filter("a > 9")).first()
    assert (empty["total_rows"], empty["duplicate_rows"], empty["null_ratio"]) == (0, 0, None)
    assert quality.validate_schema(df.filter("a > 9"), {"a": Rule("numeric")}).filter("rule <> 'extra'").count() == 0


def test_clean_rules_allow_no_nulls():
    assert not any(r.nullable for r in rules_for("clean").values())
    assert len(rules_for("raw")) == 15


def test_histograms_cover_all_rows(scores, spark):
    h = aggregate.histogram(scores, "conversion_score", 30)
    assert h.agg(F.sum("n"), F.count("*")).first() == (200, 30)
    assert aggregate.histogram(scores, "conversion_score", 30, "label").agg(F.sum("n"), F.count("*")).first() == (200, 60)
    flat = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert aggregate.histogram(flat, "x", 4).agg(F.sum("n"), F.min("bin_low"), F.max("bin_high")).first() == (2, 2.5, 3.5)


def test_auc_by_brute_force(scores):
    pdf = scores.toPandas()
    pos, neg = pdf[pdf.label == 1].conversion_score, pdf[pdf.label == 0].conversion_score
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(scores, "label", "conversion_score").first()[0] == pytest.approx(wins)
    mirrored = scores.withColumn("down", -F.col("conversion_score"))
    assert metrics.roc_auc(mirrored, "label", "down").first()[0] == pytest.approx(1 - wins)


def test_one_class_gives_null_or_zero(scores):
    ones = scores.filter("label = 1")
    assert metrics.roc_auc(ones, "label", "conversion_score").first()[0] is None
    report = metrics.report_at(ones, "label", "conversion_score", 2.0).collect()
    assert all(r["precision"] == 0.0 for r in report if r["class"] == "0")
    none = scores.filter("label = 7")
    assert tuple(metrics.ranking_metrics(none, "label", "conversion_score").first()) == (None, None)
    assert metrics.best_f1(none, "label", "conversion_score").count() == 0
    assert tuple(campaign.campaign_kpis(none).first()) == (0, 0, 0.0, 0.0, 0.0, 0.0)


def test_sweep_equals_single_thresholds(scores):
    sweep = {r["threshold"]: r for r in campaign.threshold_sweep(scores, campaign.threshold_grid()).collect()}
    assert len(sweep) == 86
    for t in (0.1, 0.29, 0.34, 0.58, 0.95):
        one = campaign.campaign_kpis(scores, t).first()
        for c in ("n_total", "n_target", "coverage", "mean_target_score", "target_spend"):
            assert sweep[t][c] == pytest.approx(one[c])


def test_top_targets_is_a_top_k(scores):
    plan = campaign.top_targets(scores, 0.2, 10)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan
    rows = campaign.top_targets(scores, 0.2, 10, ["client_id", "conversion_score"]).collect()
    assert rows == sorted(rows, key=lambda r: (-r["conversion_score"], r["client_id"])) and len(rows) == 10


def test_describe_counts_values_once(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", None), (None, None)], "x string, y string")
    got = {r["column"]: tuple(r)[1:] for r in aggregate.describe_cat(df, ["x", "y"]).collect()}
    assert got == {"x": (3, 2, "a", 2), "y": (0, 0, None, None)}


def test_translation(spark):
    words = spark.createDataFrame(
        [("es", "en", "hola", "hello"), ("es", "en", "vacío", ""), ("en", "es", "adiós", "x")],
        "src string, tgt string, text string, translated string",
    )
    df = spark.createDataFrame([(1, "hola"), (2, "vacío"), (3, "adiós"), (4, None)], "id int, t string")
    got = {r["id"]: r["t"] for r in localize.translate(df, "t", words).collect()}
    assert got == {1: "hello", 2: "vacío", 3: "adiós", 4: None}
    assert localize.translate(df, "t", words, target="fr") is df
    todo = localize.translation_worklist(df, "t", words).collect()
    assert [r["text"] for r in todo] == ["adiós"]


def test_sweep_counts_customers_without_a_score(spark):
    rows = [(s, 1.0) for s in (0.2, 0.34, 0.5, None, float("nan"))]
    frame = spark.createDataFrame(rows, "conversion_score double, total_spent double")
    swept = campaign.threshold_sweep(frame, [0.34]).first()
    kpis = campaign.campaign_kpis(frame, 0.34).first()
    assert (swept["n_total"], swept["n_target"], swept["coverage"]) == (5, 2, 40.0)
    assert (kpis["n_total"], kpis["n_target"], kpis["coverage"]) == (5, 2, 40.0)
    assert kpis["mean_score"] == pytest.approx((0.2 + 0.34 + 0.5) / 3)


def test_pivot_covers_all_values_or_refuses(spark):
    from campaign_engine.operators.aggregate import pivot_metrics

    frame = spark.createDataFrame([("x", "a", 1.0), ("x", "NEW", 3.0)], "i string, c string, v double")
    assert pivot_metrics(frame, "i", "c", "v").first().asDict() == {"i": "x", "a_mean": 1.0, "a_count": 1, "NEW_mean": 3.0, "NEW_count": 1}
    with pytest.raises(Exception, match="unlisted value"):
        pivot_metrics(frame, "i", "c", "v", ["a"]).collect()


def test_nan_is_no_outlier_and_inertia_skips_nulls(spark):
    from campaign_engine.operators.cluster import inertia
    from campaign_engine.operators.quality import summary_numeric

    frame = spark.createDataFrame([(float(v), "g") for v in range(20)] + [(float("nan"), "g")], "x double, g string")
    row = summary_numeric(frame, ["x"]).first()
    assert (row["nulls"], row["outliers"]) == (1, 0)
    three = spark.createDataFrame([(1.0, "g"), (3.0, "g"), (None, "g")], "x double, g string")
    assert inertia(three, ["x"], "g").first()["inertia"] == 2.0


def test_registered_pivot_has_every_channel(spark, monkeypatch):
    from campaign_engine.catalog import aggregates

    rows = [("A", c, float(i)) for i, c in enumerate(["one", "two", "three", "four", "five", "six.th", None])] + [("B", "six.th", None), (None, "one", 1.0)]
    frame = spark.createDataFrame(rows, "country string, acquisition_channel string, total_spent double")
    monkeypatch.setattr(aggregates, "normalized", lambda *_: frame)
    got = {(r["country"], r["channel"]): (r["mean"], r["count"]) for r in aggregates._pivot(spark, "").collect()}
    assert len(got) == 12 and got["A", "SIX.TH"] == (5.0, 1) and got["B", "SIX.TH"] == (0.0, 0) and got["B", "ONE"] == (0.0, 0)
    monkeypatch.setattr(aggregates, "normalized", lambda *_: frame.limit(0))
    assert aggregates._pivot(spark, "").collect() == []
