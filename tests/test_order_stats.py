"""The scalable paths give what the small ones give."""

import math

import pytest
from pyspark.sql import functions as F

from campaign_engine.functions.numeric import hash_number
from campaign_engine.operators.aggregate import corr_spearman
from campaign_engine.operators.campaign import percentile_rank
from campaign_engine.operators.identity import sample_rows, with_client_id
from campaign_engine.operators.metrics import ranking_metrics, roc_curve
from campaign_engine.operators.order_stats import (
    column_quantiles,
    group_cuts,
    group_quantiles,
    running_totals,
    sorted_positions,
)


@pytest.fixture(scope="module")
def numbers(spark):
    """3,000 rows; a third of them share one value, one group holds two thirds."""
    k = F.col("id")
    return spark.range(3000).select(
        k,
        F.when(k % 3 == 0, 7.0).otherwise(((k * 7919) % 1009) / 7.0).alias("x"),
        F.when(k % 10 == 0, None).otherwise((k * k % 97).cast("double")).alias("y"),
        F.when(k % 3 != 1, "big").when(k % 5 == 0, "small").alias("g"),
    ).persist()


def test_narrowed_quantiles_are_exact(numbers):
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    exact = column_quantiles(numbers, ["x", "y"], probs)
    assert column_quantiles(numbers, ["x", "y"], probs, limit=20) == exact
    assert column_quantiles(numbers, ["x", "y"], probs, limit=1) == exact
    pdf = numbers.select("x", "y").toPandas()
    for c in ("x", "y"):
        assert exact[c] == pytest.approx(pdf[c].quantile(probs).tolist())


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert column_quantiles(df, ["x"], [0.5]) == {"x": None}
    assert column_quantiles(df, ["x"], [0.5], rows=2) == {"x": None}


def test_hot_groups_are_narrowed(numbers):
    small = {r["g"]: r["q"] for r in group_quantiles(numbers, "x", ["g"], [0.25, 0.5]).collect()}
    narrowed = {r["g"]: r["q"] for r in group_quantiles(numbers, "x", ["g"], [0.25, 0.5], limit=500).collect()}
    assert small == narrowed and len(small) == 3


@pytest.mark.parametrize("limit", [500, 20, 1])
def test_infinite_values_of_hot_groups_count(spark, limit):
    """Group 0 has 200 values of -Infinity, group 1 has 400 of +Infinity, group 2 has both; each has 600 values."""
    k, g = F.floor(F.col("id") / 3), F.col("id") % 3
    x = F.when((g != 1) & (k < 200), -math.inf).when((g == 1) & (k < 400), math.inf).when((g == 2) & (k >= 400), math.inf)
    frame = spark.range(1800).select(g.alias("g"), x.otherwise((k * 7919 % 1009).cast("double")).alias("x"))
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    exact = {r["g"]: r["q"] for r in group_quantiles(frame, "x", ["g"], probs).collect()}
    assert {r["g"]: r["q"] for r in group_quantiles(frame, "x", ["g"], probs, limit=limit).collect()} == exact
    assert exact[0][1] == -math.inf and exact[1][2] == math.inf and math.isfinite(exact[2][2])
    for group, want in exact.items():
        assert column_quantiles(frame.filter(F.col("g") == group), ["x"], probs, limit=limit)["x"] == want


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_cuts_split_exactly(numbers, limit):
    h = hash_number(F.col("id"), 1)
    cuts = group_cuts(numbers, h, "g", lambda n: [round(n * 0.2), 0, n], limit)
    for group, (cut, none, everything) in cuts.items():
        rows = numbers.filter(F.col("g").eqNullSafe(F.lit(group)))
        assert rows.filter(h <= cut).count() == round(rows.count() * 0.2)
        assert none == -math.inf and everything == math.inf


@pytest.mark.parametrize("descending", [False, True])
def test_ranged_running_totals(numbers, descending):
    counts = numbers.groupBy("x").agg(F.count("*").alias("n"))
    plain = running_totals(counts, "x", ["n"], descending)
    ranged = running_totals(counts, "x", ["n"], descending, limit=3)
    assert sorted(plain.collect()) == sorted(ranged.collect())


def test_sorted_positions_number_all_rows(numbers):
    rows = sorted_positions(numbers.repartition(7).select("id"), "id").collect()
    assert all(r["id"] == r["position"] for r in rows) and len(rows) == 3000


def test_client_id_from_text_key(spark):
    df = spark.createDataFrame([("b",), ("c",), ("a",)], "name string")
    assert {r["name"]: r["client_id"] for r in with_client_id(df, "name").collect()} == {
        "a": "C-00001", "b": "C-00002", "c": "C-00003",
    }
    assert with_client_id(spark.range(123456, 123457), "id").first()["client_id"] == "C-123457"


def test_samples_are_exact_and_repeatable(numbers, monkeypatch):
    small = {r["id"] for r in sample_rows(numbers, "id", 500).collect()}
    assert len(small) == 500
    assert small == {r["id"] for r in sample_rows(numbers.repartition(5), "id", 500).collect()}
    monkeypatch.setattr("campaign_engine.operators.identity.TOP_ROWS", 10)
    assert small == {r["id"] for r in sample_rows(numbers, "id", 500, limit=100).collect()}
    assert sample_rows(numbers, "id", 9_999).count() == 3000


def test_ranged_percentiles(numbers):
    df = numbers.select("id", F.col("x").alias("conversion_score"))
    plain = percentile_rank(df).orderBy("id").toPandas()
    ranged = percentile_rank(df, limit=10).orderBy("id").toPandas()
    want = plain["conversion_score"].rank(pct=True) * 100
    assert plain["score_percentil"].tolist() == pytest.approx(want.tolist())
    assert ranged["score_percentil"].tolist() == pytest.approx(want.tolist())
    assert plain["score_percentil"].max() <= 100


def test_ranged_metrics(numbers):
    df = numbers.select((F.col("id") % 4 == 0).cast("int").alias("label"), F.col("x").alias("score"))
    assert tuple(ranking_metrics(df, "label", "score").first()) == pytest.approx(
        tuple(ranking_metrics(df, "label", "score", limit=10).first())
    )
    order = lambda c: sorted((r["fpr"], r["tpr"]) for r in c.collect())
    assert order(roc_curve(df, "label", "score")) == order(roc_curve(df, "label", "score", limit=10))


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_spearman_like_pandas(numbers, limit):
    want = numbers.select("x", "y", "id").toPandas().corr("spearman")
    for r in corr_spearman(numbers, ["x", "y", "id"], 9, limit).collect():
        assert r["rho"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-8)


def test_many_hot_groups_take_no_more_jobs(spark):
    """The jobs of a pass serve all groups: two hundred hot groups need about as many as two."""
    frame = spark.range(20_000).select((F.col("id") % 200).alias("g"), ((F.col("id") * 7919) % 10_007).cast("double").alias("x"))

    def run(df):
        context = spark.sparkContext
        context.setJobGroup("quantiles", "quantiles")
        got = {r["g"]: r["q"] for r in group_quantiles(df, "x", ["g"], [0.1, 0.5], limit=20).collect()}
        return got, len(context.statusTracker().getJobIdsForGroup("quantiles"))

    few, jobs_few = run(frame.filter("g < 2"))
    many, jobs_many = run(frame)
    exact = {r["g"]: r["q"] for r in group_quantiles(frame, "x", ["g"], [0.1, 0.5]).collect()}
    assert set(many) == set(exact) and all(many[g] == pytest.approx(exact[g]) for g in exact)
    assert all(few[g] == pytest.approx(exact[g]) for g in (0, 1))
    assert jobs_many - jobs_few <= 1.5 * jobs_few


@pytest.mark.parametrize("limit", [1_000_000, 3])
def test_nan_scores_are_missing(spark, limit):
    rows = [(i % 2, float(i % 7)) for i in range(40)]
    frame = spark.createDataFrame([*rows, (1, float("nan")), (0, None)], "label int, score double")
    clean = spark.createDataFrame(rows, "label int, score double")
    assert ranking_metrics(frame, "label", "score", limit).first() == ranking_metrics(clean, "label", "score", limit).first()
    got = percentile_rank(frame, "score", limit=limit)
    assert got.filter(F.isnan("score") | F.col("score").isNull()).select("score_percentil").distinct().collect() == [(None,)]
    assert got.agg(F.max("score_percentil")).first()[0] < 100


def test_frequent_scores_are_not_shuffled(spark, monkeypatch):
    from campaign_engine.operators import shape

    monkeypatch.setattr(shape, "BROADCAST_ROWS", 3)
    frame = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 5000.0).alias("score"))
    hot = percentile_rank(frame, "score")
    monkeypatch.setattr(shape, "BROADCAST_ROWS", 100_000)
    plain = percentile_rank(frame, "score")
    assert sorted(hot.collect()) == sorted(plain.collect())
