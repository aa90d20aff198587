"""Identity, samples, ranking and campaign queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_engine.catalog.base import query, rnd, with_tables
from campaign_engine.operators import campaign as ops
from campaign_engine.operators import identity
from campaign_engine.operators.columns import round_cols
from campaign_engine.schemas import SEED, TARGET_API_COLS, TARGET_TABLE_COLS
from campaign_engine.sources.client_profile import client_profile, scored, scored_profile, table

_PERCENTILE = (
    "(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2) / count(*) OVER () * 100"
)


@query("surrogate_id", "SELECT printf('C-%05d', c_custkey + 1) AS client_id, c_custkey, c_name FROM customer")
def _surrogate_id(spark, sf_dir):
    return identity.with_client_id(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")


@query(
    "surrogate_id_sorted",
    "SELECT printf('C-%05d', row_number() OVER (ORDER BY c_name)) AS client_id, c_name, c_acctbal FROM customer",
)
def _surrogate_sorted(spark, sf_dir):
    """No numeric key: the id is the place in the order of the names."""
    return identity.with_client_id(table(spark, sf_dir, "customer").select("c_name", "c_acctbal"), "c_name")


@query(
    "sample_rows",
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY substr(md5(o_orderkey || '|{SEED}'), 1, 13), o_orderkey LIMIT 12000",
)
def _sample_rows(spark, sf_dir):
    return identity.sample_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 12_000)


@query("head_sample", with_tables("SELECT * FROM client_profile ORDER BY client_id LIMIT 10"))
def _head_sample(spark, sf_dir):
    return identity.head_sample(client_profile(spark, sf_dir), "client_id")


@query(
    "score_percentile",
    with_tables(
        f"SELECT client_id, conversion_score, {rnd(_PERCENTILE.format(c='conversion_score'), 6)} AS score_percentil FROM "
        "(SELECT client_id, score AS conversion_score FROM scored)",
        start="scored",
    ),
)
def _percentile(spark, sf_dir):
    df = scored(spark, sf_dir).select("client_id", F.col("score").alias("conversion_score"))
    return round_cols(ops.percentile_rank(df), ["score_percentil"], 6)


_WITH_RANK = (
    "ranked AS (SELECT *, " + rnd(_PERCENTILE.format(c="conversion_score"), 6) + " AS score_percentil FROM scored_profile)"
)


def _ranked(spark, sf_dir):
    return round_cols(ops.percentile_rank(scored_profile(spark, sf_dir)), ["score_percentil"], 6)


@query(
    "top_targets",
    with_tables(
        f"SELECT {', '.join(TARGET_API_COLS)} FROM ranked WHERE conversion_score >= 0.34 "
        "ORDER BY conversion_score DESC, client_id LIMIT 50",
        _WITH_RANK,
        start="scored_profile",
    ),
)
def _top_targets(spark, sf_dir):
    return ops.top_targets(_ranked(spark, sf_dir))


_BANDED = {
    "score_band": "CASE WHEN conversion_score >= 0.7 THEN 'ALTO' WHEN conversion_score >= 0.45 THEN 'MEDIO' ELSE 'BAJO' END AS score_band",
    "score_percentil": rnd("score_percentil", 1) + " AS score_percentil",
}


@query(
    "target_table",
    with_tables(
        "SELECT " + ", ".join(_BANDED.get(c, c) for c in TARGET_TABLE_COLS) + " FROM ranked WHERE conversion_score >= 0.34 "
        "ORDER BY conversion_score DESC, client_id LIMIT 250",
        _WITH_RANK,
        start="scored_profile",
    ),
)
def _target_table(spark, sf_dir):
    return ops.target_table(_ranked(spark, sf_dir), n=250)


def _impact_sql(dim: str, limit: str) -> str:
    return with_tables(
        f"SELECT {dim}, {rnd('m', 12)} AS mean_score, targets FROM (SELECT {dim}, avg(conversion_score) AS m, "
        f"count(*) FILTER (WHERE conversion_score >= 0.34) AS targets FROM scored_profile GROUP BY {dim}) "
        f"ORDER BY m DESC, {dim} {limit}",
        start="scored_profile",
    )


@query("impact_by_dim", _impact_sql("acquisition_channel", ""))
def _impact_channel(spark, sf_dir):
    return round_cols(ops.impact_by(scored_profile(spark, sf_dir), "acquisition_channel"), ["mean_score"], 12)


@query("impact_by_country", _impact_sql("country", "LIMIT 15"))
def _impact_country(spark, sf_dir):
    return round_cols(ops.impact_by(scored_profile(spark, sf_dir), "country", top=15), ["mean_score"], 12)


@query(
    "campaign_kpis",
    with_tables(
        "SELECT n_total, n_target, " + rnd("n_target * 100 / n_total", 10) + " AS coverage, mean_target_score, target_spend, mean_score FROM "
        "(SELECT count(*) AS n_total, count(*) FILTER (WHERE conversion_score >= 0.34) AS n_target, "
        + rnd("avg(conversion_score) FILTER (WHERE conversion_score >= 0.34)", 12) + " AS mean_target_score, "
        + rnd("sum(total_spent) FILTER (WHERE conversion_score >= 0.34)", 2) + " AS target_spend, "
        + rnd("avg(conversion_score)", 12) + " AS mean_score FROM scored_profile)",
        start="scored_profile",
    ),
)
def _kpis(spark, sf_dir):
    out = ops.campaign_kpis(scored_profile(spark, sf_dir))
    exact = round_cols(round_cols(out, ["mean_target_score", "mean_score"], 12), ["target_spend"], 2)
    return round_cols(exact, ["coverage"], 10)


@query(
    "threshold_sweep",
    with_tables(
        "SELECT t AS threshold, (SELECT count(*) FROM scored_profile) AS n_total, count(client_id) AS n_target, "
        + rnd("count(client_id) * 100 / (SELECT count(*) FROM scored_profile)", 10) + " AS coverage, "
        + rnd("coalesce(avg(conversion_score), 0)", 12) + " AS mean_target_score, "
        + rnd("coalesce(sum(total_spent), 0)", 2) + " AS target_spend "
        "FROM (SELECT i / 100 AS t FROM range(10, 96) AS r(i)) LEFT JOIN scored_profile ON conversion_score >= t GROUP BY t",
        start="scored_profile",
    ),
)
def _sweep(spark, sf_dir):
    out = ops.threshold_sweep(scored_profile(spark, sf_dir), ops.threshold_grid())
    exact = round_cols(round_cols(out, ["mean_target_score"], 12), ["target_spend"], 2)
    return round_cols(exact, ["coverage"], 10)


@query(
    "upsell_summary",
    with_tables(
        "SELECT n_base, n_candidates, " + rnd("n_candidates * 100 / n_base", 6) + " AS share FROM "
        "(SELECT count(*) AS n_base, count(*) FILTER (WHERE conversion_score >= 0.75) AS n_candidates FROM scored_profile "
        "WHERE subscription_type = 'Monthly')",
        start="scored_profile",
    ),
)
def _upsell(spark, sf_dir):
    out = ops.upsell_summary(scored_profile(spark, sf_dir), F.col("subscription_type") == "Monthly")
    return round_cols(out, ["share"], 6)
