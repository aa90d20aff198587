"""Profiling queries: groups, pivots, distributions, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_engine.catalog.base import profile, query, rnd, with_tables
from campaign_engine.catalog.cleaning import imputed, normalized
from campaign_engine.functions.numeric import round_places
from campaign_engine.operators import aggregate as ops
from campaign_engine.operators.columns import round_cols
from campaign_engine.schemas import BEHAVIOUR_COLS, CAT_COLS, NUMERIC_COLS
from campaign_engine.sources.client_profile import client_profile, scored, table


@query(
    "pivot_channel",
    with_tables(
        "SELECT country, channel, "
        f"coalesce({rnd('avg(total_spent)', 6)}, 0.0::DOUBLE) AS mean, count(total_spent) AS count FROM ("
        "SELECT c.country, d.channel, total_spent FROM (SELECT DISTINCT country FROM known) c "
        "CROSS JOIN (SELECT DISTINCT channel FROM known) d LEFT JOIN known k ON k.country = c.country AND k.channel = d.channel"
        ") GROUP BY country, channel",
        "known AS (SELECT country, upper(acquisition_channel) AS channel, total_spent FROM normalized "
        "WHERE country IS NOT NULL AND acquisition_channel IS NOT NULL)",
        start="normalized",
    ),
)
def _pivot(spark, sf_dir):
    """Every cell of the pivot, whatever channels there are."""
    df = normalized(spark, sf_dir).withColumn("channel", F.upper("acquisition_channel"))
    wide = ops.pivot_metrics(df, "country", "channel", "total_spent")
    return ops.pivot_cells(wide, "country", "channel").withColumn("mean", round_places(F.col("mean"), 6))


@query(
    "value_counts",
    with_tables("SELECT country, count(*) AS n FROM client_profile GROUP BY country ORDER BY n DESC, country NULLS LAST LIMIT 15"),
)
def _value_counts(spark, sf_dir):
    return ops.value_counts(client_profile(spark, sf_dir), "country", dropna=False, top=15)


@query(
    "value_counts_dropna",
    with_tables("SELECT gender, count(*) AS n FROM client_profile WHERE gender IS NOT NULL GROUP BY gender"),
)
def _value_counts_dropna(spark, sf_dir):
    return ops.value_counts(client_profile(spark, sf_dir), "gender")


@query(
    "class_distribution",
    with_tables("SELECT subscription_type, count(*) AS n FROM client_profile WHERE subscription_type IS NOT NULL GROUP BY 1"),
)
def _class_distribution(spark, sf_dir):
    return ops.value_counts(client_profile(spark, sf_dir), "subscription_type")


def _describe_sql(cols: list[str], table_name: str) -> str:
    rows = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        rows.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, {rnd(f'avg({v})', 6)} AS mean, {rnd(f'stddev_samp({v})', 4)} AS std, "
            f"min({v}) AS min, {rnd(f'quantile_cont({v}, 0.25)', 6)} AS q1, {rnd(f'quantile_cont({v}, 0.5)', 6)} AS median, "
            f"{rnd(f'quantile_cont({v}, 0.75)', 6)} AS q3, max({v}) AS max FROM {table_name}"
        )
    return " UNION ALL ".join(rows)


@query("describe_numeric", with_tables(_describe_sql(NUMERIC_COLS, "normalized"), start="normalized"))
def _describe(spark, sf_dir):
    out = ops.describe(normalized(spark, sf_dir), NUMERIC_COLS)
    return round_cols(round_cols(out, ["mean", "q1", "median", "q3"], 6), ["std"], 4)


@query(
    "describe_categorical",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS n, count(DISTINCT {c}) AS n_unique, "
            f"(SELECT {c} FROM client_profile WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
            f"(SELECT max(n) FROM (SELECT count(*) AS n FROM client_profile WHERE {c} IS NOT NULL GROUP BY {c})) AS freq "
            "FROM client_profile"
            for c in CAT_COLS
        )
    ),
)
def _describe_cat(spark, sf_dir):
    return ops.describe_cat(client_profile(spark, sf_dir), CAT_COLS)


def _histogram_sql(source: str, value: str, bins: int, by: str | None = None) -> str:
    key = f"{by}, " if by else ""
    on = f" AND g.{by} = c.{by}" if by else ""
    grid = f"(SELECT DISTINCT {by} FROM {source})," if by else ""
    pick = f"g.{by}, " if by else ""
    return (
        f"SELECT {pick}CAST(g.bin AS INTEGER) AS bin, {rnd('lo + g.bin * w', 6)} AS bin_low, {rnd('lo + (g.bin + 1) * w', 6)} AS bin_high, "
        f"coalesce(n, 0) AS n FROM (SELECT * FROM {grid} range({bins}) AS r(bin), "
        f"(SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {source})) g LEFT JOIN "
        f"(SELECT {key}least(floor(({value} - lo) / w), {bins - 1}) AS bin, count(*) AS n FROM {source}, "
        f"(SELECT min({value}) AS lo, (max({value}) - min({value})) / {bins} AS w FROM {source}) "
        f"WHERE {value} IS NOT NULL GROUP BY {key}bin) c ON g.bin = c.bin{on}"
    )


@query("histogram", with_tables(_histogram_sql("client_profile", "total_spent", 30)))
def _histogram(spark, sf_dir):
    return round_cols(ops.histogram(profile(spark, sf_dir), "total_spent", 30), ["bin_low", "bin_high"], 6)


@query(
    "histogram_by_class",
    with_tables(
        _histogram_sql("flagged", "score", 40, "is_target"),
        "flagged AS (SELECT *, score >= 0.34 AS is_target FROM scored)",
        start="scored",
    ),
)
def _histogram_by_class(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("is_target", F.col("score") >= 0.34)
    return round_cols(ops.histogram(df, "score", 40, "is_target"), ["bin_low", "bin_high"], 6)


@query("calibration_hist", with_tables(_histogram_sql("scored", "score", 40, "label"), start="scored"))
def _calibration(spark, sf_dir):
    return round_cols(ops.histogram(scored(spark, sf_dir), "score", 40, "label"), ["bin_low", "bin_high"], 6)


@query(
    "median_and_mean",
    with_tables(f"SELECT {rnd('avg(total_spent)', 6)} AS mean, {rnd('median(total_spent)', 6)} AS median FROM client_profile"),
)
def _center(spark, sf_dir):
    return round_cols(ops.center_lines(profile(spark, sf_dir), "total_spent"), ["mean", "median"], 6)


def _spearman_sql(cols: list[str], source: str) -> str:
    """Ranks are taken per pair over the rows where both are known."""
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            ranks = ", ".join(
                f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS {n}"
                for c, n in ((a, "ra"), (b, "rb"))
            )
            rows.append(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd('corr(ra, rb)', 6)} AS rho FROM "
                f"(SELECT {ranks} FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
            )
    return " UNION ALL ".join(rows)


@query("corr_spearman", with_tables(_spearman_sql(BEHAVIOUR_COLS, "imputed"), start="imputed"))
def _spearman(spark, sf_dir):
    return ops.corr_spearman(imputed(spark, sf_dir).select(*BEHAVIOUR_COLS).persist(), BEHAVIOUR_COLS, 6)


_GAPS = ["age", "total_spent", "satisfaction_score"]


@query("corr_spearman_gaps", with_tables(_spearman_sql(_GAPS, "normalized"), start="normalized"))
def _spearman_gaps(spark, sf_dir):
    """Pairs with nulls: each on its own complete rows."""
    return ops.corr_spearman(normalized(spark, sf_dir).select(*_GAPS), _GAPS, 6)


@query(
    "agg_events_profile",
    "SELECT event_type, round_even(avg(value) * 10000, 0) / 10000 AS mean_value, max(value) AS max_value, count(*) AS n "
    "FROM events GROUP BY event_type",
)
def _events_profile(spark, sf_dir):
    """The group profile on the event table."""
    return ops.group_profile(
        table(spark, sf_dir, "events"),
        ["event_type"],
        {"mean_value": round_places(F.avg("value"), 4), "max_value": F.max("value"), "n": F.count("*")},
    )
