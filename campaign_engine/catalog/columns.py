"""Projections, scalar operators, filters and joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from campaign_engine.catalog.base import (
    CLEAN_NUMBERS,
    gender_sql,
    number_sql,
    profile,
    query,
    rnd,
    strip_sql,
    title_sql,
    tokens_sql,
    with_tables,
)
from campaign_engine.catalog.cleaning import normalized
from campaign_engine.functions.text import is_human_text, strip
from campaign_engine.operators import columns as ops
from campaign_engine.operators import features, fx, impute, localize, shape
from campaign_engine.schemas import CAT_COLS, NARROW_COLS, NUMERIC_COLS, UNROUNDED_COLS
from campaign_engine.sources.client_profile import client_profile, client_raw, scored, scored_profile, table


@query(
    "null_tokens_numeric_text",
    with_tables(
        f"SELECT client_id, {number_sql('age')} AS age FROM (SELECT client_id, "
        + tokens_sql("age", "'nan', 'NAN', 'NaN', ''")
        + " AS age FROM client_profile)"
    ),
)
def _null_tokens_numeric(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "age")
    return ops.to_numeric(ops.normalize_text(df, ["age"], ["nan", "NAN", "NaN", ""]), ["age"])


@query("canon_gender", with_tables(f"SELECT client_id, {gender_sql('gender')} AS gender FROM stripped", start="normalized"))
def _canon_gender(spark, sf_dir):
    return ops.canon_gender(ops.normalize_text(profile(spark, sf_dir).select("client_id", "gender"), ["gender"]))


@query(
    "title_case",
    with_tables(
        f"SELECT client_id, coalesce({title_sql('g')}, g) AS gender, {title_sql('a')} AS acquisition_channel, "
        f"{title_sql('m')} AS payment_method FROM (SELECT client_id, {strip_sql('gender')} AS g, "
        f"{strip_sql('acquisition_channel')} AS a, {strip_sql('payment_method')} AS m FROM client_profile)"
    ),
)
def _title_case(spark, sf_dir):
    cols = ["gender", "acquisition_channel", "payment_method"]
    return ops.title_case(profile(spark, sf_dir).select("client_id", *cols), cols)


@query(
    "fill_constant",
    with_tables(
        "SELECT client_id, coalesce(gender, 'Unknown') AS gender, coalesce(country, 'No registrado') AS country "
        "FROM client_profile"
    ),
)
def _fill_constant(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "gender", "country")
    return ops.fill_constant(df, {"gender": "Unknown", "country": "No registrado"})


@query("to_numeric", with_tables(f"SELECT client_id, {number_sql('age')} AS age FROM client_profile"))
def _to_numeric(spark, sf_dir):
    return ops.to_numeric(profile(spark, sf_dir).select("client_id", "age"), ["age"])


@query(
    "clip",
    with_tables(
        "SELECT client_id, CASE WHEN total_spent IS NOT NULL THEN least(greatest(total_spent, 1000000.0::DOUBLE), "
        "3000000.0::DOUBLE) END AS total_spent FROM client_profile"
    ),
)
def _clip(spark, sf_dir):
    return ops.clip_columns(profile(spark, sf_dir).select("client_id", "total_spent"), {"total_spent": (1e6, 3e6)})


@query(
    "round_int",
    with_tables(
        "SELECT client_id, CAST(round_even(marketing_spend_per_user / 0.5, 0) AS BIGINT) AS half_units, "
        "CAST(round_even(coalesce(satisfaction_score, 1) / 2, 0) AS BIGINT) AS satisfaction_score FROM client_profile"
    ),
)
def _round_int(spark, sf_dir):
    df = profile(spark, sf_dir).select(
        "client_id",
        (F.col("marketing_spend_per_user") / 0.5).alias("half_units"),
        (F.coalesce("satisfaction_score", F.lit(1.0)) / 2).alias("satisfaction_score"),
    )
    return ops.round_int(df, ["half_units", "satisfaction_score"])


@query(
    "trunc_int",
    with_tables("SELECT client_id, CAST(trunc(nps_score / 7) AS INTEGER) AS nps_score FROM client_profile"),
)
def _trunc_int(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", (F.col("nps_score") / 7).alias("nps_score"))
    return ops.trunc_int(df, ["nps_score"])


_ROUNDED = [c for c in NUMERIC_COLS if c not in UNROUNDED_COLS and c != "total_visits"]


@query(
    "round_dp",
    with_tables("SELECT client_id, " + ", ".join(f"{rnd(c, 3)} AS {c}" for c in _ROUNDED) + " FROM client_profile"),
)
def _round_dp(spark, sf_dir):
    return ops.round_cols(profile(spark, sf_dir).select("client_id", *_ROUNDED), _ROUNDED, 3)


@query("select_cols", with_tables("SELECT country, total_spent, client_id FROM client_profile"))
def _select_cols(spark, sf_dir):
    return ops.select_existing(client_profile(spark, sf_dir), ["country", "not_there", "total_spent", "client_id"])


@query("drop_cols", with_tables("SELECT * EXCLUDE (country, gender) FROM client_profile"))
def _drop_cols(spark, sf_dir):
    return ops.drop_existing(client_profile(spark, sf_dir), ["country", "gender", "not_there"])


@query("select_numeric", with_tables("SELECT " + ", ".join(CLEAN_NUMBERS) + " FROM client_profile"))
def _select_numeric(spark, sf_dir):
    return ops.numeric_columns(client_profile(spark, sf_dir))


@query(
    "narrow_types",
    with_tables(
        "SELECT client_id, "
        + ", ".join(f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}" for c in NARROW_COLS if c != "total_visits")
        + ", CAST(total_visits AS BIGINT) AS total_visits FROM client_profile"
    ),
)
def _narrow_types(spark, sf_dir):
    """Narrowed, then widened again so that the values can be compared."""
    narrow = ops.narrow_types(profile(spark, sf_dir).select("client_id", *NARROW_COLS), NARROW_COLS)
    return narrow.select(
        "client_id", *[F.col(c).cast("bigint" if c == "total_visits" else "double").alias(c) for c in NARROW_COLS]
    )


_RATES_SQL = """rates AS (
  SELECT 'USD' AS base, CASE WHEN event_type = 'view' THEN 'EUR' ELSE 'CLP' END AS quote,
         CASE WHEN event_type = 'error' THEN -value ELSE 800 + value END AS rate, ts AS as_of FROM events)"""


def _rates(spark, sf_dir):
    """A rate history out of the events: two quotes, some invalid rates."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.lit("USD").alias("base"),
        F.when(kind == "view", "EUR").otherwise("CLP").alias("quote"),
        F.when(kind == "error", -F.col("value")).otherwise(F.lit(800) + F.col("value")).alias("rate"),
        F.col("ts").alias("as_of"),
        kind.alias("source"),
    )


_MOMENTS = {"fresh": datetime(2024, 1, 30, 12), "stale": datetime(2024, 3, 1), "none": datetime(2000, 1, 1)}


def _resolve_sql(name: str, moment: datetime) -> str:
    usable = f"SELECT * FROM rates WHERE base = 'USD' AND quote = 'CLP' AND rate > 0 AND as_of <= TIMESTAMP '{moment}'"
    fresh = f"(SELECT max_by(rate, as_of) FROM ({usable}) WHERE as_of >= TIMESTAMP '{moment}' - INTERVAL 24 HOUR)"
    latest = f"(SELECT max_by(rate, as_of) FROM ({usable}))"
    return (
        f"SELECT '{name}' AS at, coalesce({fresh}, {latest}, 900.0::DOUBLE) AS rate, "
        f"CASE WHEN {fresh} IS NOT NULL THEN 'fresh' WHEN {latest} IS NOT NULL THEN 'stale' ELSE 'fallback' END AS origin"
    )


@query("fx_resolve", f"WITH {_RATES_SQL} " + " UNION ALL ".join(_resolve_sql(n, m) for n, m in _MOMENTS.items()))
def _fx_resolve(spark, sf_dir):
    return shape.stack_tagged({n: fx.resolve_rate(_rates(spark, sf_dir), m) for n, m in _MOMENTS.items()}, "at")


@query(
    "fx_enrich",
    with_tables(
        "SELECT client_id, total_spent, avg_order_value, rate AS fx_usd_to_clp, " + rnd("total_spent / rate", 2) + " AS "
        "total_spent_usd, " + rnd("avg_order_value / rate", 2) + " AS avg_order_value_usd FROM client_profile, resolved",
        _RATES_SQL,
        f"resolved AS ({_resolve_sql('fresh', _MOMENTS['fresh'])})",
    ),
)
def _fx_enrich(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "total_spent", "avg_order_value")
    rate = fx.rate_column(_rates(spark, sf_dir), _MOMENTS["fresh"])
    return fx.fx_enrich(df, rate, ["total_spent", "avg_order_value"])


_DAYS = (
    "CASE WHEN lifetime_value IS NOT NULL THEN "
    "least(greatest(lifetime_value / (avg_order_value + 1e-6) * 30, 1.0::DOUBLE), 3650.0::DOUBLE) END"
)
ENGINEERED_SQL = {
    "estimated_days_since_signup": _DAYS,
    "purchase_frequency_intensity": f"last_3_month_purchase_freq / (({_DAYS}) + 1e-6) * 30",
    "ticket_promedio_estimado": "lifetime_value / (last_3_month_purchase_freq + 1)",
    "marketing_efficiency": "lifetime_value / (marketing_spend_per_user + 1)",
    "friction_free_customer": "CAST(support_tickets = 0 AND delivery_delay_days = 0 AS INTEGER)",
    "engagement_score": "total_visits * pages_per_session * avg_session_time",
    "email_engagement": "email_open_rate * email_click_rate",
    "nps_satisfaction_gap": "nps_score - satisfaction_score * 20",
    "spend_per_visit": "total_spent / (total_visits + 1)",
    "value_per_ticket": "lifetime_value / (support_tickets + 1)",
}


@query(
    "eng_features",
    with_tables(
        "SELECT client_id, "
        + ", ".join(f"{s} AS {c}" if c == "friction_free_customer" else f"{rnd(s, 5)} AS {c}" for c, s in ENGINEERED_SQL.items())
        + " FROM client_profile"
    ),
)
def _eng_features(spark, sf_dir):
    df = features.add_engineered_features(profile(spark, sf_dir)).select("client_id", *ENGINEERED_SQL)
    return ops.round_cols(df, [c for c in ENGINEERED_SQL if c != "friction_free_customer"], 5)


@query(
    "target_flip",
    with_tables(
        "SELECT client_id, 1 - CAST(CAST(subscription_type = 'Annual' AS INTEGER) AS DOUBLE) AS y FROM client_profile"
    ),
)
def _target_flip(spark, sf_dir):
    y = (F.col("subscription_type") == "Annual").cast("double").alias("y")
    return ops.flip_target(client_profile(spark, sf_dir).select("client_id", y), "y")


@query("is_target", with_tables("SELECT client_id, score, score >= 0.34 AS is_target FROM scored", start="scored"))
def _is_target(spark, sf_dir):
    return ops.flag_targets(scored(spark, sf_dir).select("client_id", "score"), score="score")


_BAND = "CASE WHEN score >= 0.7 THEN 'ALTO' WHEN score >= 0.45 THEN 'MEDIO' ELSE 'BAJO' END"


@query(
    "score_band",
    with_tables(f"SELECT client_id, score, {_BAND} AS score_band FROM scored WHERE score >= 0.34", start="scored"),
)
def _score_band(spark, sf_dir):
    targets = scored(spark, sf_dir).filter(F.col("score") >= 0.34)
    return ops.band_scores(targets, "score").select("client_id", "score", "score_band")


@query(
    "value_labels",
    with_tables(
        "SELECT client_id, label, CASE label WHEN 0 THEN 'Básico (0)' WHEN 1 THEN 'Anual (1)' END AS label_label, "
        "support_tickets, CASE support_tickets WHEN 0 THEN 'Activos' WHEN 1 THEN 'Regulares' WHEN 2 THEN 'Esporádicos' "
        "ELSE CAST(support_tickets AS VARCHAR) END AS tickets_label FROM scored_profile",
        start="scored_profile",
    ),
)
def _value_labels(spark, sf_dir):
    df = scored_profile(spark, sf_dir).select("client_id", "label", "support_tickets")
    named = ops.label_values(df, "label", {0: "Básico (0)", 1: "Anual (1)"})
    clusters = {0: "Activos", 1: "Regulares", 2: "Esporádicos"}
    return ops.label_values(named, "support_tickets", clusters, "tickets_label")


@query(
    "concat_label",
    with_tables("SELECT client_id, concat_ws(' | ', subscription_type, payment_method) AS series FROM client_profile"),
)
def _concat_label(spark, sf_dir):
    df = ops.concat_label(client_profile(spark, sf_dir), "subscription_type", "payment_method", "series")
    return df.select("client_id", "series")


_SCALED = ["total_spent", "avg_order_value", "pages_per_session", "constant"]


def _scaled_sql(c: str) -> str:
    low, high = f"(SELECT min({c}) FROM c)", f"(SELECT max({c}) FROM c)"
    return f"CASE WHEN {high} > {low} THEN {rnd(f'({c} - {low}) / ({high} - {low})', 9)} ELSE {c} END AS {c}"


@query(
    "scale_minmax",
    with_tables(
        "SELECT client_id, " + ", ".join(_scaled_sql(c) for c in _SCALED) + " FROM c",
        "c AS (SELECT client_id, total_spent, avg_order_value, pages_per_session, 7.0::DOUBLE AS constant FROM client_profile)",
    ),
)
def _scale_minmax(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", *_SCALED[:3], F.lit(7.0).alias("constant"))
    return ops.round_cols(ops.minmax_scale(df, _SCALED), _SCALED, 9)


@query(
    "percent_of_total",
    with_tables(
        "SELECT country, n, n / sum(n) OVER () AS share FROM (SELECT country, count(*) AS n FROM client_profile GROUP BY country)"
    ),
)
def _percent_of_total(spark, sf_dir):
    counts = client_profile(spark, sf_dir).groupBy("country").agg(F.count("*").alias("n"))
    return ops.with_share(counts, "n")


@query(
    "null_mask",
    with_tables(
        "SELECT client_id, " + ", ".join(f"{c} IS NULL AS {c}" for c in [*NUMERIC_COLS, *CAT_COLS]) + " FROM client_profile"
    ),
)
def _null_mask(spark, sf_dir):
    return ops.null_mask(client_profile(spark, sf_dir), "client_id")


_WORDS_SQL = """words AS (
  SELECT DISTINCT 'es' AS src, 'en' AS tgt, o_orderpriority AS text, lower(o_orderpriority) || '!' AS translated
  FROM orders WHERE o_orderpriority <> '3-MEDIUM')"""


def _words(spark, sf_dir):
    words = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return words.filter(F.col("o_orderpriority") != "3-MEDIUM").select(
        F.lit("es").alias("src"),
        F.lit("en").alias("tgt"),
        F.col("o_orderpriority").alias("text"),
        F.concat(F.lower("o_orderpriority"), F.lit("!")).alias("translated"),
    )


@query(
    "translate_labels",
    f"WITH {_WORDS_SQL} SELECT o_orderkey, coalesce(translated, o_orderpriority) AS o_orderpriority FROM orders "
    "LEFT JOIN words ON o_orderpriority = text",
)
def _translate(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return localize.translate(df, "o_orderpriority", _words(spark, sf_dir))


_T = strip_sql("text")
HUMAN_SQL = (
    f"length({_T}) BETWEEN 4 AND 220 AND NOT (starts_with({_T}, 'http://') OR starts_with({_T}, 'https://') OR "
    f"starts_with({_T}, '/') OR starts_with({_T}, '#')) AND NOT regexp_matches({_T}, '[{{}}]') AND "
    f"NOT (contains({_T}, '_') AND NOT contains({_T}, ' ')) AND "
    f"len(regexp_extract_all({_T}, '\\p{{L}}')) >= 3"
)


def _known_texts(spark, sf_dir):
    """Texts of the labelled documents stand in for a dictionary."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id").select(
        F.lit("es").alias("src"), F.lit("en").alias("tgt"), strip(F.col("text")).alias("text"), F.md5("text").alias("translated")
    )


@query(
    "translation_worklist",
    f"SELECT DISTINCT {_T} AS text FROM documents WHERE {HUMAN_SQL} AND {_T} NOT IN "
    f"(SELECT {strip_sql('d.text')} FROM documents d JOIN labels USING (doc_id))",
)
def _worklist(spark, sf_dir):
    return localize.translation_worklist(table(spark, sf_dir, "documents"), "text", _known_texts(spark, sf_dir))


@query("human_text", f"SELECT doc_id, {HUMAN_SQL} AS human FROM documents")
def _human_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", is_human_text(F.col("text")).alias("human"))


# Filters


@query("f_threshold", with_tables("SELECT client_id, score FROM scored WHERE score >= 0.34", start="scored"))
def _f_threshold(spark, sf_dir):
    return scored(spark, sf_dir).filter(F.col("score") >= 0.34).select("client_id", "score")


@query(
    "f_range_outside",
    with_tables("SELECT client_id, age FROM normalized WHERE age IS NOT NULL AND (age < 0 OR age > 120)", start="normalized"),
)
def _f_range_outside(spark, sf_dir):
    return ops.out_of_range(normalized(spark, sf_dir).select("client_id", "age"), "age", 0, 120)


@query(
    "f_in_set",
    with_tables("SELECT client_id, gender FROM normalized WHERE gender NOT IN ('Male', 'Female')", start="normalized"),
)
def _f_in_set(spark, sf_dir):
    return ops.not_in(normalized(spark, sf_dir).select("client_id", "gender"), "gender", ["Male", "Female"])


@query("f_class", with_tables("SELECT client_id, label, score FROM scored WHERE label = 0", start="scored"))
def _f_class(spark, sf_dir):
    return scored(spark, sf_dir).filter(F.col("label") == 0)


@query(
    "f_not_null",
    with_tables(
        "SELECT client_id, total_spent, satisfaction_score FROM client_profile "
        "WHERE total_spent IS NOT NULL AND satisfaction_score IS NOT NULL"
    ),
)
def _f_not_null(spark, sf_dir):
    cols = ["total_spent", "satisfaction_score"]
    return ops.drop_nulls(client_profile(spark, sf_dir).select("client_id", *cols), cols)


@query(
    "f_positive",
    with_tables("SELECT client_id, delivery_delay_days FROM client_profile WHERE delivery_delay_days > 0"),
)
def _f_positive(spark, sf_dir):
    return client_profile(spark, sf_dir).select("client_id", "delivery_delay_days").filter(F.col("delivery_delay_days") > 0)


@query("f_and_band", with_tables("SELECT client_id, score FROM scored WHERE score >= 0.45 AND score < 0.7", start="scored"))
def _f_and_band(spark, sf_dir):
    c = F.col("score")
    return scored(spark, sf_dir).filter((c >= 0.45) & (c < 0.70)).select("client_id", "score")


# Joins and set operations


@query(
    "join_left_overlay",
    with_tables(
        "SELECT p.client_id, coalesce(n.gender, p.gender) AS gender, coalesce(n.country, p.country) AS country, "
        "p.total_spent FROM client_profile p LEFT JOIN normalized n ON p.client_id = n.client_id",
        start="normalized",
    ),
)
def _join_left_overlay(spark, sf_dir):
    left = profile(spark, sf_dir).select("client_id", "gender", "country", "total_spent")
    return shape.overlay(left, normalized(spark, sf_dir), "client_id", ["gender", "country"])


@query(
    "join_inner_suffix",
    with_tables(
        "SELECT p.client_id, p.total_spent AS total_spent_raw, p.country AS country_raw, n.total_spent AS total_spent_clean, "
        "n.country AS country_clean FROM client_profile p JOIN normalized n ON p.client_id = n.client_id",
        start="normalized",
    ),
)
def _join_inner_suffix(spark, sf_dir):
    cols = ["client_id", "total_spent", "country"]
    raw, clean = profile(spark, sf_dir).select(*cols), normalized(spark, sf_dir).select(*cols)
    return shape.join_suffixed(raw, clean, "client_id", ("_raw", "_clean"))


@query(
    "join_anti",
    f"SELECT DISTINCT {_T} AS text FROM documents WHERE {_T} NOT IN "
    f"(SELECT {strip_sql('d.text')} FROM documents d JOIN labels USING (doc_id))",
)
def _join_anti(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(strip(F.col("text")).alias("text")).distinct()
    return texts.join(_known_texts(spark, sf_dir).select("text").distinct(), "text", "left_anti")


@query(
    "join_broadcast_scalar",
    with_tables(
        "SELECT client_id, (SELECT max(total_spent) FROM client_profile) AS max_spent, "
        "(SELECT count(*) FROM client_profile) AS n_clients FROM client_profile"
    ),
)
def _join_broadcast_scalar(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "total_spent")
    one_row = df.agg(F.max("total_spent").alias("max_spent"), F.count("*").alias("n_clients"))
    return shape.with_constants(df.select("client_id"), one_row)


@query(
    "union_all",
    with_tables(
        "SELECT client_id, total_spent, 'Original' AS dataset FROM client_raw UNION ALL "
        "SELECT client_id, total_spent, 'Limpio' AS dataset FROM client_profile",
        start="raw",
    ),
)
def _union_all(spark, sf_dir):
    cols = ["client_id", "total_spent"]
    frames = {"Original": client_raw(spark, sf_dir).select(*cols), "Limpio": client_profile(spark, sf_dir).select(*cols)}
    return shape.stack_tagged(frames)


@query(
    "melt",
    with_tables(
        "SELECT client_id, variable, value FROM client_profile UNPIVOT INCLUDE NULLS "
        "(value FOR variable IN (total_spent, avg_order_value, lifetime_value))"
    ),
)
def _melt(spark, sf_dir):
    return shape.melt(profile(spark, sf_dir), ["client_id"], ["total_spent", "avg_order_value", "lifetime_value"])


@query(
    "group_transform",
    with_tables(
        "SELECT client_id, payment_method, m.med AS spent_median FROM client_profile p LEFT JOIN "
        "(SELECT payment_method AS g, median(total_spent) AS med FROM client_profile GROUP BY 1) m ON p.payment_method = m.g"
    ),
)
def _group_transform(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "payment_method", "total_spent")
    out = impute.with_group_stat(df, "total_spent", "payment_method", "spent_median")
    return out.select("client_id", "payment_method", "spent_median")
