"""Data quality queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from campaign_engine.catalog.base import fence_sql, number_sql, profile, query, rnd, with_tables
from campaign_engine.catalog.cleaning import cleaned, normalized
from campaign_engine.operators import quality as ops
from campaign_engine.operators.columns import round_cols
from campaign_engine.plans import cleaning
from campaign_engine.schemas import CAT_COLS, NUMERIC_COLS, Rule, rules_for
from campaign_engine.sources.client_profile import client_profile, client_raw, table

_RAW_COLS = ["client_id", *NUMERIC_COLS, *CAT_COLS]
_RULES_RAW = rules_for("raw")
_RULES_RAW["gender"] = replace(_RULES_RAW["gender"], values=("male", "female", "M", "F", "f", "unknown"))


def _number(c: str) -> str:
    return number_sql(c) if c == "age" else c


def _checks_sql(rules, table: str, stage: str, text_age: bool) -> str:
    """One row per broken rule, written out rule by rule."""
    parts = []
    for c, rule in rules.items():
        if not rule.nullable:
            parts.append((c, "null", "ERROR", f"{c} IS NULL"))
        if rule.kind == "numeric":
            value = _number(c) if text_age else c
            if c == "age" and text_age:
                parts.append((c, "not_numeric", "WARNING", f"{c} IS NOT NULL AND {value} IS NULL"))
            parts.append((c, "range", "WARNING", f"({value}) < {rule.low} OR ({value}) > {rule.high}"))
        if rule.values:
            allowed = ", ".join(f"'{v}'" for v in rule.values)
            parts.append((c, "values", "WARNING", f"trim({c}) NOT IN ({allowed})"))
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{c}' AS \"column\", '{name}' AS rule, '{sev}' AS severity, n FROM "
        f"(SELECT count(*) AS n FROM {table} WHERE {cond}) WHERE n > 0"
        for c, name, sev, cond in parts
    )


_EXTRA_RAW = [c for c in ["client_id", *NUMERIC_COLS] if c not in _RULES_RAW]


def _extra_sql(cols: list[str], stage: str) -> str:
    return " UNION ALL ".join(f"SELECT '{stage}', '{c}', 'extra', 'WARNING', CAST(1 AS BIGINT)" for c in cols)


@query(
    "validate_schema",
    with_tables(_checks_sql(_RULES_RAW, "client_profile", "RAW", True) + " UNION ALL " + _extra_sql(_EXTRA_RAW, "RAW")),
)
def _validate(spark, sf_dir):
    return ops.validate_schema(profile(spark, sf_dir), _RULES_RAW, "RAW")


_RULES_CLEAN = rules_for("clean")
_EXTRA_CLEAN = [*_EXTRA_RAW, "fx_usd_to_clp", "total_spent_usd", "avg_order_value_usd"]


@query(
    "validate_clean",
    with_tables(
        _checks_sql(_RULES_CLEAN, "cleaned", "CLEAN", False) + " UNION ALL " + _extra_sql(_EXTRA_CLEAN, "CLEAN"),
        start="cleaned",
    ),
)
def _validate_clean(spark, sf_dir):
    return ops.validate_schema(cleaned(spark, sf_dir), _RULES_CLEAN, "CLEAN")


_ORDER_RULES = {
    "o_totalprice": Rule("numeric", False, 0.0, 300_000.0),
    "o_orderpriority": Rule("category", False, values=("1-URGENT", "2-HIGH", "3-MEDIUM")),
    "o_region": Rule("category"),
}


@query(
    "set_difference_cols",
    "SELECT 'ORDERS' AS stage, 'o_region' AS \"column\", 'missing' AS rule, 'ERROR' AS severity, CAST(1 AS BIGINT) AS n "
    "UNION ALL SELECT 'ORDERS', column_name, 'extra', 'WARNING', 1 FROM (DESCRIBE orders) "
    "WHERE column_name NOT IN ('o_totalprice', 'o_orderpriority') UNION ALL "
    + _checks_sql({c: r for c, r in _ORDER_RULES.items() if c != "o_region"}, "orders", "ORDERS", False),
)
def _set_difference(spark, sf_dir):
    """Missing and extra columns of the order table, with its broken rules."""
    return ops.validate_schema(table(spark, sf_dir, "orders"), _ORDER_RULES, "ORDERS")


_NULL_SUM = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _RAW_COLS)


@query(
    "quality_metrics",
    with_tables(
        f"SELECT 'RAW' AS stage, count(*) AS total_rows, {len(_RAW_COLS)} AS total_cols, "
        + rnd(f"sum({_NULL_SUM}) * 100 / (count(*) * {len(_RAW_COLS)})", 8)
        + " AS null_ratio, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM client_raw)) AS duplicate_rows FROM client_raw",
        start="raw",
    ),
)
def _quality_metrics(spark, sf_dir):
    return round_cols(ops.quality_metrics(client_raw(spark, sf_dir), "RAW"), ["null_ratio"], 8)


def _nulls_sql(cols: list[str], table: str, name: str = "nulls") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS {name} FROM {table}" for c in cols
    )


@query("null_counts", with_tables(_nulls_sql(_RAW_COLS, "client_profile")))
def _null_counts(spark, sf_dir):
    return ops.null_counts(client_profile(spark, sf_dir))


@query("null_total", with_tables(f"SELECT CAST(sum({_NULL_SUM}) AS BIGINT) AS nulls FROM client_profile"))
def _null_total(spark, sf_dir):
    return ops.null_total(client_profile(spark, sf_dir))


_CLEAN_COLS = [*_RAW_COLS, "fx_usd_to_clp", "total_spent_usd", "avg_order_value_usd"]
_WIDE = (
    'SELECT coalesce(a."column", b."column") AS "column", CAST(a.nulls_raw AS DOUBLE) AS nulls_raw, CAST(b.nulls_clean AS DOUBLE) AS nulls_clean FROM ('
    + _nulls_sql(_RAW_COLS, "client_profile", "nulls_raw")
    + ") a FULL JOIN ("
    + _nulls_sql(_CLEAN_COLS, "cleaned", "nulls_clean")
    + ') b ON a."column" = b."column"'
)


@query("null_compare", with_tables(_WIDE, start="cleaned"))
def _null_compare(spark, sf_dir):
    """As double, since a column of only one table has no count on the other side."""
    both = ops.null_compare(profile(spark, sf_dir), cleaned(spark, sf_dir))
    return both.select("column", F.col("nulls_raw").cast("double"), F.col("nulls_clean").cast("double"))


@query("join_outer_align", with_tables(_WIDE, start="cleaned"))
def _join_outer_align(spark, sf_dir):
    return _null_compare(spark, sf_dir)


@query(
    "null_compare_long",
    with_tables(
        "SELECT * FROM (SELECT *, 'Original' AS dataset FROM ("
        + _nulls_sql(_RAW_COLS, "client_profile")
        + ") UNION ALL SELECT *, 'Limpio' AS dataset FROM ("
        + _nulls_sql(_RAW_COLS, "normalized")
        + ")) WHERE nulls > 0",
        start="normalized",
    ),
)
def _null_compare_long(spark, sf_dir):
    return ops.null_compare_long(profile(spark, sf_dir), normalized(spark, sf_dir))


_STAT_COLS = ["age", "total_spent", "avg_order_value", "satisfaction_score", "total_visits"]


def _stat_rows(table: str, suffix: str, text_age: bool) -> str:
    def value(c: str) -> str:
        return _number(c) if text_age else f"CAST({c} AS DOUBLE)"

    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(min({value(c)}) AS DOUBLE) AS min{suffix}, CAST(max({value(c)}) AS DOUBLE) AS max{suffix}, "
        f"{rnd(f'avg({value(c)})', 6)} AS mean{suffix}, {rnd(f'median({value(c)})', 6)} AS median{suffix} FROM {table}"
        for c in _STAT_COLS
    )


@query(
    "stats_compare",
    with_tables(
        f"SELECT * FROM ({_stat_rows('client_profile', '_raw', True)}) JOIN "
        f"({_stat_rows('cleaned', '_clean', False)}) USING (variable)",
        start="cleaned",
    ),
)
def _stats_compare(spark, sf_dir):
    out = ops.stats_compare(profile(spark, sf_dir), cleaned(spark, sf_dir), _STAT_COLS)
    return round_cols(out, ["mean_raw", "median_raw", "mean_clean", "median_clean"], 6)


@query(
    "stats_compare_long",
    with_tables(
        "SELECT dataset, variable, metric, value FROM ("
        f"SELECT 'Original' AS dataset, * FROM ({_stat_rows('client_profile', '', True)}) UNION ALL "
        f"SELECT 'Limpio' AS dataset, * FROM ({_stat_rows('cleaned', '', False)})"
        ") UNPIVOT (value FOR metric IN (min, max, mean, median))",
        start="cleaned",
    ),
)
def _stats_compare_long(spark, sf_dir):
    out = ops.stats_compare_long(profile(spark, sf_dir), cleaned(spark, sf_dir), _STAT_COLS)
    rounded = F.col("metric").isin("mean", "median")
    return out.withColumn("value", F.when(rounded, F.rint(F.col("value") * 1e6) / 1e6).otherwise(F.col("value")))


@query(
    "category_compare",
    with_tables(
        "SELECT coalesce(gender, 'nan') AS value, count(*) AS n, 'Original' AS dataset FROM client_profile GROUP BY 1 "
        "UNION ALL SELECT coalesce(gender, 'nan'), count(*), 'Limpio' FROM cleaned GROUP BY 1",
        start="cleaned",
    ),
)
def _category_compare(spark, sf_dir):
    return ops.category_compare(profile(spark, sf_dir), cleaned(spark, sf_dir), "gender")


@query(
    "row_consistency",
    with_tables(
        "SELECT *, rows_clean <= rows_raw AS consistent FROM (SELECT (SELECT count(*) FROM client_raw) AS rows_raw, "
        "(SELECT count(*) FROM client_raw) AS rows_clean)",
        start="raw",
    ),
)
def _row_consistency(spark, sf_dir):
    """Cleaning keeps every row."""
    raw = client_raw(spark, sf_dir)
    return ops.row_consistency(raw, cleaning.clean(raw))


def _verdict_sql(checks: str) -> str:
    return (
        "SELECT count(*) FILTER (WHERE severity = 'ERROR') = 0 AS is_valid, count(*) FILTER (WHERE severity = 'ERROR') AS errors, "
        f"count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM ({checks})"
    )


@query(
    "validity_verdict",
    with_tables(_verdict_sql(_checks_sql(_RULES_RAW, "client_profile", "RAW", True) + " UNION ALL " + _extra_sql(_EXTRA_RAW, "RAW"))),
)
def _validity_verdict(spark, sf_dir):
    return ops.verdict(ops.validate_schema(profile(spark, sf_dir), _RULES_RAW, "RAW"))


_KINDS = {c: "bigint" if c in ("total_visits", "support_tickets", "delivery_delay_days") else "double" for c in NUMERIC_COLS}


@query(
    "column_summary_num",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{k}' AS type, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS outliers FROM normalized, fences"
            for c, k in _KINDS.items()
        ),
        fence_sql(NUMERIC_COLS, "normalized"),
        start="normalized",
    ),
)
def _summary_num(spark, sf_dir):
    return ops.summary_numeric(normalized(spark, sf_dir))


@query(
    "column_summary_cat",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", 'string' AS type, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"count(DISTINCT {c}) AS n_unique FROM client_profile"
            for c in CAT_COLS
        )
    ),
)
def _summary_cat(spark, sf_dir):
    return ops.summary_categorical(client_profile(spark, sf_dir), CAT_COLS)


@query(
    "shape_kpis",
    with_tables(
        f"SELECT count(*) AS total_rows, {len(_RAW_COLS)} AS total_cols, {len(NUMERIC_COLS) - 1} AS numeric_cols, "
        f"CAST(sum({_NULL_SUM}) AS BIGINT) AS nulls FROM client_profile"
    ),
)
def _shape_kpis(spark, sf_dir):
    return ops.shape_kpis(client_profile(spark, sf_dir))


def _reasons_sql(rules) -> str:
    marks = []
    for c, rule in rules.items():
        if not rule.nullable:
            marks.append(f"CASE WHEN {c} IS NULL THEN '{c}:null' END")
        if rule.kind == "numeric":
            if c == "age":
                marks.append(f"CASE WHEN age IS NOT NULL AND ({_number(c)}) IS NULL THEN 'age:not_numeric' END")
            marks.append(f"CASE WHEN ({_number(c)}) < {rule.low} OR ({_number(c)}) > {rule.high} THEN '{c}:range' END")
    return "concat_ws(',', " + ", ".join(marks) + ")"


@query(
    "quarantine_rows",
    with_tables(
        f"SELECT client_id, nullif({_reasons_sql(rules_for('raw'))}, '') IS NULL AS valid, {_reasons_sql(rules_for('raw'))} AS reasons "
        "FROM client_profile"
    ),
)
def _quarantine(spark, sf_dir):
    valid, rejected = ops.quarantine(profile(spark, sf_dir), rules_for("raw"))
    good = valid.select("client_id", F.lit(True).alias("valid"), F.lit("").alias("reasons"))
    return good.unionByName(
        rejected.select("client_id", F.lit(False).alias("valid"), F.array_join("reasons", ",").alias("reasons"))
    )
