"""Imputation, outliers, encoding and the cleaning plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_engine.catalog.base import fence_sql, profile, query, rnd, strip_sql, title_sql, tokens_sql, with_tables
from campaign_engine.functions.numeric import round_places
from campaign_engine.operators import encode, impute, outliers
from campaign_engine.operators.aggregate import group_profile
from campaign_engine.operators.columns import normalize_text, round_cols
from campaign_engine.plans import cleaning
from campaign_engine.schemas import CAT_COLS, INT_COLS, NUMERIC_COLS, UNROUNDED_COLS, WINSOR_COLS

_NUM_WITH_NULLS = ["age", "satisfaction_score"]


def normalized(spark, sf_dir):
    return cleaning.normalized(profile(spark, sf_dir))


def imputed(spark, sf_dir):
    return cleaning.imputed(normalized(spark, sf_dir))


def cleaned(spark, sf_dir):
    return cleaning.clean(profile(spark, sf_dir))


@query(
    "impute_median",
    with_tables(
        "SELECT client_id, coalesce(age, (SELECT median(age) FROM normalized)) AS age, "
        "coalesce(satisfaction_score, (SELECT median(satisfaction_score) FROM normalized)) AS satisfaction_score "
        "FROM normalized",
        start="normalized",
    ),
)
def _impute_median(spark, sf_dir):
    df = normalized(spark, sf_dir).select("client_id", *_NUM_WITH_NULLS)
    return impute.impute_median(df, _NUM_WITH_NULLS)


@query(
    "impute_group_median",
    with_tables(
        "SELECT client_id, coalesce(total_spent, (SELECT median(total_spent) FROM group_filled)) AS total_spent "
        "FROM group_filled",
        start="imputed",
    ),
)
def _impute_group_median(spark, sf_dir):
    df = normalized(spark, sf_dir).select("client_id", "total_spent", "subscription_type")
    return impute.impute_group_median(df, "total_spent", "subscription_type").select("client_id", "total_spent")


@query(
    "impute_mode",
    with_tables(
        "SELECT client_id, "
        + ", ".join(
            f"coalesce({c}, (SELECT {c} FROM normalized WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
            for c in CAT_COLS
        )
        + " FROM normalized",
        start="normalized",
    ),
)
def _impute_mode(spark, sf_dir):
    return impute.impute_mode(normalized(spark, sf_dir).select("client_id", *CAT_COLS), CAT_COLS)


@query(
    "iqr_bounds",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {c}_q1 AS q1, {c}_q3 AS q3, {c}_lo AS low, {c}_hi AS high FROM fences"
            for c in WINSOR_COLS
        ),
        start="winsorized",
    ),
)
def _iqr_bounds(spark, sf_dir):
    return outliers.iqr_bounds(imputed(spark, sf_dir), WINSOR_COLS)


@query(
    "winsorize_iqr",
    with_tables("SELECT client_id, " + ", ".join(WINSOR_COLS) + " FROM winsorized", start="winsorized"),
)
def _winsorize(spark, sf_dir):
    df = outliers.winsorize_iqr(imputed(spark, sf_dir), WINSOR_COLS)
    return df.select("client_id", *WINSOR_COLS)


def _count_outside(c: str, value: str) -> str:
    return f"count(*) FILTER (WHERE {value} < {c}_lo OR {value} > {c}_hi)"


@query(
    "winsor_report",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(any_value({c}_lo), 3) AS low, round(any_value({c}_hi), 3) AS high, "
            f"{_count_outside(c, c)} AS outliers_before, "
            f"{_count_outside(c, f'least(greatest({c}, {c}_lo), {c}_hi)')} AS outliers_after FROM imputed, fences"
            for c in WINSOR_COLS
        ),
        start="winsorized",
    ),
)
def _winsor_report(spark, sf_dir):
    return outliers.winsor_report(imputed(spark, sf_dir), WINSOR_COLS)


_FENCES = "normalized, fences"


def _normalized_fences(body: str) -> str:
    return with_tables(body, fence_sql(NUMERIC_COLS, "normalized"), start="normalized")


@query(
    "outlier_report",
    _normalized_fences(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {_count_outside(c, c)} AS outliers, {rnd(f'any_value({c}_lo)', 6)} AS low, "
            f"{rnd(f'any_value({c}_hi)', 6)} AS high FROM {_FENCES}"
            for c in NUMERIC_COLS
        )
    ),
)
def _outlier_report(spark, sf_dir):
    return round_cols(outliers.outlier_report(normalized(spark, sf_dir), NUMERIC_COLS), ["low", "high"], 6)


@query(
    "f_outliers",
    _normalized_fences(
        f"SELECT client_id, total_spent FROM {_FENCES} WHERE total_spent < total_spent_lo OR total_spent > total_spent_hi"
    ),
)
def _f_outliers(spark, sf_dir):
    return outliers.outliers(normalized(spark, sf_dir), "total_spent").select("client_id", "total_spent")


_BOX_COLS = ["total_spent", "avg_order_value", "lifetime_value", "total_visits", "pages_per_session", "support_tickets"]


@query(
    "boxplot_stats",
    _normalized_fences(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {rnd(f'any_value({c}_q1)', 6)} AS q1, "
            f"{rnd(f'any_value({c}_q2)', 6)} AS median, {rnd(f'any_value({c}_q3)', 6)} AS q3, "
            f"CAST(min({c}) FILTER (WHERE {c} BETWEEN {c}_lo AND {c}_hi) AS DOUBLE) AS whisker_low, "
            f"CAST(max({c}) FILTER (WHERE {c} BETWEEN {c}_lo AND {c}_hi) AS DOUBLE) AS whisker_high, "
            f"{_count_outside(c, c)} AS outliers FROM {_FENCES}"
            for c in _BOX_COLS
        )
    ),
)
def _boxplot(spark, sf_dir):
    return round_cols(outliers.boxplot_stats(normalized(spark, sf_dir), _BOX_COLS), ["q1", "median", "q3"], 6)


def _codes_sql(table: str) -> str:
    return "codes AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, value, row_number() OVER (ORDER BY value) - 1 AS code "
        f"FROM (SELECT DISTINCT coalesce({c}, 'nan') AS value FROM {table})"
        for c in CAT_COLS
    ) + ")"


@query(
    "label_encode",
    with_tables(
        "SELECT client_id, "
        + ", ".join(
            f"CAST((SELECT code FROM codes WHERE variable = '{c}' AND value = coalesce(n.{c}, 'nan')) AS INTEGER) AS {c}"
            for c in CAT_COLS
        )
        + " FROM normalized n",
        _codes_sql("normalized"),
        start="normalized",
    ),
)
def _label_encode(spark, sf_dir):
    coded, _ = encode.label_encode(normalized(spark, sf_dir).select("client_id", *CAT_COLS), CAT_COLS)
    return coded


@query(
    "label_decode",
    with_tables(
        "SELECT client_id, " + ", ".join(f"coalesce({c}, 'nan') AS {c}" for c in CAT_COLS) + " FROM normalized",
        start="normalized",
    ),
)
def _label_decode(spark, sf_dir):
    coded, dictionary = encode.label_encode(normalized(spark, sf_dir).select("client_id", *CAT_COLS), CAT_COLS)
    return encode.label_decode(coded, dictionary, CAT_COLS)


@query("clean_pipeline", with_tables("SELECT * FROM cleaned", start="cleaned"))
def _clean_pipeline(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query(
    "clean_encoded",
    with_tables(
        "SELECT c.* REPLACE ("
        + ", ".join(
            f"CAST((SELECT code FROM codes WHERE variable = '{c}' AND value = c.{c}) AS INTEGER) AS {c}" for c in CAT_COLS
        )
        + ") FROM cleaned c",
        _codes_sql("cleaned"),
        start="cleaned",
    ),
)
def _clean_encoded(spark, sf_dir):
    coded, _ = cleaning.encoded(cleaned(spark, sf_dir))
    return coded


_NOTEBOOK = [
    """parsed AS (SELECT * REPLACE ("""
    + "CASE WHEN regexp_matches(trim(age), '^[+-]?[0-9.]+$') THEN TRY_CAST(trim(age) AS DOUBLE) END AS age) FROM client_profile)",
    """filled AS (SELECT * REPLACE (
    CAST(trunc(coalesce(age, (SELECT median(age) FROM parsed))) AS DOUBLE) AS age,
    coalesce(satisfaction_score, (SELECT median(satisfaction_score) FROM parsed)) AS satisfaction_score) FROM parsed)""",
    """spent AS (SELECT f.* REPLACE (coalesce(f.total_spent, g.med) AS total_spent) FROM filled f
  LEFT JOIN (SELECT subscription_type AS grp, median(total_spent) AS med FROM filled WHERE subscription_type IS NOT NULL
    GROUP BY 1) g ON f.subscription_type = g.grp)""",
    "spent_all AS (SELECT * REPLACE (coalesce(total_spent, (SELECT median(total_spent) FROM spent)) AS total_spent) FROM spent)",
]


def _notebook_sql() -> str:
    clipped = {c: f"CASE WHEN {c} IS NOT NULL THEN least(greatest(CAST({c} AS DOUBLE), {c}_lo), {c}_hi) END" for c in WINSOR_COLS}
    numbers = []
    for c in NUMERIC_COLS:
        value = clipped.get(c, c)
        if c in INT_COLS:
            value = f"CAST(round_even({value}, 0) AS BIGINT)"
        if c not in UNROUNDED_COLS and c not in INT_COLS:
            value = rnd(value, 3)
        numbers.append(f"{value} AS {c}")
    gender = f"coalesce({title_sql('strip_gender')}, '')"
    return with_tables(
        "SELECT client_id, "
        + ", ".join(numbers)
        + f", CASE WHEN {gender} IN ('Nan', 'None', '') THEN 'Unknown' ELSE {gender} END AS gender"
        + ", coalesce(country, 'No registrado') AS country, "
        + f"{title_sql('strip_channel')} AS acquisition_channel, {title_sql('strip_type')} AS subscription_type, "
        + f"{title_sql('strip_method')} AS payment_method FROM (SELECT *, "
        + f"{strip_sql('gender')} AS strip_gender, {strip_sql('acquisition_channel')} AS strip_channel, "
        + f"{strip_sql('subscription_type')} AS strip_type, {strip_sql('payment_method')} AS strip_method FROM spent_all), fences",
        *_NOTEBOOK,
        fence_sql(WINSOR_COLS, "spent_all"),
    )


@query("clean_notebook", _notebook_sql())
def _clean_notebook(spark, sf_dir):
    return cleaning.clean(profile(spark, sf_dir), "notebook")


@query(
    "encode_notebook",
    f"WITH notebook AS ({_notebook_sql()}), {_codes_sql('notebook')} SELECT client_id, "
    + ", ".join(
        f"CAST((SELECT code FROM codes WHERE variable = '{c}' AND value = coalesce(n.{c}, 'nan')) AS INTEGER) AS {c}"
        for c in CAT_COLS
    )
    + " FROM notebook n",
)
def _encode_notebook(spark, sf_dir):
    """Codes of the notebook profile's categories."""
    coded, _ = cleaning.encoded(cleaning.clean(profile(spark, sf_dir), "notebook"), "notebook")
    return coded.select("client_id", *CAT_COLS)


@query(
    "agg_country_sub",
    with_tables(
        f"SELECT country, subscription_type, {rnd('avg(total_spent)', 6)} AS total_spent_mean, "
        "max(total_spent) AS total_spent_max, count(*) AS customer_count FROM winsorized "
        "GROUP BY country, subscription_type",
        start="winsorized",
    ),
)
def country_subscription(spark, sf_dir):
    """First slice end to end: text, numbers, imputation, winsorising, grouping; only of the columns it answers with."""
    needed = profile(spark, sf_dir).select("client_id", "country", "subscription_type", "total_spent")
    df = outliers.winsorize_iqr(cleaning.imputed(cleaning.normalized(needed)), ["total_spent"])
    return group_profile(
        df,
        ["country", "subscription_type"],
        {
            "total_spent_mean": round_places(F.avg("total_spent"), 6),
            "total_spent_max": F.max("total_spent"),
            "customer_count": F.count("*"),
        },
    )


@query(
    "trim_null_tokens",
    with_tables(
        "SELECT client_id, " + ", ".join(f"{tokens_sql(c)} AS {c}" for c in ["age", *CAT_COLS]) + " FROM client_profile"
    ),
)
def _trim(spark, sf_dir):
    df = profile(spark, sf_dir).select("client_id", "age", *CAT_COLS)
    return normalize_text(df, ["age", *CAT_COLS])
