"""Registration of queries and the common SQL pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from campaign_engine.schemas import CAT_COLS, INT_COLS, NUMERIC_COLS, WINSOR_COLS
from campaign_engine.sources.client_profile import client_profile

Query = Callable[[SparkSession, str], DataFrame]
queries: dict[str, Query] = {}
oracles: dict[str, str] = {}
_profiles: dict[tuple[str, str], DataFrame] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        queries[name] = fn
        if sql is not None:
            oracles[name] = sql
        return fn

    return register


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """client_profile, kept for the operators that pass over it more than once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _profiles:
        _profiles[key] = client_profile(spark, sf_dir)
    return _profiles[key].persist()


def with_tables(body: str, *extra: str, start: str = "profile") -> str:
    """Put the shared table definitions in front of a statement."""
    return "WITH " + ",\n".join([*TABLES[start], *extra]) + "\n" + body


_PROFILE = [
    """order_lines AS (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS revenue,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned
  FROM lineitem GROUP BY l_orderkey)""",
    """spend AS (
  SELECT o_custkey, min(o_orderpriority) AS payment_method, sum(o_totalprice) AS spent,
         count(*) AS n_orders,
         count(*) FILTER (WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY) AS n_recent,
         sum(revenue) AS revenue, CAST(sum(returned) AS BIGINT) AS returned
  FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey GROUP BY o_custkey)""",
    """visits AS (
  SELECT user_id, count(*) AS n_events, count(DISTINCT CAST(ts AS DATE)) AS days, round(sum(value), 2) / count(value) AS mean_value,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         count(*) FILTER (WHERE event_type = 'error') AS errors
  FROM events GROUP BY user_id)""",
    """client_profile AS (
  SELECT printf('C-%05d', c_custkey + 1) AS client_id,
    CASE c_custkey % 20 WHEN 0 THEN 'nan' WHEN 1 THEN NULL WHEN 2 THEN ' 130 ' WHEN 3 THEN 'abc'
         ELSE CAST(18 + (7 * c_custkey) % 60 AS VARCHAR) END AS age,
    CASE c_custkey % 9 WHEN 0 THEN ' male' WHEN 1 THEN 'M' WHEN 2 THEN 'FEMALE ' WHEN 3 THEN 'f'
         WHEN 4 THEN 'unknown' WHEN 5 THEN 'nan' WHEN 6 THEN '' WHEN 7 THEN NULL ELSE 'non binary' END AS gender,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' ' || n_name || '  ' ELSE n_name END AS country,
    CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN c_mktsegment || ' ' ELSE c_mktsegment END
      AS acquisition_channel,
    CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_acctbal >= 4500 THEN 'Annual' ELSE 'Monthly' END AS subscription_type,
    payment_method,
    CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 97 = 0 THEN round(spent * 50, 2) ELSE round(spent, 2) END
      AS total_spent,
    round(spent, 2) / n_orders AS avg_order_value,
    round(revenue, 4) AS lifetime_value,
    CAST(coalesce(n_recent, 0) AS DOUBLE) AS last_3_month_purchase_freq,
    round(abs(c_acctbal) / 10, 3) AS marketing_spend_per_user,
    coalesce(n_events, n_orders, 0) AS total_visits,
    coalesce(mean_value, round(spent, 2) / n_orders / 1000) AS avg_session_time,
    coalesce(n_events / days, CAST(1 + c_custkey % 6 AS DOUBLE)) AS pages_per_session,
    coalesce(views / n_events, (c_custkey % 10) / 10) AS email_open_rate,
    coalesce(clicks / n_events, (c_custkey % 7) / 10) AS email_click_rate,
    coalesce(errors, c_custkey % 4) AS support_tickets,
    coalesce(returned, 0) AS delivery_delay_days,
    CASE WHEN c_custkey % 11 <> 0 THEN CAST(1 + (7 * c_custkey) % 5 AS DOUBLE) END AS satisfaction_score,
    CAST((13 * c_custkey) % 201 - 100 AS DOUBLE) AS nps_score
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN spend ON c_custkey = o_custkey LEFT JOIN visits ON c_custkey = user_id)""",
]

_RAW = [
    """client_raw AS (
  SELECT * FROM client_profile
  UNION ALL SELECT * FROM client_profile WHERE (CAST(substr(client_id, 3) AS BIGINT) - 1) % 50 = 0)""",
]

_SCORED = [
    """scored AS (
  SELECT printf('C-%05d', c_custkey + 1) AS client_id,
         CAST((31 * c_custkey) % 100 < 45 AS INTEGER) AS label,
         round(0.8::DOUBLE * ((7919 * c_custkey) % 1000) / 1000
               + 0.2::DOUBLE * CAST((31 * c_custkey) % 100 < 45 AS INTEGER), 3) AS score
  FROM customer)""",
]

_SCORED_PROFILE = [
    """scored_profile AS (
  SELECT p.*, s.label, s.score AS conversion_score
  FROM client_profile p JOIN scored s ON p.client_id = s.client_id)""",
]

TABLES = {
    "profile": _PROFILE,
    "raw": [*_PROFILE, *_RAW],
    "scored": _SCORED,
    "scored_profile": [*_PROFILE, *_SCORED, *_SCORED_PROFILE],
}


# The cleaning steps as SQL, each on top of the former one.
def title_sql(c: str) -> str:
    """Title case of one lower-case pass, letter by letter."""
    return (
        f"list_aggregate(list_transform(range(1, CAST(length({c}) AS BIGINT) + 1), lambda i: "
        f"CASE WHEN i > 1 AND regexp_matches(substr({c}, CAST(i AS BIGINT) - 1, 1), '\\p{{L}}') "
        f"THEN lower(substr({c}, CAST(i AS BIGINT), 1)) ELSE upper(substr({c}, CAST(i AS BIGINT), 1)) END), "
        f"'string_agg', '')"
    )


def rnd(x: str, places: int) -> str:
    """Half-even rounding."""
    return f"(round_even(({x}) * 1{'0' * places}.0::DOUBLE, 0) / 1{'0' * places}.0::DOUBLE)"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def tokens_sql(c: str, tokens: str = "'', 'nan', 'None'") -> str:
    return f"CASE WHEN {strip_sql(c)} NOT IN ({tokens}) THEN {strip_sql(c)} END"


def number_sql(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({strip_sql(c)}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
        f"THEN TRY_CAST({strip_sql(c)} AS DOUBLE) END"
    )


def gender_sql(c: str) -> str:
    return (
        f"CASE lower({c}) WHEN 'male' THEN 'Male' WHEN 'm' THEN 'Male' WHEN 'female' THEN 'Female' "
        f"WHEN 'f' THEN 'Female' WHEN 'unknown' THEN 'Unknown' ELSE {title_sql(c)} END"
    )


NORMALIZED = [
    f"""stripped AS (
  SELECT * REPLACE ({tokens_sql('age')} AS age, {tokens_sql('gender')} AS gender, {tokens_sql('country')} AS country,
    {tokens_sql('acquisition_channel')} AS acquisition_channel, {tokens_sql('subscription_type')} AS subscription_type,
    {tokens_sql('payment_method')} AS payment_method)
  FROM client_profile)""",
    f"""normalized AS (
  SELECT * REPLACE ({gender_sql('gender')} AS gender, {number_sql('age')} AS age) FROM stripped)""",
]


def mode_sql(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


CLEAN_NUMBERS = [c for c in NUMERIC_COLS if c != "age"]
_PLAIN = [c for c in NUMERIC_COLS if c != "total_spent"]
IMPUTED = [
    """group_filled AS (
  SELECT n.* REPLACE (coalesce(n.total_spent, g.med) AS total_spent)
  FROM normalized n LEFT JOIN (SELECT subscription_type AS grp, median(total_spent) AS med FROM normalized
    WHERE subscription_type IS NOT NULL GROUP BY subscription_type) g ON n.subscription_type = g.grp)""",
    "imputed AS (\n  SELECT * REPLACE (\n    "
    + ",\n    ".join(
        ["coalesce(total_spent, (SELECT median(total_spent) FROM group_filled)) AS total_spent"]
        + [f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM normalized)) AS {c}" for c in _PLAIN]
        + [f"coalesce({c}, {mode_sql(c, 'normalized')}) AS {c}" for c in CAT_COLS]
    )
    + ") FROM group_filled)",
]


def fence_sql(cols: list[str], table: str, name: str = "fences") -> str:
    """One row: <c>_q1, <c>_q2, <c>_q3, <c>_lo, <c>_hi."""
    quartiles = ", ".join(
        f"quantile_cont({c}, {p}) AS {c}_q{i}" for c in cols for i, p in ((1, 0.25), (2, 0.5), (3, 0.75))
    )
    ends = ", ".join(
        f"{c}_q1 - 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5::DOUBLE * ({c}_q3 - {c}_q1) AS {c}_hi"
        for c in cols
    )
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"{name} AS (SELECT *, {ends} FROM (SELECT {quartiles} FROM (SELECT {doubles} FROM {table})))"


WINSORIZED = [
    fence_sql(WINSOR_COLS, "imputed"),
    "winsorized AS (\n  SELECT imputed.* REPLACE (\n    "
    + ",\n    ".join(
        f"CASE WHEN {c}_q3 = {c}_q1 THEN {c} ELSE least(greatest({c}, {c}_lo), {c}_hi) END AS {c}" for c in WINSOR_COLS
    )
    + ") FROM imputed, fences)",
]
CLEAN = [
    "cleaned AS (\n  SELECT * REPLACE ("
    + ", ".join(f"CAST(round_even({c}, 0) AS BIGINT) AS {c}" for c in INT_COLS)
    + "),\n    900.0::DOUBLE AS fx_usd_to_clp, " + rnd("total_spent / 900", 2) + " AS total_spent_usd,\n"
    "    " + rnd("avg_order_value / 900", 2) + " AS avg_order_value_usd FROM winsorized)"
]
TABLES["normalized"] = [*_PROFILE, *NORMALIZED]
TABLES["imputed"] = [*TABLES["normalized"], *IMPUTED]
TABLES["winsorized"] = [*TABLES["imputed"], *WINSORIZED]
TABLES["cleaned"] = [*TABLES["winsorized"], *CLEAN]
