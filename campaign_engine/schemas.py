"""Column groups, validation rules and constants. All values here are fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column groups of the customer table.
NUMERIC_COLS = [
    "age",
    "total_spent",
    "avg_order_value",
    "lifetime_value",
    "last_3_month_purchase_freq",
    "marketing_spend_per_user",
    "total_visits",
    "avg_session_time",
    "pages_per_session",
    "email_open_rate",
    "email_click_rate",
    "support_tickets",
    "delivery_delay_days",
    "satisfaction_score",
    "nps_score",
]
CAT_COLS = ["gender", "country", "acquisition_channel", "subscription_type", "payment_method"]
WINSOR_COLS = [
    "age",
    "total_spent",
    "avg_order_value",
    "lifetime_value",
    "total_visits",
    "avg_session_time",
    "pages_per_session",
    "support_tickets",
    "delivery_delay_days",
]
INT_COLS = ["age", "total_visits", "support_tickets", "delivery_delay_days"]
BEHAVIOUR_COLS = [
    "total_spent",
    "avg_order_value",
    "last_3_month_purchase_freq",
    "total_visits",
    "pages_per_session",
    "support_tickets",
]
UNROUNDED_COLS = ["age", "support_tickets", "delivery_delay_days"]
NARROW_COLS = [
    "avg_order_value",
    "lifetime_value",
    "last_3_month_purchase_freq",
    "marketing_spend_per_user",
    "avg_session_time",
    "pages_per_session",
    "email_open_rate",
    "email_click_rate",
    "satisfaction_score",
    "nps_score",
    "total_visits",
    "total_spent",
]
TARGET_TABLE_COLS = [
    "client_id",
    "score_band",
    "conversion_score",
    "score_percentil",
    "gender",
    "subscription_type",
    "payment_method",
    "total_spent",
    "avg_order_value",
    "last_3_month_purchase_freq",
    "total_visits",
    "pages_per_session",
    "support_tickets",
    "acquisition_channel",
    "country",
]
TARGET_API_COLS = [
    "client_id",
    "conversion_score",
    "score_percentil",
    "subscription_type",
    "acquisition_channel",
    "country",
    "total_spent",
]
CAMPAIGN_COLS = ["client_id", "subscription_type", *BEHAVIOUR_COLS, "gender", "country",
                 "acquisition_channel", "payment_method"]

# Constants.
ID_COL = "client_id"
TARGET_COL = "subscription_type"
POSITIVE_CLASS = "Annual"
SEED = 42
DEFAULT_THRESHOLD = 0.34
UPSELL_THRESHOLD = 0.75
FX_FALLBACK = 900.0
FX_TTL_HOURS = 24
FX_BASE, FX_QUOTE = "USD", "CLP"
ROWS_CLASSIFICATION = 12_000
ROWS_OPTIMIZATION = 6_000
UNKNOWN = "Unknown"
COUNTRY_MISSING = "No registrado"
NULL_TOKENS = ["", "nan", "None"]
NUMERIC_NULL_TOKENS = ["nan", "NAN", "NaN", ""]
GENDER_MAP = {"male": "Male", "m": "Male", "female": "Female", "f": "Female", "unknown": "Unknown"}

DERIVED_FROM = {"total_spent_usd": "total_spent", "avg_order_value_usd": "avg_order_value"}


@dataclass(frozen=True)
class Rule:
    """What one column must satisfy."""

    kind: str
    nullable: bool = False
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = field(default_factory=tuple)


# Range and null rules of the raw and the clean table.
_RANGES = {
    "age": (0, 120),
    "total_spent": (0, 1_000_000),
    "avg_order_value": (0, 100_000),
    "lifetime_value": (0, 1_000_000),
    "total_visits": (0, 100_000),
    "avg_session_time": (0, 10_000),
    "pages_per_session": (0, 1_000),
    "support_tickets": (0, 10_000),
    "delivery_delay_days": (-100, 1_000),
    "satisfaction_score": (0, 5),
}
_RAW_NULLABLE = {"age", "gender", "country", "total_spent", "satisfaction_score"}


def rules_for(stage: str) -> dict[str, Rule]:
    """Rules of the ``raw`` or the ``clean`` table; clean allows no nulls."""
    nullable = _RAW_NULLABLE if stage == "raw" else set()
    rules = {c: Rule("numeric", c in nullable, float(lo), float(hi)) for c, (lo, hi) in _RANGES.items()}
    rules |= {c: Rule("category", c in nullable) for c in CAT_COLS}
    return rules


RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [ID_COL, "age", *CAT_COLS]]
    + [
        T.StructField(c, T.LongType() if c in INT_COLS else T.DoubleType())
        for c in NUMERIC_COLS
        if c != "age"
    ]
)
CLEAN_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [ID_COL, *CAT_COLS]]
    + [T.StructField(c, T.LongType() if c in INT_COLS else T.DoubleType()) for c in NUMERIC_COLS]
)
ENCODED_SCHEMA = T.StructType(
    [T.StructField(ID_COL, T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in CAT_COLS]
    + [T.StructField(c, T.LongType() if c in INT_COLS else T.DoubleType()) for c in NUMERIC_COLS]
)
