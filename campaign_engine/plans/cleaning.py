"""Raw table to clean table, in two profiles.

Statistics (medians, modes, fences) come from a few aggregations that bring back one row each; all else is
a chain of projections that Catalyst fuses into one. Persist the raw table, or keep it in a columnar file,
since every statistic scans its own columns of it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.operators import columns, impute, outliers
from campaign_engine.operators.encode import label_encode
from campaign_engine.operators.fx import fx_enrich, rate_column
from campaign_engine.schemas import (
    CAT_COLS,
    COUNTRY_MISSING,
    ID_COL,
    INT_COLS,
    NUMERIC_COLS,
    NUMERIC_NULL_TOKENS,
    TARGET_COL,
    UNKNOWN,
    UNROUNDED_COLS,
    WINSOR_COLS,
)
from campaign_engine.session import in_parallel

MONEY_COLS = ["total_spent", "avg_order_value"]


def normalized(df: DataFrame) -> DataFrame:
    """Texts stripped and without null tokens, gender in one spelling, numbers parsed."""
    texts = [c for c in columns.string_names(df) if c != ID_COL]
    out = columns.normalize_text(df, texts)
    if "gender" in df.columns:
        out = columns.canon_gender(out)
    return columns.to_numeric(out, NUMERIC_COLS)


def imputed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Medians, group median of the spend (by the category before its own nulls are filled) and modes."""
    plain = [c for c in NUMERIC_COLS if c in df.columns and c != "total_spent"]
    present = [c for c in CAT_COLS if c in df.columns]

    def spent() -> DataFrame:
        return impute.impute_group_median(df, "total_spent", TARGET_COL, rows=rows) if "total_spent" in df.columns else df

    found, common, out = in_parallel(
        [lambda: impute.medians(df, plain, rows=rows), lambda: impute.modes(df, present), spent]
    )
    out = out.withColumns({c: F.coalesce(c, F.lit(common.get(c, UNKNOWN))) for c in present})
    return impute.fill_numbers(out, found)


def _bootstrap(df: DataFrame, rates: DataFrame | None, as_of: datetime | None) -> DataFrame:
    rows = df.count()
    filled = imputed(normalized(df), rows)
    clipped = outliers.winsorize_iqr(filled, WINSOR_COLS, found=outliers.fences(filled, WINSOR_COLS, rows=rows))
    return fx_enrich(columns.round_int(clipped, INT_COLS), rate_column(rates, as_of), MONEY_COLS)


def _notebook(df: DataFrame) -> DataFrame:
    parsed = columns.to_numeric(columns.normalize_text(df, ["age"], NUMERIC_NULL_TOKENS), NUMERIC_COLS)
    filled = impute.impute_median(parsed, ["age", "satisfaction_score"])
    filled = columns.trunc_int(filled, ["age"])
    filled = impute.impute_group_median(filled, "total_spent", TARGET_COL)
    clipped = outliers.winsorize_iqr(filled, WINSOR_COLS, skip_zero=False)
    rounded = columns.round_cols(
        columns.round_int(clipped, INT_COLS), [c for c in NUMERIC_COLS if c not in UNROUNDED_COLS], 3
    )
    gender = columns.title_case(rounded, ["gender"])
    gender = columns.normalize_text(gender, ["gender"], ["Nan", "None", ""])
    named = columns.fill_constant(gender, {"gender": UNKNOWN, "country": COUNTRY_MISSING})
    titled = columns.title_case(named, ["acquisition_channel", TARGET_COL, "payment_method"])
    return columns.select_existing(titled, [ID_COL, *NUMERIC_COLS, *CAT_COLS])


def clean(
    df: DataFrame, profile: str = "bootstrap", rates: DataFrame | None = None, as_of: datetime | None = None
) -> DataFrame:
    """Clean table. ``bootstrap`` keeps all columns and adds USD amounts; ``notebook`` keeps 20 columns."""
    if profile == "bootstrap":
        return _bootstrap(df, rates, as_of)
    if profile == "notebook":
        return _notebook(df)
    raise ValueError(f"unknown cleaning profile {profile!r}")


def encoded(cleaned: DataFrame, profile: str = "bootstrap") -> tuple[DataFrame, DataFrame]:
    """(coded table, dictionary): all string columns but the id, or the five categories."""
    cols = CAT_COLS if profile == "notebook" else [c for c in columns.string_names(cleaned) if c != ID_COL]
    return label_encode(cleaned, [c for c in cols if c in cleaned.columns])
