"""Exchange rates on money columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.functions.numeric import round_places
from campaign_engine.schemas import FX_BASE, FX_FALLBACK, FX_QUOTE, FX_TTL_HOURS


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def resolve_rate(
    rates: DataFrame,
    as_of: datetime,
    ttl_hours: int = FX_TTL_HOURS,
    fallback: float = FX_FALLBACK,
    base: str = FX_BASE,
    quote: str = FX_QUOTE,
) -> DataFrame:
    """One row (rate, origin): the latest positive rate within the TTL, else the latest older one, else the fallback.

    ``as_of`` without a time zone is UTC, like times in the rates table; the session's zone does not matter.
    """
    moment = F.lit(str(_utc(as_of))).cast("timestamp_ntz")
    at = F.col("as_of")
    if isinstance(rates.schema["as_of"].dataType, T.TimestampType):
        at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))
    usable = rates.filter((F.col("base") == base) & (F.col("quote") == quote) & (F.col("rate") > 0) & (at <= moment))
    fresh = at >= moment - F.make_dt_interval(hours=F.lit(ttl_hours))
    found = usable.agg(
        F.max_by(F.when(fresh, F.col("rate")), F.when(fresh, at)).alias("fresh"),
        F.max_by("rate", at).alias("latest"),
    )
    return found.select(
        F.coalesce("fresh", "latest", F.lit(fallback)).alias("rate"),
        F.when(F.col("fresh").isNotNull(), "fresh")
        .when(F.col("latest").isNotNull(), "stale")
        .otherwise("fallback")
        .alias("origin"),
    )


def fx_enrich(df: DataFrame, rate: Column, cols: Sequence[str], base: str = FX_BASE, quote: str = FX_QUOTE) -> DataFrame:
    """Add the rate and each money column divided by it, rounded to cents."""
    name = f"fx_{base}_to_{quote}".lower()
    out = df.withColumn(name, rate)
    return out.withColumns({f"{c}_{base.lower()}": round_places(F.col(c) / F.col(name), 2) for c in cols if c in df.columns})


def rate_column(rates: DataFrame | None, as_of: datetime | None) -> Column:
    """The resolved rate as a scalar subquery, or the fallback without a rates table."""
    if rates is None or as_of is None:
        return F.lit(FX_FALLBACK)
    return resolve_rate(rates, as_of).select("rate").scalar()
