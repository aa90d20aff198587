"""Fill missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.operators.order_stats import EXACT_ROWS, approximate_quantiles, column_quantiles, group_quantiles
from campaign_engine.operators.shape import bounded_broadcast, long_values
from campaign_engine.schemas import UNKNOWN


def medians(
    df: DataFrame, cols: Sequence[str], exact: bool = True, limit: int = EXACT_ROWS, rows: int | None = None
) -> dict[str, float | None]:
    """Median of each column, all in one pass over the data while it is small."""
    found = column_quantiles(df, cols, [0.5], limit, rows) if exact else approximate_quantiles(df, cols, [0.5])
    return {c: None if q is None else q[0] for c, q in found.items()}


def fill_numbers(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    known = {c: v for c, v in values.items() if v is not None}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in known.items()})


def impute_median(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return fill_numbers(df, medians(df, present, exact)) if present else df


def fill_group_median(df: DataFrame, col: str, by: str, limit: int = EXACT_ROWS, rows: int | None = None) -> DataFrame:
    """Fill nulls with the median of the row's group; known values and null groups stay."""
    stats = group_quantiles(df.filter(F.col(by).isNotNull()), col, [by], [0.5], limit, rows)
    small = bounded_broadcast(stats.select(F.col(by).alias("_group"), F.col("q")[0].alias("_median")))
    joined = df.join(small, F.col(by) == F.col("_group"), "left")
    return joined.withColumn(col, F.coalesce(F.col(col).cast("double"), "_median")).drop("_group", "_median")


def impute_group_median(df: DataFrame, col: str, by: str, limit: int = EXACT_ROWS, rows: int | None = None) -> DataFrame:
    """Group median first, then the median of the column as filled so far."""
    filled = fill_group_median(df, col, by, limit, rows) if by in df.columns else df
    return fill_numbers(filled, medians(filled, [col], limit=limit, rows=rows))


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value of each column, the smallest on a tie. Counting is distributed over the values."""
    counts = long_values(df, cols, "string").filter(F.col("value").isNotNull()).groupBy("variable", "value").count()
    best = counts.groupBy("variable").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value"))
    return {r["variable"]: r["value"] for r in best.collect()}  # one row per column


def impute_mode(df: DataFrame, cols: Sequence[str], empty: str = UNKNOWN) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    found = modes(df, present)
    return df.withColumns({c: F.coalesce(c, F.lit(found.get(c, empty))) for c in present})


def with_group_stat(df: DataFrame, col: str, by: str, name: str, limit: int = EXACT_ROWS) -> DataFrame:
    """The median of the row's group on every row; rows without a group get null."""
    stats = group_quantiles(df.filter(F.col(by).isNotNull()), col, [by], [0.5], limit)
    small = bounded_broadcast(stats.select(F.col(by).alias("_group"), F.col("q")[0].alias(name)))
    return df.join(small, F.col(by) == F.col("_group"), "left").drop("_group")
