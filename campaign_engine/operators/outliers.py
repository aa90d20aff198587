"""IQR fences: bounds, clipping and reports. Bounds are literals, so everything after them is one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.functions.numeric import known, outside
from campaign_engine.operators.columns import clip_columns
from campaign_engine.operators.order_stats import EXACT_ROWS, approximate_quantiles, column_quantiles
from campaign_engine.operators.shape import rows_from


@dataclass(frozen=True)
class Fence:
    q1: float
    median: float
    q3: float

    @property
    def iqr(self) -> float:
        return self.q3 - self.q1

    @property
    def low(self) -> float:
        return self.q1 - 1.5 * self.iqr

    @property
    def high(self) -> float:
        return self.q3 + 1.5 * self.iqr


def fences(
    df: DataFrame, cols: Sequence[str], exact: bool = True, limit: int = EXACT_ROWS, rows: int | None = None
) -> dict[str, Fence]:
    """Quartiles of all columns; columns without values are left out."""
    present = [c for c in cols if c in df.columns]
    probs = [0.25, 0.5, 0.75]
    found = column_quantiles(df, present, probs, limit, rows) if exact else approximate_quantiles(df, present, probs)
    return {c: Fence(*q) for c, q in found.items() if q is not None}


def iqr_bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, q1, q3, low, high)."""
    rows = [(c, f.q1, f.q3, f.low, f.high) for c, f in fences(df, cols).items()]
    return df.sparkSession.createDataFrame(rows, "column string, q1 double, q3 double, low double, high double")


def winsorize_iqr(
    df: DataFrame, cols: Sequence[str], skip_zero: bool = True, found: Mapping[str, Fence] | None = None
) -> DataFrame:
    """Clip to the fences; with ``skip_zero`` a column whose IQR is 0 stays as it is."""
    found = fences(df, cols) if found is None else found
    bounds = {c: (f.low, f.high) for c, f in found.items() if not (skip_zero and f.iqr == 0)}
    return clip_columns(df, bounds) if bounds else df


def _value(c: str) -> Column:
    return known(F.col(c).cast("double"))


def winsor_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bounds (3 places) and outliers before and after clipping."""
    found = fences(df, cols)
    clipped = winsorize_iqr(df.select(*[_value(c).alias(c) for c in found]), cols, False, found)
    both = clipped.agg(*[F.count_if(outside(F.col(c), f.low, f.high)).alias(f"{c}_after") for c, f in found.items()])
    before = df.agg(*[F.count_if(outside(_value(c), f.low, f.high)).alias(f"{c}_before") for c, f in found.items()])
    one_row = before.withColumns({f"{c}_after": both.select(f"{c}_after").scalar() for c in found})
    return rows_from(one_row, {
        c: {
            "low": F.lit(round(f.low, 3)),
            "high": F.lit(round(f.high, 3)),
            "outliers_before": F.col(f"{c}_before"),
            "outliers_after": F.col(f"{c}_after"),
        }
        for c, f in found.items()
    })


def outlier_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Outliers and fences per column, most outliers first."""
    found = fences(df, cols)
    one_row = df.agg(*[F.count_if(outside(_value(c), f.low, f.high)).alias(c) for c, f in found.items()])
    report = rows_from(one_row, {
        c: {"outliers": F.col(c), "low": F.lit(f.low), "high": F.lit(f.high)} for c, f in found.items()
    })
    return report.orderBy(F.desc("outliers"), "column")


def outliers(df: DataFrame, col: str, fence: Fence | None = None) -> DataFrame:
    """Rows outside the fences of a column."""
    fence = fence or fences(df, [col]).get(col)
    if fence is None:
        return df.filter(F.lit(False))
    return df.filter(outside(_value(col), fence.low, fence.high))


def boxplot_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the fences) and outliers per column."""
    found = fences(df, cols)
    exprs: list[Column] = []
    for c, f in found.items():
        v = _value(c)
        inside = F.when(v.between(f.low, f.high), v)
        exprs += [
            F.min(inside).alias(f"{c}_lo"),
            F.max(inside).alias(f"{c}_hi"),
            F.count_if(outside(v, f.low, f.high)).alias(f"{c}_out"),
        ]
    return rows_from(df.agg(*exprs), {
        c: {
            "q1": F.lit(f.q1),
            "median": F.lit(f.median),
            "q3": F.lit(f.q3),
            "whisker_low": F.col(f"{c}_lo"),
            "whisker_high": F.col(f"{c}_hi"),
            "outliers": F.col(f"{c}_out"),
        }
        for c, f in found.items()
    })
