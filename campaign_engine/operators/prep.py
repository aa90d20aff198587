"""Preparation for models: scaling, repeatable splits and folds, feature vectors."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.functions.numeric import hash_number
from campaign_engine.functions.text import to_double
from campaign_engine.operators.columns import numeric_names, string_names
from campaign_engine.operators.impute import medians
from campaign_engine.operators.order_stats import CUT_ROWS, group_cuts
from campaign_engine.schemas import DERIVED_FROM, ID_COL, SEED
from campaign_engine.session import ensure_checkpoint_dir

_HASH_RANGE = float(1 << 52)


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) of each column, in one aggregation."""
    row = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
    return {c: (row[f"{c}_m"] or 0.0, row[f"{c}_s"] or 0.0) for c in cols}


def standardize(df: DataFrame, cols: Sequence[str], found: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """(x - mean) / deviation with the population deviation; a constant column becomes 0."""
    found = moments(df, cols) if found is None else found
    scaled = {}
    for c in cols:
        mean, deviation = found[c]
        scaled[c] = (F.col(c) - mean) / deviation if deviation > 0 else F.when(F.col(c).isNotNull(), 0.0)
    return df.withColumns(scaled)


def _piece(cuts: Mapping, by: str | None, value: Column) -> Column:
    """Number of the piece, from 0, into which a row's hash falls; each group has its own cuts."""
    out: Column | None = None
    for group, ends in cuts.items():
        passed = sum(((value > F.lit(e)).cast("int") for e in ends), F.lit(0))
        if by is None:
            return passed
        match = F.col(by).eqNullSafe(F.lit(group))
        out = F.when(match, passed) if out is None else out.when(match, passed)
    return F.lit(0) if out is None else out


def fit_sample(df: DataFrame, key: str, rows: int, seed: int = SEED) -> DataFrame:
    """At most ``rows`` rows to fit on: those with the smallest hash of the key, planned as a top-k."""
    hashed = df.withColumn("_hash", hash_number(F.col(key), seed))  # once a row, not in every comparison
    return hashed.orderBy("_hash", key).limit(rows).drop("_hash")


def kept_sample(df: DataFrame, key: str, rows: int, seed: int = SEED) -> DataFrame:
    """``fit_sample``, kept by a checkpoint for fits, which read it several times: the table is passed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return fit_sample(df, key, rows, seed).checkpoint()


def with_split(
    df: DataFrame,
    key: str,
    fraction: float = 0.2,
    seed: int = SEED,
    stratify: str | None = None,
    exact: bool = True,
    limit: int = CUT_ROWS,
) -> DataFrame:
    """Add ``is_test``: the same rows for any partitioning and row order.

    ``exact`` puts exactly the rounded share of each class into the test part (two small jobs, no shuffle of
    rows); otherwise each row decides by its own hash in the running pass.
    """
    value = hash_number(F.col(key), seed)
    if not exact:
        return df.withColumn("is_test", value < fraction * _HASH_RANGE)
    size = (lambda n: [round(n * fraction)]) if stratify else (lambda n: [math.ceil(n * fraction)])
    cuts = group_cuts(df, value, stratify, size, limit)
    return df.withColumn("is_test", _piece(cuts, stratify, value) == 0)


def split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = SEED, stratify: str | None = None,
          exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    marked = with_split(df, key, fraction, seed, stratify, exact)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def with_fold(
    df: DataFrame, key: str, k: int, seed: int = SEED, stratify: str | None = None, limit: int = CUT_ROWS
) -> DataFrame:
    """Add ``fold`` 0..k-1: folds of equal size within each class."""
    value = hash_number(F.col(key), seed)
    cuts = group_cuts(df, value, stratify, lambda n: [round(n * i / k) for i in range(1, k)], limit)
    return df.withColumn("fold", _piece(cuts, stratify, value).cast("int"))


def feature_names(df: DataFrame, target: str, extra: Sequence[str] = ()) -> list[str]:
    """Numeric columns without the target, ids, and columns that are computed from the target."""
    gone = {target, ID_COL, "label", "is_test", "fold", "weight", *extra}
    gone |= {c for c, source in DERIVED_FROM.items() if source == target}
    return [c for c in numeric_names(df) if c not in gone]


def assemble(df: DataFrame, cols: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=name).transform(df)


def feature_defaults(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Median per feature, 0 where there is none; stored with the model."""
    return {c: v or 0.0 for c, v in medians(df, cols).items()}


def prepare_features(df: DataFrame, defaults: Mapping[str, float], keep: Sequence[str] = ()) -> DataFrame:
    """Features in training order out of any subset of columns: parsed, and missing ones set to the default."""
    texts = set(string_names(df))
    cols = []
    for c, value in defaults.items():
        if c not in df.columns:
            cols.append(F.lit(float(value)).alias(c))
            continue
        number = to_double(F.col(c)) if c in texts else F.col(c).cast("double")
        cols.append(F.coalesce(F.when(~F.isnan(number), number), F.lit(float(value))).alias(c))
    return df.select(*keep, *cols)


def class_weights(df: DataFrame, label: str = "label") -> dict[float, float]:
    """n / (classes x rows of the class)."""
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}  # one row per class
    total = sum(counts.values())
    return {y: total / (len(counts) * n) for y, n in counts.items()}


def with_weight(df: DataFrame, weights: Mapping[float, float], label: str = "label") -> DataFrame:
    out: Column | None = None
    for y, w in weights.items():
        match = F.col(label) == F.lit(y)
        out = F.when(match, F.lit(w)) if out is None else out.when(match, F.lit(w))
    return df.withColumn("weight", F.lit(1.0) if out is None else out.otherwise(F.lit(1.0)))
