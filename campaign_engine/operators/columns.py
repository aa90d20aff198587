"""Row-wise operators on named columns: no shuffle, one projection each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.functions import numeric, text
from campaign_engine.schemas import DEFAULT_THRESHOLD, GENDER_MAP, NULL_TOKENS


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def numeric_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> DataFrame:
    return df.select(*numeric_names(df))


def _on(df: DataFrame, cols: Sequence[str], change) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: change(F.col(c)) for c in cols if c in present})


def normalize_text(df: DataFrame, cols: Sequence[str] | None = None, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Strip texts and turn null tokens into null. Two projections, so that each text is stripped once."""
    names = string_names(df) if cols is None else cols
    return _on(_on(df, names, text.strip), names, lambda c: text.without_tokens(c, tokens))


def map_values(df: DataFrame, col: str, mapping: Mapping, fallback: Column | None = None) -> DataFrame:
    """Replace values found (stripped, lower case) in the mapping, else use the fallback."""
    return df.withColumn(col, text.lookup(F.lower(text.strip(F.col(col))), mapping, fallback))


def canon_gender(df: DataFrame, col: str = "gender") -> DataFrame:
    """Known spellings to one form, anything else in title case; null stays null."""
    return map_values(df, col, GENDER_MAP, text.title(text.strip(F.col(col))))


def title_case(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _on(df, cols, lambda c: text.title(text.strip(c)))


def fill_constant(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    return df.fillna(dict(values))


def to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Texts to double, anything unparseable and NaN to null; numeric columns keep their type."""
    kinds = {f.name: f.dataType for f in df.schema}

    def convert(c: str) -> Column:
        if isinstance(kinds[c], T.StringType):
            return text.to_double(F.col(c))
        return numeric.known(F.col(c)) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else F.col(c)

    return df.withColumns({c: convert(c) for c in cols if c in kinds})


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: numeric.clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in bounds.items()})


def round_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _on(df, cols, numeric.round_int)


def trunc_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _on(df, cols, lambda c: c.cast("int"))


def round_cols(df: DataFrame, cols: Sequence[str], places: int) -> DataFrame:
    """Round to decimal places; whole numbers keep their type."""
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
    return _on(df, [c for c in cols if c not in whole], lambda c: numeric.round_places(c, places))


def narrow_types(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """double to float; integers to the smallest type that holds their range (one aggregation)."""
    kinds = {f.name: f.dataType for f in df.schema if f.name in cols}
    whole = [c for c, k in kinds.items() if isinstance(k, T.IntegralType)]
    narrowed = {c: F.col(c).cast("float") for c, k in kinds.items() if isinstance(k, T.DoubleType)}
    if whole:
        row = df.agg(*[e for c in whole for e in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]).first()
        for c in whole:
            low, high = row[f"{c}_lo"] or 0, row[f"{c}_hi"] or 0
            fits = [t for t, bits in (("byte", 7), ("short", 15), ("int", 31)) if -(1 << bits) <= low and high < 1 << bits]
            narrowed[c] = F.col(c).cast(fits[0] if fits else "long")
    return df.withColumns(narrowed)


def flip_target(df: DataFrame, col: str) -> DataFrame:
    """Make the other class the positive one."""
    return df.withColumn(col, F.lit(1) - F.col(col))


def flag_targets(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, score: str = "conversion_score") -> DataFrame:
    return df.withColumn("is_target", F.col(score) >= threshold)


def band_scores(df: DataFrame, score: str = "conversion_score") -> DataFrame:
    """ALTO from 0.70, MEDIO from 0.45, else BAJO."""
    c = F.col(score)
    return df.withColumn("score_band", F.when(c >= 0.70, "ALTO").when(c >= 0.45, "MEDIO").otherwise("BAJO"))


def with_status(metrics: DataFrame, auc: str = "roc_auc") -> DataFrame:
    """Reading of a model's AUC. Scale from .65, monitor from .58, goal .75."""
    c = F.col(auc)
    return metrics.withColumns({
        "status": F.when(c >= 0.65, "scale").when(c >= 0.58, "monitor").otherwise("improve"),
        "goal_reached": F.coalesce(c >= 0.75, F.lit(False)),
    })


def label_values(df: DataFrame, col: str, mapping: Mapping, name: str | None = None) -> DataFrame:
    """Readable label of a code; codes without a label show as their own text."""
    return df.withColumn(name or f"{col}_label", text.lookup(F.col(col), mapping, F.col(col).cast("string")))


def concat_label(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    return df.withColumn(name, F.concat_ws(" | ", a, b))


def minmax_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column stays as it is."""
    row = df.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]).first()
    scaled = {}
    for c in cols:
        low, high = row[f"{c}_lo"], row[f"{c}_hi"]
        if low is not None and high > low:
            scaled[c] = (F.col(c) - float(low)) / (float(high) - float(low))
    return df.withColumns(scaled) if scaled else df


def with_share(counts: DataFrame, col: str, name: str = "share") -> DataFrame:
    """Share of each group in an aggregated table; the total is a scalar subquery, so any number of groups will do."""
    return counts.withColumn(name, F.col(col) / counts.agg(F.sum(col)).scalar())


def null_mask(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[F.col(c).isNull().alias(c) for c in df.columns if c != key])


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter(numeric.outside(F.col(col), low, high))


def not_in(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Known values outside the allowed set."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
