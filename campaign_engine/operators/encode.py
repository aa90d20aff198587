"""Category codes and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from campaign_engine.operators.order_stats import EXACT_ROWS, sorted_positions
from campaign_engine.operators.shape import SMALL_ROWS, collected, long_values
from campaign_engine.session import ensure_checkpoint_dir

NULL_CLASS = "nan"


def label_dictionary(df: DataFrame, cols: Sequence[str], limit: int = EXACT_ROWS) -> DataFrame:
    """(variable, value, code): codes from 0 in code-point order; null is a class of its own.

    Few values in all are fetched once and numbered as a local table. Columns with more than ``limit`` values
    are numbered through a distributed sort instead of a window.
    """
    values = (
        long_values(df, cols, "string")
        .select("variable", F.coalesce("value", F.lit(NULL_CLASS)).alias("value"))
        .distinct()
    )
    w = Window.partitionBy("variable").orderBy("value")
    code = (F.row_number().over(w) - 1).cast("int")
    if limit >= SMALL_ROWS and (local := collected(values)) is not None:
        return local.withColumn("code", code)
    sizes = {r["variable"]: r["count"] for r in values.groupBy("variable").count().collect()}  # one row per column
    wide = [c for c, n in sizes.items() if n > limit]
    codes = values.filter(~F.col("variable").isin(wide)).withColumn("code", code)
    for c in wide:
        one = sorted_positions(values.filter(F.col("variable") == c), "value", name="code")
        codes = codes.unionByName(one.withColumn("code", F.col("code").cast("int")))
    ensure_checkpoint_dir(df.sparkSession)
    return codes.checkpoint()  # numbered once, however often it is looked up


def _attach(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], key: str, value: str) -> DataFrame:
    """Replace each column by its partner in the dictionary; the part of each small column is broadcast, the few
    wide columns are joined last."""
    order = df.columns
    local = collected(dictionary)
    parts = {c: (dictionary if local is None else local).filter(F.col("variable") == c).select(
        F.col(key).alias("_key"), F.col(value).alias("_value")) for c in cols}
    small = {c: collected(p) if local is None else p for c, p in parts.items()}
    for c in sorted(cols, key=lambda name: small[name] is None):
        part = parts[c] if small[c] is None else F.broadcast(small[c])
        side = F.coalesce(c, F.lit(NULL_CLASS)) if key == "value" else F.col(c)
        df = df.join(part, side == F.col("_key"), "left").withColumn(c, F.col("_value"))
        df = df.drop("_key", "_value")
    return df.select(*order)


def label_encode(df: DataFrame, cols: Sequence[str], dictionary: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(encoded table, dictionary)."""
    dictionary = label_dictionary(df, cols) if dictionary is None else dictionary
    return _attach(df, dictionary, cols, "value", "code"), dictionary


def label_decode(df: DataFrame, dictionary: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Readable values of coded columns; the null class comes back as its text."""
    return _attach(df, dictionary, cols, "code", "value")
