"""Small plan-shaping helpers used by the other operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

SMALL_ROWS = 10_000
SMALL_BYTES = 16 << 20
BROADCAST_ROWS = 100_000  # of numbers only


def collected(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame | None:
    """The rows as a local table if there are at most ``max_rows`` with ``SMALL_BYTES`` of text, else None.

    One job: the sum of text bytes over the first rows decides whether any of them are fetched.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    first = df.limit(max_rows + 1)
    if texts:
        length = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in texts), F.lit(0))
        first = first.withColumn("_bytes", F.sum(length).over(Window.partitionBy()))
        first = first.filter(F.col("_bytes") <= SMALL_BYTES).drop("_bytes")
    rows = first.collect()
    if not rows or len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def bounded_broadcast(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a lookup table that is small in rows and bytes, else leave the join to the optimizer, which
    sorts and merges large sides and splits partitions that a frequent key makes too large."""
    local = collected(df, max_rows)
    return df if local is None else F.broadcast(local)


def join_frequent(df: DataFrame, right: DataFrame, value: Column, key: str, count: str) -> DataFrame:
    """Left join of ``value`` with ``right``, which has each key once and in ``count`` how many rows of ``df`` have it.

    Up to ``BROADCAST_ROWS`` keys are broadcast. Of more keys, those that each hold over a thousandth of all rows,
    at most a thousand, are broadcast, so that their rows aren't shuffled; the others are joined by a shuffle.
    """
    rows, total = right.agg(F.count("*"), F.sum(count)).first()
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(right), value == F.col(key), "left")
    frequent = F.col(count) > (total or 0) // 1000
    hot = right.filter(frequent)
    among_hot = df.join(F.broadcast(hot), value == F.col(key))
    others = df.join(F.broadcast(hot.select(key)), value == F.col(key), "left_anti")
    return among_hot.unionByName(others.join(right.filter(~frequent), value == F.col(key), "left"))


def rows_from(one_row: DataFrame, items: Mapping[str, Mapping[str, Column]], key: str = "column") -> DataFrame:
    """Turn the one wide row of an aggregation into one row per item."""
    structs = [
        F.struct(F.lit(name).alias(key), *[c.alias(field) for field, c in fields.items()])
        for name, fields in items.items()
    ]
    return one_row.select(F.inline(F.array(*structs)))


def long_values(df: DataFrame, cols: Sequence[str], kind: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, value) with all columns cast to one type."""
    wide = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "variable", "value")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long."""
    return df.unpivot(list(ids), list(values), variable, value)


def stack_tagged(frames: Mapping[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """Rows of all frames with a column that names their origin."""
    stacked: DataFrame | None = None
    for name, df in frames.items():
        tagged = df.withColumn(tag, F.lit(name))
        stacked = tagged if stacked is None else stacked.unionByName(tagged)
    if stacked is None:
        raise ValueError("no frames to stack")
    return stacked


def overlay(df: DataFrame, right: DataFrame, on: str, cols: Sequence[str]) -> DataFrame:
    """Take the right value of each column where it is known, else keep the left one."""
    helper = right.select(on, *[F.col(c).alias(f"{c}_readable") for c in cols])
    joined = df.join(helper, on, "left")
    present = set(df.columns)
    filled = {
        c: F.coalesce(F.col(f"{c}_readable"), F.col(c).cast("string")) if c in present else F.col(f"{c}_readable")
        for c in cols
    }
    return joined.withColumns(filled).drop(*[f"{c}_readable" for c in cols])


def join_suffixed(a: DataFrame, b: DataFrame, on: str, suffixes: tuple[str, str]) -> DataFrame:
    """Inner equi-join; all other columns of both sides get a suffix."""
    left, right = (
        df.select(on, *[F.col(c).alias(c + s) for c in df.columns if c != on]) for df, s in zip((a, b), suffixes)
    )
    return left.join(right, on)


def with_constants(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the values of a one-row table on every row, as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})
