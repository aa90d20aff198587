"""Row identity, samples and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_engine.functions.numeric import hash_number
from campaign_engine.operators.order_stats import EXACT_ROWS, group_cuts, sorted_positions
from campaign_engine.schemas import ID_COL, SEED

TOP_ROWS = 100_000


def with_client_id(df: DataFrame, key: str) -> DataFrame:
    """Put ``client_id`` first: from a numeric key directly, from any other (unique) key by its sort position."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return df.select(F.format_string("C-%05d", F.col(key).cast("long") + 1).alias(ID_COL), *df.columns)
    numbered = sorted_positions(df, key, name="_position")
    return numbered.select(F.format_string("C-%05d", F.col("_position") + 1).alias(ID_COL), *df.columns)


def sample_rows(df: DataFrame, key: str, cap: int, seed: int = SEED, limit: int = EXACT_ROWS) -> DataFrame:
    """Uniform sample of exactly ``cap`` rows: those with the smallest hash of the (unique) key.

    Small samples come from one top-k; large ones from the exact cut-off hash, so they stay distributed.
    """
    rank = hash_number(F.col(key), seed)
    if cap <= TOP_ROWS:
        return df.orderBy(rank, key).limit(cap)
    cut = group_cuts(df, rank, None, lambda n: [min(cap, n)], limit).get("all", [0.0])[0]
    return df.filter(rank <= cut)


def head_sample(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return df.orderBy(key).limit(n)
