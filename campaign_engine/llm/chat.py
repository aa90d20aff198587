"""Logged conversations collapsed to maximal ones and rendered as one text each.

A log often holds snapshots of a growing conversation. A rolling hash over the turns gives each prefix of a
conversation a 128-bit name. A conversation whose name is that of a proper prefix of another one is dropped by an
anti-join; of equal conversations the smallest id stays. Both sides of the join hold each name once, pre-aggregated,
so a prefix that very many conversations share is one row.

Turns are ordered by turn number, then role, then text; a null turn number comes first. A null role or text is kept
apart from an empty one in the hash and rendered as empty. Rows of one conversation that repeat exactly are one turn.
Rows without a conversation id form no conversation. A conversation is one row of the result, so its turns meet in
one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import ship, stored


def prefix_names(turns: list[tuple]) -> list[bytes]:
    """Names of the prefixes of 1, 2, ... turns (role, text)."""
    rolling, names = hashlib.blake2b(digest_size=16), []
    for parts in turns:
        for part in parts:
            data = b"" if part is None else part.encode()
            rolling.update(b"%d:" % (-1 if part is None else len(data)) + data)
        names.append(rolling.copy().digest())
    return names


def _named(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        names = [prefix_names([(t["role"], t["text"]) for t in turns]) for turns in batch.to_pylist()]
        yield pa.array(names, pa.list_(pa.binary()))


def maximal(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """(id_col, turns, copies): conversations that aren't prefixes of others, with how many equal ones were logged.

    ``turns`` is an array of structs (turn, role, text).
    """
    ship(turns.sparkSession)
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).alias("t")
    ).distinct()
    whole = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    named = stored(whole.withColumn("names", F.arrow_udf(_named, "array<binary>")("turns")))
    own = named.groupBy(F.element_at("names", -1).alias("name")).agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    earlier = named.select(F.explode(F.slice("names", F.lit(1), F.size("names") - 1)).alias("name")).distinct()
    kept = own.join(earlier, "name", "left_anti").select("id", "copies")
    return named.select("id", "turns").join(kept, "id").withColumnRenamed("id", id_col)


def rendered(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    before: str = "<|", after: str = "|>\n", end: str = "\n",
) -> DataFrame:
    """(id_col, n_turns, copies, text): each maximal conversation as ``before role after text end`` of all its turns."""
    kept = maximal(turns, id_col, turn_col, role_col, text_col)
    line = lambda t: F.concat(F.lit(before), F.coalesce(t["role"], F.lit("")), F.lit(after), F.coalesce(t["text"], F.lit("")), F.lit(end))
    return kept.select(
        id_col, F.size("turns").cast("long").alias("n_turns"), "copies", F.array_join(F.transform("turns", line), "").alias("text")
    )
