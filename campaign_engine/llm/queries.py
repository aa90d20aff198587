"""Registered queries of this subpackage and, where SQL can state the same rows, that SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from campaign_engine.llm import (
    chat,
    conversation_repair,
    cutting_stock,
    decontaminate,
    near_duplicates,
    neighbours,
    packing,
    quality,
    secret_scan,
    token_counts,
    token_files,
    toxicity,
    whitening,
)
from campaign_engine.llm.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; a source is an owner and each document a repository of its own."""
    return secret_scan.scan(_table(spark, sf_dir, "documents"), owner_col="source", repository_col="doc_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents, by windows of 13 words."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), width=13)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near copies among all documents: two-word shingles, similarity of 0.8 or more."""
    return near_duplicates.groups(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op4_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to files of Simple-8b words and read back."""
    path = scratch_path(spark)
    token_files.write(_table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2)
    return token_files.digests(spark, path)


def op5_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents under a unigram model."""
    return token_counts.counted(_table(spark, sf_dir, "documents"), PIECES)


def op6_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that are no prefix of another one, rendered."""
    return chat.rendered(_table(spark, sf_dir, "conversations"))


def op7_collision_counting_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, size=2048, end_id=0)


def op11_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens, cut where that avoids padding."""
    return cutting_stock.pack(_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, size=1024, end_id=0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a rule, and their cheapest repair."""
    rows = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.Repair(rows, stays_col="stays").summary()


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened along the first eight eigenvectors of their covariance."""
    return whitening.Whitening(_table(spark, sf_dir, "embeddings"), components=8).whitened()


QUERIES: dict[str, Query] = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_simple8b_token_files": op4_simple8b_token_files,
    "op5_trie_token_counts": op5_trie_token_counts,
    "op6_snapshot_collapse": op6_snapshot_collapse,
    "op7_collision_counting_search": op7_collision_counting_search,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_sum_of_squares_packing": op10_sum_of_squares_packing,
    "op11_cutting_stock_packing": op11_cutting_stock_packing,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_embedding_whitening": op13_embedding_whitening,
}
SQL: dict[str, str] = {
    "op6_snapshot_collapse": """
with turns as (select distinct conv_id, turn, role, text from conversations where conv_id is not null),
ordered as (
  select conv_id, row_number() over w as k,
         string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '') over w as text,
         sha256(string_agg(
           case when role is null then '-1:' else strlen(role)::varchar || ':' || role end
           || case when text is null then '-1:' else strlen(text)::varchar || ':' || text end, '') over w) as name
  from turns window w as (partition by conv_id order by turn nulls first, role nulls first, text nulls first
                          rows between unbounded preceding and current row)),
sizes as (select conv_id, max(k) as n from ordered group by conv_id),
whole as (select o.conv_id, o.text, o.name, s.n from ordered o join sizes s on o.conv_id = s.conv_id and o.k = s.n),
prefixes as (select distinct o.name from ordered o join sizes s on o.conv_id = s.conv_id where o.k < s.n),
firsts as (select name, min(conv_id) as conv_id, count(*) as copies from whole group by name)
select w.conv_id, w.n as n_turns, f.copies, w.text
from firsts f join whole w on w.conv_id = f.conv_id
where f.name not in (select name from prefixes)
""",
}


def load() -> tuple[dict[str, Query], dict[str, str]]:
    return dict(QUERIES), dict(SQL)
