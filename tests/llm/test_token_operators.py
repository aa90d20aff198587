"""Token files, token counts and packing: against the library, round trips, and on odd rows."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from campaign_engine.llm import packing, simple8b, token_counts, token_files
from campaign_engine.llm.queries import PIECES, TOKENIZER
from campaign_engine.llm.shared import scratch_path
from campaign_engine.llm.tokens import TextTokens

LIBRARY = Tokenizer.from_file(TOKENIZER)
TEXTS = [None, "", " ", "It's the DON'T", "<|startoftext|>x <|endoftext|>", "é́ İ ΣΑΣ \x1c a\x85b", "word " * 30_000, "9,99 €!!"]
SCHEMA = "doc_id long, text string"


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abC's tre ll\n\t.<|>éÉñßΣİ́中😀01_-\x1c\xa0"), st.text()), max_size=8))
def test_chunks_give_the_ids_of_whole_texts(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = _ENCODER.encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts))[: len(texts)]] == [ids_of(t) for t in texts]


_ENCODER = TextTokens(TOKENIZER, limit=50)


def test_tokenizers_of_another_form_encode_whole_texts():
    path = TOKENIZER.replace("word_bpe_49k", "byte_bpe_50k")
    other, encoder = Tokenizer.from_file(path), TextTokens(path)
    assert not encoder.by_chunk
    ids, counts = encoder.encode(pa.array(["a b  c", None]))
    assert ids.tolist() == other.encode("a b  c", add_special_tokens=False).ids and counts.tolist() == [len(ids), 0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_simple8b_round_trip(values):
    data = np.array(values, np.uint64)
    words, escapes, places = simple8b.encode(data)
    assert (simple8b.decode(words, escapes, places, len(data)) == data).all()
    assert len(places) == -(-len(data) // simple8b.BLOCK)


def test_small_ids_take_few_words():
    words, escapes, _ = simple8b.encode(np.full(1024, 5, np.uint64))
    assert len(words) == -(-1024 // 20) and not len(escapes)


def test_token_files_round_trip(spark):
    rows = [(i * 3 % 50, t) for i, t in enumerate(TEXTS * 3)] + [(None, "no id"), (1000, "last")]
    path = scratch_path(spark)
    token_files.write(spark.createDataFrame(rows, SCHEMA).withColumn("ids", F.lit(0)).repartition(5), path, TOKENIZER, end_id=2)
    got = token_files.read(spark, path).collect()
    want = {}
    for doc, text in rows:
        want.setdefault(doc, []).append([*ids_of(text), 2])
    start = 0
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    for row in ordered:
        assert row["start"] == start and row["ids"] in want[row["doc_id"]]
        want[row["doc_id"]].remove(row["ids"])
        start += len(row["ids"])
    digests = {(r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(spark, path).collect()}
    assert digests == {(r["start"], len(r["ids"]), crc(r["ids"])) for r in got}


def test_token_files_of_no_rows(spark):
    path = scratch_path(spark)
    token_files.write(spark.createDataFrame([], SCHEMA), path, TOKENIZER, end_id=2)
    assert token_files.digests(spark, path).count() == 0 and token_files.read(spark, path).count() == 0


@pytest.mark.parametrize("group", [40_000, 5])
def test_packing_keeps_all_pieces(spark, group):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "It's the DON'T"), (None, "x")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("length", F.lit(0)).withColumn("piece", F.lit(0))
    got = packing.pack(frame, TOKENIZER, size=64, end_id=0, group=group).collect()
    want = []
    for doc, text in rows:
        ids = [*ids_of(text), 0]
        want += [(str(doc), k // 64, k, len(ids[k : k + 64]), crc(ids[k : k + 64])) for k in range(0, len(ids), 64)]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(frame.limit(0), TOKENIZER).count() == 0


def test_sum_of_squares_rule_step_by_step():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 31, 400)
    sequence, offset = packing.packed(lengths, 30)
    gaps, counts = {}, np.zeros(31, int)
    for i in np.argsort(-lengths, kind="stable"):
        length = lengths[i]
        before = gaps.get(sequence[i], 30)
        assert offset[i] == 30 - before and before >= length

        def total(gap, length=length):
            after = counts.copy()
            if gap < 30 or sequence[i] in gaps:
                after[gap] -= gap < 30
            after[gap - length] += 1
            after[0] = 0
            return (after**2).sum()

        options = [total(g) for g in range(length, 30) if counts[g]] + [total(30)]
        assert total(before) == min(options)
        if before < 30:
            counts[before] -= 1
        gaps[sequence[i]] = before - length
        counts[before - length] += before > length
    assert len(gaps) <= 1.1 * -(-lengths.sum() // 30)


def test_token_counts_equal_the_library(spark, sf_dir):
    scores = token_counts.unigram_scores(PIECES)
    unknown = min(scores.values()) - token_counts.UNKNOWN_BELOW
    library = Tokenizer(models.Unigram([("<unk>", unknown), *scores.items()], unk_id=0, byte_fallback=False))
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(-1, None), (-2, ""), (-3, "  a\tb "), (-4, "x" * 5000), (-5, "x" * 5000)]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("t", F.lit(0)).withColumn("n_tokens", F.lit(0))
    got = {r["doc_id"]: r for r in token_counts.counted(frame, PIECES).collect()}
    for doc, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        tokens = [t for w in words for t in library.encode("▁" + w, add_special_tokens=False).tokens]
        assert got[doc]["score"] == pytest.approx(sum(scores.get(t, unknown) for t in tokens), rel=1e-9, abs=1e-9)
        assert got[doc]["n_tokens"] == len(tokens)
    assert token_counts.counted(frame.limit(0), PIECES).count() == 0


def test_trie_shares_prefixes_and_forgets_within_bounds():
    trie = token_counts.Trie({"▁": -3.0, "▁a": -1.0, "b": -2.0, "▁ab": -2.5, "bc": -1.0}, limit=3)
    trie.insert(["abc", "ab"])
    assert trie.known == {"ab": (1, -2.5), "abc": (2, -2.0)}
    trie.insert(["b", "zz"])
    assert set(trie.known) == {"b", "zz"} and trie.known["zz"][0] == 3


def test_scores_do_not_depend_on_their_batch():
    import pyarrow as pa

    from campaign_engine.llm import token_counts
    from campaign_engine.llm.queries import PIECES

    trie = token_counts.Trie(token_counts.unigram_scores(PIECES))
    rng = __import__("random").Random(3)
    texts = ["", " "] + [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 60))) for _ in range(200)] + [""]
    together = trie.totals(pa.array(texts, pa.large_string()))
    alone = [trie.totals(pa.array([t], pa.large_string())) for t in texts]
    assert together[0].tolist() == [a[0][0] for a in alone] and together[1].tolist() == [a[1][0] for a in alone]


def test_equal_rows_are_dealt_to_all_groups(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text")
    rows = packing.pack(docs, TOKENIZER, size=16, end_id=0, group=300).selectExpr("sequence_id >> 40 as g", "length").groupBy("g").count().collect()
    assert len(rows) == 10 and max(r["count"] for r in rows) < 450
