"""Cutting-stock packing: patterns, plans and pieces against exact counts, the library's ids, and odd rows."""

import random
import zlib
from collections import Counter
from fractions import Fraction
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campaign_engine.llm import byte_tokens, cutting_stock
from campaign_engine.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts, end_id=0):
    encoder = Tokenizer.from_file(PATH)
    return [e.ids + [end_id] for e in encoder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def padding_of(fills, size):
    return sum(0 if f & (f - 1) == 0 else size - f for f in fills)


def check_pieces(rows, ids, size, names=None):
    """Pieces cover each document's ids once, sequences have no holes; gives (padding, cuts beyond full pieces)."""
    documents, sequences = {}, {}
    for r in rows:
        documents.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    cuts = 0
    for name, want in enumerate(ids) if names is None else zip(names, ids):
        at = 0
        own = sorted(documents.pop(name), key=lambda r: r["start"])
        for r in own:
            part = want[r["start"] : r["start"] + r["length"]]
            assert r["start"] == at and r["length"] == len(part) > 0 and r["doc_tokens"] == len(want)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
        assert at == len(want)
        cuts += len(own) - -(-len(want) // size)
    assert not documents
    fills = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
        fills.append(at)
    return padding_of(fills, size), cuts, len(fills)


def test_query_has_the_library_ids_and_no_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    ids = library_ids([r["text"] for r in docs])
    rows = QUERIES["op11_cutting_stock_packing"](spark, sf_dir).collect()
    padding, cuts, _ = check_pieces(rows, ids, 1024, [r["doc_id"] for r in docs])
    assert padding == 0 and cuts < len(docs) / 5


@pytest.mark.parametrize("few", [200_000, 0])
def test_odd_texts_ids_and_columns(spark, few):
    rng = random.Random(2)
    words = ["the", " cat", "é", "日本", "  ", "\n", "<|endoftext|>", "<|endo", "12345", "'ll", "!?", "a" * 30, "\t\t "]
    texts = [None, "", " ", "<|endoftext|>", " " * 5000, "x" * 9000] + ["".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit(1) for c in ("ids", "block", "nth", "length", "start")})
    out = cutting_stock.pack(frame.repartition(5), PATH, size=64, with_ids=True, few=few)
    rows = out.collect()
    padding, cuts, _ = check_pieces(rows, library_ids(texts), 64)
    assert padding == 0 and cuts < len(texts) / 3
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    repeated = spark.createDataFrame([(None, "one two"), (None, "one two"), (5, None), (5, "")], "doc_id long, text string")
    assert sorted(r["length"] for r in cutting_stock.pack(repeated, PATH, size=1024).collect()) == [1, 1, 3, 3]
    assert cutting_stock.pack(frame.limit(0), PATH).collect() == []


def test_one_length_of_all_rows_runs_on_without_padding(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("word " * 36).alias("text")).repartition(7)
    rows = cutting_stock.pack(docs, PATH, size=64).collect()
    padding, _, sequences = check_pieces(rows, library_ids(["word " * 36]) * 600, 64)
    tokens = sum(r["length"] for r in rows)
    assert padding == 0 and sequences <= tokens // 64 + 6


def check_plan(histogram, size):
    plan = cutting_stock.planned(histogram, size)
    filled, seen = Counter(), {}
    for length, count in histogram.items():
        tail = int(plan.tail[length])
        assert 0 <= tail <= count
        ranks = np.arange(tail)
        places = list(zip(*(p.tolist() for p in plan.whole(np.full(tail, length), ranks)))) if tail else []
        places = [(s, o, length) for s, o in places] + [(s, o, n) for r in range(tail, count) for _, n, s, o in plan.parts(length, r)]
        for sequence, offset, n in places:
            seen.setdefault(sequence, []).append((offset, n))
            filled[sequence] += n
    for parts in seen.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size
    assert sum(filled.values()) == sum(k * v for k, v in histogram.items())
    assert padding_of(filled.values(), size) == 0
    return plan


def test_plans_hold_all_pieces(spark):
    rng = random.Random(7)
    cases = [{}, {1024: 5}, {700: 1000}, {1: 9}, {1023: 3, 1: 1}, {512: 3}, {3: 1}, {340: 10, 344: 5, 1024: 2, 999: 1}]
    cases += [dict(Counter(rng.randint(1, 1024) for _ in range(n))) for n in (5, 60, 700, 5000)]
    for case in cases:
        check_plan(case, 1024)
    check_plan(dict(Counter(rng.randint(1, 50) for _ in range(300))), 50)


def test_whole_patterns_take_nearly_all_pieces():
    rng = np.random.default_rng(3)
    lengths = rng.lognormal(6.6, 0.9, 40_000).astype(int) % 1023 + 1
    plan = check_plan({int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}, 1024)
    assert plan.tail_tokens < 0.02 * lengths.sum()


def test_linear_program_is_optimal_on_small_histograms():
    """Against the least padding over all patterns, from the dual: no pattern of any fill is worth more than it costs."""
    rng = random.Random(11)
    for _ in range(8):
        size = 16
        lengths = np.array(sorted(rng.sample(range(2, 16), 4)))
        counts = np.array([rng.randint(1, 30) for _ in lengths], float)
        patterns, amounts = cutting_stock.plan_patterns(lengths, counts, size, tolerance=0)
        assert np.allclose(patterns.T @ amounts, counts) and (amounts >= 0).all()
        cost = cutting_stock.padding(patterns @ lengths, size) @ amounts
        every = {tuple(np.bincount(c, minlength=4)) for n in range(1, 17) for c in combinations_with_replacement(range(4), n)
                 if lengths[list(c)].sum() <= size}
        best = least_padding(np.array(sorted(every), float), cutting_stock.padding(np.array(sorted(every)) @ lengths, size).astype(float), counts)
        assert cost <= best + 1e-6


def least_padding(columns, cost, counts):
    """A plain simplex method with Bland's rule, in exact fractions, over all listed patterns."""
    columns, cost, counts = ([[Fraction(int(v)) for v in c] for c in columns], [Fraction(int(v)) for v in cost], [Fraction(int(v)) for v in counts])
    m = len(counts)
    basis = [columns.index([Fraction(int(i == j)) for j in range(m)]) for i in range(m)]
    table = [[c[i] for c in columns] + [counts[i]] for i in range(m)]
    while True:
        reduced = [cost[j] - sum(cost[basis[i]] * table[i][j] for i in range(m)) for j in range(len(columns))]
        enter = next((j for j, r in enumerate(reduced) if r < 0), None)
        if enter is None:
            return float(sum(cost[basis[i]] * table[i][-1] for i in range(m)))
        _, _, leave = min((table[i][-1] / table[i][enter], basis[i], i) for i in range(m) if table[i][enter] > 0)
        pivot = table[leave][enter]
        table[leave] = [v / pivot for v in table[leave]]
        for i in range(m):
            if i != leave and table[i][enter]:
                table[i] = [v - table[i][enter] * w for v, w in zip(table[i], table[leave])]
        basis[leave] = enter


def test_byte_encoder_equals_the_library():
    encoder = byte_tokens.encoder(PATH)
    assert isinstance(encoder, byte_tokens.ByteTokens)
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([rng.randint(1, 255), rng.randint(32, 126), rng.randint(256, 0x2FFF), 0x1F600])) for _ in range(rng.randint(0, 80)))
             for _ in range(500)] + ["a  <|endoftext|> b", None, " " * 3000]
    ids, counts = encoder.encode(pa.array(texts))
    want = [i[:-1] for i in library_ids(texts)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert not isinstance(byte_tokens.encoder(public_tokenizers.path("word_bpe_49k.json")), byte_tokens.ByteTokens)
