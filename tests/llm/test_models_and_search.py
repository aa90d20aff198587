"""Toxicity, quality, vector search, conversations, pipeline: held-out accuracy, recall, plain versions, odd rows."""

import glob
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from campaign_engine.llm import chat, ftrl, neighbours, quality, toxicity
from campaign_engine.llm.queries import QUERIES, SQL
import brute

BIG = "/root/testdata/sf0.1"


@pytest.mark.parametrize("name, label, folds, fold", [("op8_toxicity", "toxic", 4, 2), ("op9_quality", "quality", 5, 0)])
def test_held_out_accuracy(spark, name, label, folds, fold):
    rows = QUERIES[name](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r[label] for r in held]) > 0.97
    for value in (0, 1):
        assert np.mean([r["predicted"] for r in held if r[label] == value]) == pytest.approx(value, abs=0.12)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_odd_rows(spark, module, label):
    docs = [(i, f"you idiot moron number {i} fool" if i % 3 == 0 else f"a calm day number {i} here") for i in range(60)]
    docs += [(None, "you idiot"), (100, None), (101, ""), (5, "a calm day again"), (102, "calm " * 30_000)]
    labels = [(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (1, None), (7, 5), (3, 0), (3, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("label", F.lit(9)).withColumn("score", F.lit("x"))
    known = spark.createDataFrame(labels, f"doc_id long, {label} int")
    rows = module.scores(frame, known).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    none = module.scores(frame, known.limit(0)).collect()
    assert {r["score"] for r in none} == {0.0}
    assert module.scores(frame.limit(0), known).count() == 0


def test_held_out_labels_are_never_learnt(spark):
    docs = spark.createDataFrame([(i, f"text {i} {'bad' if i % 2 else 'good'}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    out = F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic")
    scores = [{r["doc_id"]: r["score"] for r in toxicity.scores(docs, x).collect()} for x in (labels, labels.select("doc_id", out))]
    assert scores[0] == scores[1]


def test_ftrl_rule_on_one_coordinate():
    model = ftrl.Model(alpha=0.5, beta=1.0, l1=0.0, l2=0.0, epochs=1, bits=4)
    rows = [(np.array([3, 0]), np.array([1.0, 1.0]), y) for y in (1, 1, 0)]
    z, n, w = np.zeros(2), np.zeros(2), np.zeros(2)
    for _, value, label in rows:
        w = -z / ((1 + np.sqrt(n)) / 0.5)
        g = (1 / (1 + np.exp(-w.sum())) - label) * value
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w
        n += g * g
    index, weight = ftrl.learnt(rows, model)
    assert index.tolist() == [0, 3] and weight == pytest.approx(-z / ((1 + np.sqrt(n)) / 0.5))


def plain_nearest(rows, k):
    good = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]

    def product(q, v):
        total = 0.0
        for a, b in zip(q, v):
            total += b * a
        return total

    out = {}
    for i, q in good:
        if i % 20 == 0:
            out[i] = sorted(((-product(q, v), j) for j, v in good if j != i))[:k]
    return out


def test_search_recall_and_order(spark, sf_dir):
    vectors = spark.read.parquet(f"{BIG}/embeddings.parquet")
    want = plain_nearest([(r["vec_id"], r["embedding"]) for r in vectors.collect()], 20)
    got = {}
    for r in QUERIES["op7_collision_counting_search"](spark, BIG).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], -r["score"], r["vec_id"]))
    assert set(got) == set(want)
    hits = 0
    for query, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        hits += len({f[2] for f in found} & {j for _, j in want[query]})
    assert hits / (20 * len(want)) >= 0.9


def test_search_blocks_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 40)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(6) * 8).round().__truediv__(8).tolist()) for i in range(150)]  # exact in binary: ties are ties
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.5]) for i in range(150, 200)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (204, [float("nan")] + [1.0] * 5),
             (205, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("query", F.lit(1))
    queries = frame.filter("vec_id % 20 = 0")
    got = {}
    for r in neighbours.nearest(frame, queries, k=5, slack=100).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = plain_nearest(rows, 5)
    assert {q: [(f[1], f[2]) for f in sorted(v)] for q, v in got.items()} == {q: [(-s, j) for s, j in v] for q, v in want.items()}
    few = neighbours.nearest(frame.filter("vec_id in (0, 1, 2)"), queries.filter("vec_id = 0"), k=5).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2]
    assert neighbours.nearest(frame.limit(0), queries).count() == 0 and neighbours.nearest(frame, queries.limit(0)).count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(frame.unionByName(spark.createDataFrame([(9, [1.0], 1, 1)], frame.schema)), queries)


def test_search_of_vectors_of_very_different_lengths(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHELL", 30)
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((600, 8)).round(2)
    vectors[:100] *= 1 / 64
    vectors[7] *= 1e6
    rows = [(i, (v.round(6)).tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_nearest(rows, 5)
    got = {}
    for r in neighbours.nearest(frame, frame.filter("vec_id % 20 = 0"), k=5, slack=100).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert {q: [(f[1], f[2]) for f in sorted(v)] for q, v in got.items()} == {q: [(-s, j) for s, j in v] for q, v in want.items()}
    few = 0
    for r in neighbours.nearest(frame, frame.filter("vec_id % 20 = 0"), k=5).collect():
        few += r["vec_id"] in {j for _, j in want[r["query_id"]]}
    assert few / (5 * len(want)) >= 0.9


def test_search_copies_queries_not_vectors(spark, monkeypatch):
    """With as many index blocks as tasks, every vector is shuffled once."""
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 20)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(1000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    copies = []
    plain = neighbours.F.sequence
    monkeypatch.setattr(neighbours.F, "sequence", lambda a, b: copies.append(b._jc.toString()) or plain(a, b))
    assert neighbours.nearest(frame, frame.filter("vec_id % 20 = 0"), k=3).count() == 150
    assert copies == ["0", "49"]  # of each vector one, of each query one for each of 50 blocks


def test_learner_equals_a_plain_version_on_real_texts(spark):
    """Weights and scores of both models, from a feature list in Python and a learner on dictionaries."""
    import pyarrow as pa

    docs = spark.read.parquet(f"{BIG}/documents.parquet").join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id")
    rows = docs.filter("length(text) < 3000").orderBy("doc_id").limit(150).collect()
    texts = [r["text"] or "" for r in rows] + ["", "ß ß Ünï!! !! a", "x\ty\nz " * 3]
    for model, label in ((toxicity.MODEL, "toxic"), (quality.MODEL, "quality")):
        model = ftrl.Model(**{**model.__dict__, "l1": 0.3})
        want = [brute.features(t, model) for t in texts]
        got = [dict(zip(i.tolist(), v.tolist())) for i, v in ftrl.features(pa.array(texts, pa.large_string()), model)]
        assert [set(g) for g in got] == [set(w) for w in want]
        assert all(g[i] == pytest.approx(w[i], abs=1e-12) for g, w in zip(got, want) for i in w)
        labels = [int(r[label]) for r in rows] + [0, 1, 0]
        plain = brute.ftrl(list(zip(want, labels)), model)
        lists = [(np.array(list(g)), np.array(list(g.values())), y) for g, y in zip(got, labels)]
        index, weight = ftrl.learnt([(i[np.r_[np.flatnonzero(i), np.flatnonzero(i == 0)]], v[np.r_[np.flatnonzero(i), np.flatnonzero(i == 0)]], y) for i, v, y in lists], model)
        assert set(index.tolist()) == set(plain) and len(plain) > 20
        assert all(w == pytest.approx(plain[i], abs=1e-9) for i, w in zip(index.tolist(), weight.tolist()))
        frame = spark.createDataFrame([(t,) for t in texts], "text string")
        scores = [r[0] for r in frame.select(ftrl.score(F.col("text"), list(zip(index.tolist(), weight.tolist())), model, frame)).collect()]
        expect = [1 / (1 + np.exp(-sum(plain.get(i, 0.0) * v for i, v in w.items()))) for w in want]
        assert scores == pytest.approx(expect, abs=1e-5)


def test_snapshots_collapse(spark):
    turns = [("user", "hi"), ("bot", "hello"), ("user", None), ("user", "")]
    rows = [(1, t, *turns[t]) for t in range(2)] + [(2, t, *turns[t]) for t in range(3)] + [(3, t + 5, *turns[t]) for t in range(3)]
    rows += [(4, 0, "user", "h"), (4, 1, "i", "bot"), (5, 0, *turns[3]), (6, 0, *turns[2]), (7, None, None, None), (None, 0, "user", "hi")]
    rows += [(8, 0, "user", "hi"), (8, 0, "user", "hi")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit(0)).withColumn("copies", F.lit(0))
    got = {r["conv_id"]: (r["n_turns"], r["copies"], r["text"]) for r in chat.rendered(frame).collect()}
    assert got == {
        2: (3, 2, "<|user|>\nhi\n<|bot|>\nhello\n<|user|>\n\n"), 4: (2, 1, "<|user|>\nh\n<|i|>\nbot\n"),
        5: (1, 1, "<|user|>\n\n"), 6: (1, 1, "<|user|>\n\n"), 7: (1, 1, "<|" + "|>\n\n"),
    }
    assert chat.rendered(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_gives_the_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(map(tuple, QUERIES[name](spark, sf_dir).select(columns).collect()), key=str) == sorted(result.fetchall(), key=str)


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, items = docs.columns, [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(spark.createDataFrame(stage(spark, kept[-1], sf_dir).collect(), docs.schema))
        assert kept[-1].columns == columns
    rows = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op8_toxicity"](spark, sf_dir).collect()}
    assert set(rows[1]) == {d for d, p in scores.items() if p == 0}
    groups = brute.near_groups(sorted(rows[1].items()), 5)
    assert set(rows[2]) == {d for d, (_, c) in groups.items() if d == c}
    bad = brute.contamination(rows[2].items(), items)
    assert set(rows[3]) == {d for d in rows[2] if not bad[d][4]}
    assert set(rows[4]) == set(rows[3])
    assert all(rows[4][d] == rows[3][d] for d in rows[3] if not brute.base_spans(rows[3][d]) and "[SECRET]" not in rows[4][d])
    assert not any(s for t in rows[4].values() for s in brute.base_spans(t))
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == set(rows[4])


def test_pipeline_stages_take_odd_rows(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "token=abcdefgh12 é", None, "a", 18),
            (3, "token=abcdefgh12 é", None, "a", 18), (4, "word " * 20_000, "en", "b", 100_000), (5, "a b c d e f g", "en", "b", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("label", "score", "found", "_found", "base", "examples", "id", "node", "length"):
        docs = docs.withColumn(name, F.lit("kept"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert docs.columns == columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(kept) == {None, 1, 2, 3, 4, 5} and docs.count() == 6
    assert kept[3] == "token=[SECRET] é" and kept[4] == "word " * 20_000
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == set(kept)
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
