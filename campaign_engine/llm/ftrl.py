"""Binary labels of texts by logistic regression over hashed word n-grams, learnt by FTRL-proximal updates.

Features are hashes of words, of runs of ``grams`` consecutive words and of pairs with ``skips`` words left out; with
``stem``, also of the words' first bytes, so that forms of one word share a weight.
Words are runs of letters and digits; with ``symbols``, runs of other signs are words too, case is kept and a word
like the one before is replaced by a mark, so that repetition is visible. A feature's value is 1, or with ``scaled``
its count divided by the length of the count vector.

Each coordinate has its own learning rate; the L1 term leaves most at exactly zero, so the weights are a short list
of (index, weight), broadcast to the scoring tasks. A bounded sample of labelled rows (``fit_rows``, the smallest by a
hash of the id) is learnt in one task, ``epochs`` times; all else covers every row.

Null and empty texts have the bias alone. Labels other than 0 and 1 are left out; of several labels of an id the
largest counts, and one row of an id is learnt. Without any label all scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_engine.llm.shared import ship, slices
from campaign_engine.llm.words import SPACES, hashed_words, mixed

_LETTERS = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_SIGNS = ~_LETTERS
_SIGNS[list(SPACES)] = False
_MARK = np.uint64(0x632BE59BD9B4E019)


@dataclass(frozen=True)
class Model:
    """What is learnt and how."""

    grams: int = 2
    skips: tuple[int, ...] = ()
    stem: int = 0
    symbols: bool = False
    scaled: bool = False
    bits: int = 20
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    epochs: int = 2
    fit_rows: int = 20_000


def _sequence(texts: pa.Array, symbols: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, in their order, and the text of each."""
    words = hashed_words(texts, lower=not symbols, word_bytes=_LETTERS)
    doc = np.repeat(np.arange(len(texts)), np.diff(words.ends, prepend=0))
    if not symbols:
        return words.hashes, doc
    signs = hashed_words(texts, lower=False, word_bytes=_SIGNS)
    hashes = np.concatenate([words.hashes, signs.hashes])
    doc = np.concatenate([doc, np.repeat(np.arange(len(texts)), np.diff(signs.ends, prepend=0))])
    order = np.argsort(np.concatenate([words.begin, signs.begin]), kind="stable")
    hashes, doc = hashes[order], doc[order]
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    return np.where(again, _MARK, hashes), doc


def features(texts: pa.Array, model: Model) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index, value) arrays of each text; index 0 is the bias."""
    hashes, doc = _sequence(texts, model.symbols)
    found, owner = [], []
    for n in range(1, model.grams + 1):
        value = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
        for i in range(n):
            value = value * np.uint64(0x9FB21C651E98DF25) + hashes[i : len(hashes) - n + 1 + i]
        same = doc[: len(value)] == doc[n - 1 :]
        found.append(value[same])
        owner.append(doc[: len(value)][same])
    for skip in model.skips:
        step = skip + 1
        left, right = hashes[:-step], hashes[step:]
        same = doc[:-step] == doc[step:]
        found.append((left * np.uint64(0x9FB21C651E98DF25) + right + np.uint64(97 + skip))[same])
        owner.append(doc[:-step][same])
    if model.stem:
        stems = hashed_words(texts, word_bytes=_LETTERS, head=model.stem)
        found.append(stems.hashes ^ _MARK)
        owner.append(np.repeat(np.arange(len(texts)), np.diff(stems.ends, prepend=0)))
    index = (mixed(np.concatenate(found)) >> np.uint64(64 - model.bits)).astype(np.int32)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    index, ends = index[order], np.searchsorted(owner[order], np.arange(len(texts)), "right")
    start = 0
    for end in ends.tolist():
        own, counts = np.unique(index[start:end], return_counts=True)
        value = counts / max(1.0, np.sqrt(np.square(counts.astype(np.float64)).sum())) if model.scaled else np.ones(len(own))
        keep = own > 0
        yield np.append(own[keep], 0), np.append(value[keep], 1.0)
        start = end


def learnt(rows: list[tuple[np.ndarray, np.ndarray, int]], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(index, weight) of the coordinates that aren't zero."""
    state = np.zeros((1 << model.bits, 2))  # of each coordinate: z, and the root of the sum of squared gradients

    def weights(z: np.ndarray, root: np.ndarray, l1: float, l2: float) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((model.beta + root) / model.alpha + l2)

    for _ in range(model.epochs):
        for index, value, label in rows:  # the last coordinate is the bias, without L1 and L2
            own = state[index]
            z, root = own[:, 0], own[:, 1]
            live = np.flatnonzero(np.abs(z[:-1]) > model.l1)
            w = weights(z[live], root[live], model.l1, model.l2)
            bias = weights(z[-1:], root[-1:], 0.0, 0.0)
            p = 1 / (1 + np.exp(-np.clip(w @ value[live] + bias[0], -35, 35)))
            g = (p - label) * value
            after = np.sqrt(root * root + g * g)
            z[live] -= (after[live] - root[live]) / model.alpha * w
            z[-1:] -= (after[-1:] - root[-1:]) / model.alpha * bias
            z += g
            own[:, 1] = after
            state[index] = own
    index = 1 + np.flatnonzero(np.abs(state[1:, 0]) > model.l1)
    w = weights(state[index, 0], state[index, 1], model.l1, model.l2)
    return np.append(0, index), np.append(weights(state[:1, 0], state[:1, 1], 0.0, 0.0), w)


def train(docs: DataFrame, labels: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, float]]:
    """Weights from ``labels`` (id, label: the rows that may be learnt from) of the texts in ``docs``."""
    ship(docs.sparkSession)
    known = labels.filter(F.col("label").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(model.fit_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    joined = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for batch in batches:
            known_labels, done = batch.column("label").to_pylist(), 0
            for part in slices(batch.column("text"), 1 << 20):
                rows.extend((i.astype(np.int32), v.astype(np.float32), y) for (i, v), y in zip(features(part, model), known_labels[done:]))
                done += len(part)
        index, weight = learnt(rows, model) if rows else (np.empty(0, np.int64), np.empty(0))
        yield pa.RecordBatch.from_arrays([pa.array(index, pa.int64()), pa.array(weight, pa.float64())], names=["index", "weight"])

    ordered = joined.select("id", "text", F.col("label").cast("int").alias("label")).repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    return [(r["index"], r["weight"]) for r in ordered.mapInArrow(fit, "index long, weight double").collect()]


def score(text: Column, weights: list[tuple[int, float]], model: Model, docs: DataFrame) -> Column:
    """Probability of label 1 of each text: a sparse dot product."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((np.array([i for i, _ in weights], np.int64), np.array([w for _, w in weights])))

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, weight = sent.value
        dense = np.zeros(1 << model.bits, np.float32)
        dense[index] = weight
        for batch in batches:
            out = [float(dense[i] @ v) for part in slices(batch, 1 << 20) for i, v in features(part, model)]
            p = 1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -35, 35)))
            yield pa.array(p if len(index) else np.zeros(len(out)), pa.float64())

    return F.arrow_udf(scored, "double")(text)
