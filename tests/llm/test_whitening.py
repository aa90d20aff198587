"""Whitening: eigenvectors against known ones, rows against a plain version in exact fractions, and odd rows."""

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_engine.llm import whitening
from campaign_engine.llm.queries import QUERIES


def plain(vectors, components):
    """(n, deviations, covariance, whitened by unit eigenvectors of the library's double-precision routine)."""
    x = [[floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(c - Fraction(s, n)) for c, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    return n, deviations, v, values, centred @ directions / np.sqrt(values)


def check(rows, vectors, components):
    n, deviations, v, values, want = plain([vec for _, vec in vectors], components)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(vectors) * components and {r["n"] for r in rows} == {n}
    table = np.array([[got[i][k + 1]["whitened"] for k in range(components)] for i, _ in vectors])
    signs = np.sign((table * want).sum(axis=0))
    np.testing.assert_allclose(table * signs, want, rtol=0, atol=1e-8)
    np.testing.assert_allclose(np.cov(table.T, bias=True), np.eye(components), atol=1e-9)
    assert [got[i][1]["deviation"] for i, _ in vectors] == deviations
    share = [got[vectors[0][0]][k + 1]["explained"] for k in range(components)]
    np.testing.assert_allclose(share, values / np.trace(v), rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query_equals_the_plain_version(spark, sf_dir):
    read = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = [(i, v) for i, v in read if v is not None and all(c is not None and isfinite(c) for c in v)]
    check(QUERIES["op13_embedding_whitening"](spark, sf_dir).collect(), vectors, 8)


def orthonormal(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0]


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), np.geomspace(1e-6, 1, 30), np.append(np.ones(5), np.arange(2.0, 20.0)),
    1 + 1e-9 * np.arange(20.0), np.append([1, 1 + 1e-8, 1 + 2e-8, 3, 3 + 1e-10], np.zeros(6)), np.zeros(4), np.array([2.5]),
])
def test_eigenvectors_are_right_to_double_precision(values):
    q = orthonormal(len(values), len(values)).astype(np.longdouble)
    q = q @ (1.5 * np.eye(len(values), dtype=np.longdouble) - 0.5 * (q.T @ q))
    exact = (q * values.astype(np.longdouble)) @ q.T
    v = ((exact + exact.T) / 2).astype(float)
    found, x = whitening.eigenvectors(v)
    scale = max(np.abs(values).max(), 1e-300)
    np.testing.assert_allclose(found / scale, np.sort(values)[::-1] / scale, rtol=0, atol=4e-15)
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(len(values))).max() < 1e-15
    assert np.abs(v.astype(np.longdouble) @ wide - wide * found).max() < 2e-15 * scale * len(values)


def test_float32_alone_is_not_enough():
    v = np.diag([1.0, 1 + 1e-6, 2, 3]) + 1e-9
    rough = np.linalg.eigh(v.astype(np.float32))[1].astype(float)
    found, x = whitening.eigenvectors(v)
    off = lambda x: np.abs(x.T @ v @ x - np.diag(np.diag(x.T @ v @ x))).max()
    assert off(x) < 1e-15 < off(rough)


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, rng.standard_normal(5).round(3).tolist()) for i in range(60)] + [(100 + i, [1.0, 2.0, -3.5, 0.0, 0.25]) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (201, []), (202, [None, 1.0, 1.0, 1.0, 1.0]), (203, [nan] * 5), (204, [inf, 1.0, 1.0, 1.0, 1.0]), (205, [1.0] * 4),
           (206, [1e300, 1.0, 1.0, 1.0, 1.0]), (207, [-inf] * 5)]
    frame = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").withColumns(
        {"id": F.lit("x"), "x": F.lit(1), "n": F.lit(None), "component": F.lit(3)}
    )
    fit = whitening.Whitening(frame)
    assert fit.components == 5
    check(fit.whitened().collect(), vectors, 5)
    repeated = whitening.Whitening(spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 3.0]), (7, [2.0, 2.0]), (7, [2.0, 2.0])], "vec_id long, embedding array<float>"))
    assert repeated.n == 4 and repeated.whitened().count() == 8
    one_value = whitening.Whitening(spark.createDataFrame([(1, [2.0, 1.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<float>"))
    assert {(r["whitened"], r["explained"], r["deviation"]) for r in one_value.whitened().collect()} == {(0.0, 0.0, 0)}
    empty = whitening.Whitening(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>"))
    assert empty.whitened().collect() == [] and empty.whitened().columns == fit.whitened().columns


def test_large_entries_and_deviations(spark):
    vectors = [(1, [4e9, 1.0]), (2, [-4e9, 2.0]), (3, [1e9, 5.0])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = whitening.Whitening(frame).whitened().collect()
    want = dict(zip((1, 2, 3), plain([v for _, v in vectors], 2)[1]))
    assert {r["vec_id"]: r["deviation"] for r in rows} == {i: d if d < 2**63 else None for i, d in want.items()}
