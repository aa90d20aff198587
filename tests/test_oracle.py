"""Every query with SQL gives the rows of that SQL in DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from campaign_engine.catalog import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _key(row):
    return tuple(
        (v is None, "" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row
    )


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-8, abs_tol=1e-8)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_rows_match(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[df[c] for c in cols]).collect()), key=_key)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=_key)
    assert len(got) == len(want)
    assert all(_same(x, y) for a, b in zip(got, want) for x, y in zip(a, b))


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
