"""The clean table under added, changed and removed raw files equals a rebuild."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from campaign_engine.plans import cleaning, refresh
from campaign_engine.schemas import CAT_COLS, NUMERIC_COLS
from campaign_engine.sources.client_profile import client_profile


def add(rows, folder):
    rows.coalesce(1).write.mode("append").parquet(folder)


def same(spark, raw, root):
    """The stored table equals a rebuild, repeated rows and types included."""
    want, got = cleaning.clean(spark.read.parquet(raw)), refresh.current(spark, root)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    rows = client_profile(spark, sf_dir)
    kind = F.pmod(F.xxhash64("client_id"), F.lit(4))
    kept = spark.createDataFrame(rows.collect(), rows.schema).persist()
    return [kept.filter(kind == i) for i in range(4)]


def test_files_added_changed_and_removed(spark, parts, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    with pytest.raises(ValueError):
        refresh.manifest(spark, root)
    add(parts[0], raw)
    add(parts[1], raw)
    assert refresh.refresh(spark, raw, root) == {"run": 1, "files": 2, "counted": 2, "removed": 0, "cleaned": 2}
    same(spark, raw, root)
    assert refresh.refresh(spark, raw, root) == {"run": 1, "files": 2, "counted": 0, "removed": 0, "cleaned": 0}
    add(parts[2], raw)
    done = refresh.refresh(spark, raw, root, limit=5)
    assert done["run"] == 2 and done["files"] == 3 and done["counted"] == 1
    same(spark, raw, root)
    names = {r["file"].rsplit("/", 1)[1] for r in refresh.manifest(spark, root).collect()}
    assert names == {n for n in os.listdir(raw) if n.endswith(".parquet")}
    victim = sorted(names)[0]
    os.remove(f"{raw}/{victim}")
    done = refresh.refresh(spark, raw, root)
    assert done["files"] == 2 and done["counted"] == 0 and done["removed"] == 1
    same(spark, raw, root)
    victim = sorted(n for n in os.listdir(raw) if n.endswith(".parquet"))[0]
    stamp = os.stat(f"{raw}/{victim}").st_mtime + 5
    os.utime(f"{raw}/{victim}", (stamp, stamp))
    done = refresh.refresh(spark, raw, root)
    assert done["counted"] == 1 and done["removed"] == 1 and done["cleaned"] == 1
    same(spark, raw, root)
    assert refresh.refresh(spark, raw, root, force=True)["cleaned"] == 2
    same(spark, raw, root)
    assert refresh.vacuum(spark, root) > 0
    same(spark, raw, root)


def test_only_files_that_use_a_moved_constant_are_cleaned_again(spark, parts, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    calm = parts[0].withColumns({c: F.lit(30 + i).cast(parts[0].schema[c].dataType) for i, c in enumerate(NUMERIC_COLS)})
    calm = calm.withColumns({c: F.lit("Same") for c in CAT_COLS})
    add(calm, raw)
    nulls = calm.withColumns({"age": F.lit(None).cast("string"), "client_id": F.concat(F.lit("n"), "client_id")}).limit(3)
    add(nulls, raw)
    assert refresh.refresh(spark, raw, root)["cleaned"] == 2
    older = calm.withColumns({"age": F.lit("40"), "client_id": F.concat(F.lit("o"), "client_id")})
    add(older.unionByName(older), raw)  # moves the median age: only the file with nulls and the new one are written
    done = refresh.refresh(spark, raw, root)
    assert done["counted"] == 1 and done["cleaned"] == 2
    same(spark, raw, root)
    rates = spark.createDataFrame([("USD", "CLP", 800.0, datetime(2024, 1, 1))], "base string, quote string, rate double, as_of timestamp")
    done = refresh.refresh(spark, raw, root, rates=rates, as_of=datetime(2024, 1, 1, 1))
    assert done["counted"] == 0 and done["cleaned"] == 3
    want = cleaning.clean(spark.read.parquet(raw), rates=rates, as_of=datetime(2024, 1, 1, 1))
    assert refresh.current(spark, root).exceptAll(want).count() == 0


def test_a_run_that_died_changes_nothing(spark, parts, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    add(parts[0], raw)
    refresh.refresh(spark, raw, root)
    before = refresh.current(spark, root).count()
    add(parts[3], raw)
    refresh.refresh(spark, raw, root)
    os.remove(f"{root}/manifest/own_run=2/_SUCCESS")  # as if it had died while writing the manifest
    assert refresh.current(spark, root).count() == before
    assert refresh.refresh(spark, raw, root)["run"] == 2
    same(spark, raw, root)


def test_empty_files_and_empty_columns(spark, parts, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "table")
    add(parts[0].limit(0), raw)
    assert refresh.refresh(spark, raw, root)["files"] == 1
    assert refresh.current(spark, root).count() == 0
    blank = parts[0].withColumn("satisfaction_score", F.lit(None).cast(parts[0].schema["satisfaction_score"].dataType))
    add(blank, raw)
    refresh.refresh(spark, raw, root)
    same(spark, raw, root)
    add(parts[1], raw)
    refresh.refresh(spark, raw, root)
    same(spark, raw, root)


def test_quantiles_of_counts(spark):
    values = [1.0, 1.0, 2.5, 4.0, 4.0, 4.0, 9.0, -3.0]
    rows = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0)], "variable string, number double")
    counts = rows.groupBy("variable", "number").agg(F.count("*").alias("n"))
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    want = {r[0]: r[1] for r in rows.groupBy("variable").agg(F.percentile("number", probs)).collect()}
    for limit in (3, 1000):
        assert {r["variable"]: r["q"] for r in refresh.quantiles(counts, ["variable"], probs, limit).collect()} == want
