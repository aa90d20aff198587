"""Readers, writers, plans."""

import json

import pytest
from pyspark.sql import functions as F

from campaign_engine.plans import cleaning
from campaign_engine.session import ensure_checkpoint_dir
from campaign_engine.sources import side_tables, tables
from campaign_engine.sources.client_profile import client_profile, scored


def test_dictionary_files(spark, tmp_path):
    good = {"es|en|Hola | mundo": "Hello | world", "broken": "x", "es|en|num": 5, "es|en|ñ": "n"}
    (tmp_path / "a.json").write_text(json.dumps(good, ensure_ascii=False, indent=2), encoding="utf-8")
    (tmp_path / "b.json").write_text("{not json", encoding="utf-8")
    (tmp_path / "c.json").write_text("[1, 2]", encoding="utf-8")
    rows = sorted(tuple(r) for r in side_tables.read_dictionary(spark, str(tmp_path)).collect())
    assert rows == [("es", "en", "Hola | mundo", "Hello | world"), ("es", "en", "ñ", "n")]


def test_rate_files(spark, tmp_path):
    cache = {"fx_usd_clp": {"rate": 912.5, "source": "s", "cached_at": "2024-01-02T03:04:05+00:00"}}
    (tmp_path / "a.json").write_text(json.dumps(cache, indent=2))
    (tmp_path / "b.json").write_text("{")
    rows = side_tables.read_rates(spark, str(tmp_path)).collect()
    assert len(rows) == 1 and rows[0]["rate"] == 912.5 and rows[0]["as_of"].year == 2024


def test_outputs_are_built_once(spark, sf_dir, tmp_path):
    raw = client_profile(spark, sf_dir).persist()
    paths = {"clean": str(tmp_path / "clean"), "encoded": str(tmp_path / "encoded")}
    assert tables.ensure_outputs(spark, raw, paths) == {"clean": "built", "encoded": "built"}
    assert tables.ensure_outputs(spark, raw, paths) == {"clean": "reused", "encoded": "reused"}
    only_clean = {**paths, "encoded": str(tmp_path / "again")}
    assert tables.ensure_outputs(spark, raw, only_clean) == {"clean": "reused", "encoded": "built"}
    assert tables.ensure_outputs(spark, raw, paths, force=True) == {"clean": "built", "encoded": "built"}


def test_missing_tables_raise(spark, tmp_path):
    with pytest.raises(Exception):
        tables.read_clean(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path), "xlsx")


def test_checkpoint_folder_comes_from_the_session(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first


def test_plans_stay_on_the_jvm_and_push_down(spark, sf_dir):
    plan = cleaning.clean(client_profile(spark, sf_dir).persist())._jdf.queryExecution().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    orders = tables.read_table(spark, f"{sf_dir}/orders.parquet").filter(F.col("o_totalprice") >= 1000).select("o_orderkey")
    text = orders._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in text and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text
    profile_plan = client_profile(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in profile_plan and "SortAggregate" not in profile_plan


def test_scores_do_not_depend_on_partitions(spark, sf_dir):
    assert scored(spark, sf_dir).exceptAll(scored(spark, sf_dir).repartition(3)).count() == 0


def test_objects_beyond_the_parser_are_an_error(spark, tmp_path):
    from campaign_engine.sources import side_tables

    key = "es|en|" + "x" * 60_000
    big = spark.createDataFrame([('{"' + key + '": "y", "es|en|a": "b"}',)], "value string")
    with pytest.raises(Exception, match="too large"):
        side_tables.dictionary_rows(big).collect()
    assert side_tables.dictionary_rows(spark.createDataFrame([("{broken",)], "value string")).count() == 0
    rows = spark.createDataFrame([("es", "en", "x" * 60_000, "y"), ("es", "en", "a", "b")], "src string, tgt string, text string, translated string")
    side_tables.write_entries(rows, str(tmp_path / "entries"))
    assert sorted(side_tables.read_entries(spark, str(tmp_path / "entries")).collect()) == sorted(rows.collect())


def test_half_written_tables_are_rebuilt_and_errors_are_raised(spark, tmp_path):
    from campaign_engine.sources import tables

    path = tmp_path / "clean"
    spark.range(3).write.parquet(str(path))
    assert tables._finished(spark, str(path))
    (path / "_SUCCESS").unlink()
    assert not tables._finished(spark, str(path)) and not tables._finished(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        tables._finished(spark, "nosuchstore://x/y")
