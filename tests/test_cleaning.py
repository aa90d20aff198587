"""Text, numbers, imputation, outliers, codes."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from campaign_engine.functions.text import is_human_text, null_tokens, title, to_double
from campaign_engine.operators import columns, encode, impute, outliers
from campaign_engine.operators.fx import fx_enrich, rate_column, resolve_rate
from campaign_engine.plans import cleaning
from campaign_engine.schemas import CAT_COLS, NUMERIC_COLS, WINSOR_COLS
from campaign_engine.sources.client_profile import client_profile


def _values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_number_texts(spark):
    texts = ["1e2", " 3 ", "1,000", "1d", "nan", "inf", "", None, "-4.5", ".5", "5.", "0x10", "\t7\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    inf = float("inf")
    assert _values(df, to_double(F.col("t"))) == [100.0, 3.0, None, None, None, inf, None, None, -4.5, 0.5, 5.0, None, 7.0]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (2.0,), (None,)], "x double")
    assert _values(columns.to_numeric(df, ["x"]), "x") == [None, 2.0, None]
    assert _values(impute.impute_median(columns.to_numeric(df, ["x"]), ["x"]), "x") == [2.0, 2.0, 2.0]


def test_null_tokens_are_case_sensitive(spark):
    df = spark.createDataFrame([(" nan ",), ("NaN",), ("None",), ("",), (" x ",)], "t string")
    assert _values(df, null_tokens(F.col("t"))) == [None, "NaN", None, None, "x"]


def test_title_case_breaks_at_any_non_letter(spark):
    texts = ["lópez-o'neil", "credit CARD", "3g phone", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert _values(df, title(F.col("t"))) == [None if t is None else t.title() for t in texts]


def test_gender_null_stays_null(spark):
    df = spark.createDataFrame([(" M ",), (None,), ("non binary",), ("FEMALE",)], "gender string")
    assert _values(columns.canon_gender(df), "gender") == ["Male", None, "Non Binary", "Female"]


def test_human_texts(spark):
    cases = {
        "Vista Ejecutiva": True, "abc": False, "x" * 220: True, "x" * 221: False, "https://a.b/c": False, "/path": False,
        "#22c55e": False, "a {b} c d": False, "snake_case": False, "snake case_x": True, "12 34 5a": False,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert dict(zip(cases, _values(df, is_human_text(F.col("t"))))) == cases


def test_group_median_keeps_known_values(spark):
    rows = [("a", 1.0), ("a", 3.0), ("a", None), ("b", None), (None, 50.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], i): r["x"] for i, r in enumerate(sorted(impute.impute_group_median(df, "x", "g").collect(), key=str))}
    values = sorted(got.values())
    # a: 2.0 fills its null; the rest take the median of [1, 3, 2, 50] = 2.5
    assert values == [1.0, 2.0, 2.5, 2.5, 3.0, 50.0]


def test_mode_tie_and_empty(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    rows = impute.impute_mode(df, ["x", "y"]).collect()
    assert sorted(r["x"] for r in rows) == ["a", "a", "b"] and {r["y"] for r in rows} == {"Unknown"}


def test_zero_iqr(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(100.0,), (None,)], "x double")
    assert max(v for v in _values(outliers.winsorize_iqr(df, ["x"]), "x") if v is not None) == 100.0
    flat = _values(outliers.winsorize_iqr(df, ["x"], skip_zero=False), "x")
    assert set(flat) == {1.0, None}


def test_winsorized_values_lie_inside(spark, sf_dir):
    df = cleaning.imputed(cleaning.normalized(client_profile(spark, sf_dir)))
    found = outliers.fences(df, WINSOR_COLS)
    out = outliers.winsorize_iqr(df, WINSOR_COLS, found=found)
    for c, f in found.items():
        if f.iqr:
            low, high = out.agg(F.min(c), F.max(c)).first()
            assert f.low <= low and high <= f.high


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_codes_round_trip(spark, limit):
    values = ["b", "a", None, "ñ", "Z", "b"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x string")
    dictionary = encode.label_dictionary(df, ["x"], limit)
    coded, _ = encode.label_encode(df, ["x"], dictionary)
    order = sorted({v or "nan" for v in values})
    assert [r["x"] for r in coded.orderBy("id").collect()] == [order.index(v or "nan") for v in values]
    back = encode.label_decode(coded, dictionary, ["x"]).orderBy("id").collect()
    assert [r["x"] for r in back] == [v or "nan" for v in values]


@pytest.mark.parametrize("profile", ["bootstrap", "notebook"])
def test_clean_tables(spark, sf_dir, profile):
    raw = client_profile(spark, sf_dir).persist()
    clean = cleaning.clean(raw, profile).persist()
    assert clean.count() == raw.count()
    must = [*NUMERIC_COLS, *CAT_COLS] if profile == "bootstrap" else ["age", "total_spent", "gender", "country"]
    nulls = clean.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in must]).first()
    assert not any(nulls)
    assert dict(clean.dtypes)["age"] == "bigint"
    with pytest.raises(ValueError):
        cleaning.clean(raw, "other")


def test_same_result_for_any_partitioning(spark, sf_dir):
    raw = client_profile(spark, sf_dir)
    one, eight = (cleaning.clean(raw.repartition(n).persist()) for n in (1, 8))
    assert sorted(map(str, one.collect())) == sorted(map(str, eight.collect()))


def test_narrow_types_holds_the_range(spark):
    df = spark.createDataFrame([(1, 300, 70000, 1.5), (-128, 5, 1, 2.5)], "a long, b long, c long, d double")
    assert dict(columns.narrow_types(df, ["a", "b", "c", "d"]).dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "int", "d": "float",
    }


def test_fx_without_rates_uses_the_fallback(spark):
    df = spark.createDataFrame([(1800.0,)], "total_spent double")
    row = fx_enrich(df, rate_column(None, None), ["total_spent", "missing"]).first()
    assert row["fx_usd_to_clp"] == 900.0 and row["total_spent_usd"] == 2.0


def test_rates_do_not_depend_on_the_time_zone(spark):
    rows = [("USD", "CLP", 910.0, "2024-01-01 10:00:00"), ("USD", "CLP", -1.0, "2024-01-01 11:00:00")]
    text = spark.createDataFrame(rows, "base string, quote string, rate double, as_of string")
    ntz = text.withColumn("as_of", F.col("as_of").cast("timestamp_ntz"))
    for zone in ("UTC", "America/Santiago"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            zoned = text.withColumn("as_of", F.to_timestamp(F.concat("as_of", F.lit("+00:00"))))
            for rates in (ntz, zoned):
                got = [resolve_rate(rates, datetime(2024, 1, d, 10)).first() for d in (1, 2, 3)]
                assert [r["origin"] for r in got] == ["fresh", "fresh", "stale"] and got[0]["rate"] == 910.0
                assert resolve_rate(rates, datetime(2024, 1, 1, 9)).first()["origin"] == "fallback"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
