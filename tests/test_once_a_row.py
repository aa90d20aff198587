"""Costly steps of the training tables and splits are worked out once a row, with the same results."""

from datetime import datetime

from pyspark.sql import functions as F

from campaign_engine.functions.text import strip
from campaign_engine.operators import columns, order_stats, prep
from campaign_engine.sources.client_profile import client_profile

PATTERN = r"^\s+|\s+$"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_trimmed_texts_are_what_the_pattern_gives(spark):
    ends = ["", " ", "\t", "\n", "\r", "\r\n", "\x0b", "\f", "\x85", " ", " ", "\xa0", "\x00", "  ", "\x85 ", " \n "]
    texts = [None] + [f"{a}{middle}{b}" for a in ends for middle in ("", "x", "a b", "x\n y") for b in ends]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.filter(~strip(F.col("t")).eqNullSafe(F.regexp_replace("t", PATTERN, ""))).collect()
    assert wrong == []


def test_a_text_meets_the_pattern_only_for_odd_line_ends(spark):
    df = spark.createDataFrame([(" nan ", 1), (" x ", 2), ("None", 3), ("a\x85", 4), ("  ", 5), (None, 6)], "t string, k int")
    clean = columns.normalize_text(df, ["t"])
    assert _plan(clean).count("regexp_replace") == 1
    assert [r["t"] for r in clean.orderBy("k").collect()] == [None, "x", None, "a\x85", " ", None]


def test_hashes_of_cuts_and_samples_are_worked_out_once(spark, monkeypatch):
    data = spark.range(500).select(F.concat(F.lit("C-"), "id").alias("client_id"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    plain = prep.with_split(data, "client_id", 0.2, stratify="label", limit=1_000)
    seen, run = [], order_stats._run
    monkeypatch.setattr(order_stats, "_run", lambda df, exprs: (seen.extend(str(c) for c in exprs.values()), run(df, exprs))[1])
    narrowed = prep.with_split(data, "client_id", 0.2, stratify="label", limit=20)
    assert seen and not any("md5" in s for s in seen)
    assert sorted(narrowed.collect()) == sorted(plain.collect())
    sample = prep.fit_sample(data, "client_id", 50)
    sort = next(line for line in _plan(sample).splitlines() if "Sort [" in line)
    assert "md5" not in sort and sample.columns == data.columns
    want = data.orderBy(prep.hash_number(F.col("client_id"), prep.SEED), "client_id").limit(50)
    assert sample.collect() == want.collect()


def test_orders_are_passed_once_for_sums_and_first_priority(spark, tmp_path):
    when = datetime(2024, 5, 1)
    rows = {
        "customer": ([(k, k % 2, 10.0 * k, "AUTO") for k in (0, 1, 2, 3, 3)] + [(None, 0, 1.0, "AUTO")],
                     "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(0, "A"), (1, "B")], "n_nationkey int, n_name string"),
        "orders": ([(1, 0, 5.0, when, "2-HIGH"), (2, 0, 7.0, when, "1-URGENT"), (2, 0, 7.0, when, None), (3, 1, 2.0, when, None),
                    (4, 3, 1.0, when, "5-LOW"), (5, None, 9.0, when, "0-FIRST"), (None, 3, 4.0, when, "3-MEDIUM")],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 10.0, 0.0, "R"), (1, 20.0, 0.5, "N"), (2, 4.0, 0.0, "R"), (None, 8.0, 0.0, "R")],
                     "l_orderkey long, l_extendedprice double, l_discount double, l_returnflag string"),
        "events": ([(0, when, "view", 1.0)], "user_id long, ts timestamp, event_type string, value double"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    profile = client_profile(spark, str(tmp_path))
    got = sorted((r["client_id"], r["payment_method"], r["avg_order_value"], r["lifetime_value"], r["delivery_delay_days"])
                 for r in profile.filter(F.col("client_id").isin("C-00001", "C-00002", "C-00004")).collect())
    assert got == [
        ("C-00001", "1-URGENT", 19.0 / 3, 28.0, 3), ("C-00002", None, 2.0, None, 0),
        ("C-00004", "3-MEDIUM", 2.5, None, 0), ("C-00004", "3-MEDIUM", 2.5, None, 0),
    ]
    assert profile.filter("client_id = 'C-00003' AND payment_method IS NULL").count() == 1
    # one scan for the sums and the first priority (the last date is a scalar subquery with its own)
    assert _plan(profile).count("o_orderpriority") and _plan(profile).count("collect_set") == 0
