"""Reading and writing tables. Files go to a fresh folder under the session's checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from campaign_engine.catalog.base import profile, query, with_tables
from campaign_engine.catalog.cleaning import cleaned
from campaign_engine.plans import cleaning, refresh
from campaign_engine.schemas import CAT_COLS, NUMERIC_COLS
from campaign_engine.session import ensure_checkpoint_dir
from campaign_engine.sources import side_tables, tables
from campaign_engine.sources.client_profile import client_raw, table


def scratch(spark, name: str) -> str:
    """A new path in the folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("src_raw", with_tables("SELECT * FROM client_raw", start="raw"))
def _src_raw(spark, sf_dir):
    """The dirty table written as CSV and read back with its schema."""
    path = scratch(spark, "raw")
    raw = client_raw(spark, sf_dir)
    exact = {"header": True, "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(**exact).csv(path)
    return tables.read_table(spark, path, "csv", raw.schema, exact)


@query("src_clean", with_tables("SELECT * FROM cleaned", start="cleaned"))
def _src_clean(spark, sf_dir):
    path = scratch(spark, "clean")
    cleaned(spark, sf_dir).write.parquet(path)
    return tables.read_clean(spark, path)


_CODES = "codes AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {c} AS value FROM cleaned)"
    for c in CAT_COLS
) + ")"
_ENCODED_SQL = with_tables(
    "SELECT client_id, "
    + ", ".join(f"CAST((SELECT code FROM codes WHERE variable = '{c}' AND value = c.{c}) AS INTEGER) AS {c}" for c in CAT_COLS)
    + ", "
    + ", ".join(NUMERIC_COLS)
    + " FROM cleaned c",
    _CODES,
    start="cleaned",
)


@query("src_encoded", _ENCODED_SQL)
def _src_encoded(spark, sf_dir):
    path = scratch(spark, "encoded")
    coded, _ = cleaning.encoded(cleaned(spark, sf_dir))
    coded.select("client_id", *CAT_COLS, *NUMERIC_COLS).write.csv(path, header=True)
    return tables.read_encoded(spark, path)


@query("sink_clean", with_tables("SELECT * FROM cleaned", start="cleaned"))
def _sink_clean(spark, sf_dir):
    clean = cleaned(spark, sf_dir)
    coded, _ = cleaning.encoded(clean)
    path = scratch(spark, "outputs")
    tables.write_outputs(clean, coded, f"{path}/clean", f"{path}/encoded")
    return spark.read.parquet(f"{path}/clean")


@query("sink_encoded", _ENCODED_SQL)
def _sink_encoded(spark, sf_dir):
    clean = cleaned(spark, sf_dir)
    coded, _ = cleaning.encoded(clean)
    path = scratch(spark, "outputs")
    tables.write_outputs(clean, coded.select("client_id", *CAT_COLS, *NUMERIC_COLS), f"{path}/clean", f"{path}/encoded")
    return tables.read_encoded(spark, f"{path}/encoded")


@query("materialize_if_missing", with_tables("SELECT * FROM cleaned", start="cleaned"))
def _materialize(spark, sf_dir):
    path = scratch(spark, "ensure")
    places = {"clean": f"{path}/clean", "encoded": f"{path}/encoded"}
    raw = profile(spark, sf_dir)
    tables.ensure_outputs(spark, raw, places)
    tables.ensure_outputs(spark, raw, places)
    return tables.read_clean(spark, places["clean"])


@query("refresh_clean", with_tables("SELECT * FROM cleaned", start="cleaned"))
def _refresh_clean(spark, sf_dir):
    """Three quarters of the raw rows first, the others as files that are added later."""
    path = scratch(spark, "refresh")
    raw = profile(spark, sf_dir)
    late = F.pmod(F.xxhash64("client_id"), F.lit(4)) == 0
    raw.filter(~late).write.parquet(f"{path}/raw")
    refresh.refresh(spark, f"{path}/raw", f"{path}/table")
    raw.filter(late).write.mode("append").parquet(f"{path}/raw")
    refresh.refresh(spark, f"{path}/raw", f"{path}/table")
    return refresh.current(spark, f"{path}/table")


def _dictionary(spark, sf_dir):
    """One JSON object per document, as dictionary files hold them; some have a value that is no text or a
    key with two parts only."""
    key = F.concat_ws("|", F.lit("es"), F.lit("en"), F.concat("source", F.lit("|"), "doc_id"))
    entry = F.create_map(key, "text")
    bad = F.create_map(key, "n_chars")
    short = F.create_map(F.concat_ws("|", "lang", "source"), F.col("text"))
    kind = F.col("doc_id") % 3
    return table(spark, sf_dir, "documents").select(
        F.when(kind == 0, F.to_json(entry)).when(kind == 1, F.to_json(bad)).otherwise(F.to_json(short)).alias("value")
    )


@query(
    "src_dictionary",
    "SELECT src, tgt, text, translated FROM (SELECT 'es' AS src, 'en' AS tgt, source || '|' || doc_id AS text, "
    "text AS translated, doc_id % 3 AS kind FROM documents) WHERE kind = 0",
)
def _src_dictionary(spark, sf_dir):
    path = scratch(spark, "dictionary")
    _dictionary(spark, sf_dir).write.text(path)
    return side_tables.dictionary_rows(spark.read.text(path))


@query(
    "src_rates",
    "SELECT 'USD' AS base, 'CLP' AS quote, value AS rate, strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_of, event_type AS source FROM events "
    "WHERE event_type <> 'error'",
)
def _src_rates(spark, sf_dir):
    """One cache object per event; those of errors are cut off and therefore broken."""
    inner = F.struct(
        F.col("value").alias("rate"),
        F.col("event_type").alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("cached_at"),
    )
    text = F.to_json(F.struct(inner.alias("fx_usd_clp")))
    cut = F.when(F.col("event_type") == "error", F.substring(text, 1, 20)).otherwise(text)
    path = scratch(spark, "rates")
    table(spark, sf_dir, "events").select(cut.alias("value")).write.text(path)
    rates = side_tables.rate_rows(spark.read.text(path))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("as_of").cast("timestamp_ntz"))
    return rates.withColumn("as_of", F.date_format(utc, "yyyy-MM-dd HH:mm:ss"))


@query(
    "sink_search_results",
    "SELECT event_type AS feature_set, round_even(avg(value) * 1000000, 0) / 1000000 AS roc_auc, count(*) AS n FROM events GROUP BY event_type",
)
def _sink_results(spark, sf_dir):
    """A small ranked table written as JSON and read back."""
    path = scratch(spark, "results")
    ranked = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("feature_set")).agg(
        (F.rint(F.avg("value") * 1e6) / 1e6).alias("roc_auc"), F.count("*").alias("n")
    )
    tables.write_results(ranked.orderBy(F.desc("roc_auc")), path)
    return spark.read.schema(ranked.schema).json(path)
