"""Customer tables derived from the driver's TPC-H-like tables.

``client_profile`` has one dirty row per customer, ``client_raw`` adds repeated rows, ``scored`` adds a
label and a score that need no model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line figures per customer.

    Lines are summed per order before the join, so the join is one row to one row and a customer with very
    many orders only meets the partially aggregated ``groupBy`` that follows.
    """
    orders = table(spark, sf_dir, "orders")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    last_order = orders.agg(F.max("o_orderdate")).scalar()
    recent = F.col("o_orderdate") >= last_order - F.expr("interval 90 days")
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .groupBy("o_custkey")
        .agg(
            F.sum("o_totalprice").alias("spent"),
            F.count("*").alias("n_orders"),
            F.count_if(recent).alias("n_recent"),
            F.sum("revenue").alias("revenue"),
            F.sum("returned").alias("returned"),
            F.array_min(F.collect_set("o_orderpriority")).alias("priority"),  # the least text by hash aggregation, without a sort
        )
    )


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event figures per user; days are collapsed first so that no user needs a set of distinct days."""
    kind = F.col("event_type")
    daily = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("day"))
        .agg(
            F.count("*").alias("n"),
            F.sum("value").alias("value"),
            F.count("value").alias("n_value"),
            F.count_if(kind == "view").alias("views"),
            F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "error").alias("errors"),
        )
    )
    return daily.groupBy("user_id").agg(
        F.sum("n").alias("n_events"),
        F.count("*").alias("days"),
        F.sum("value").alias("value"),
        F.sum("n_value").alias("n_value"),
        F.sum("views").alias("views"),
        F.sum("clicks").alias("clicks"),
        F.sum("errors").alias("errors"),
    )


def client_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty row per customer (21 columns)."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    spend, visits = _spend(spark, sf_dir), _visits(spark, sf_dir)
    joined = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(spend, customer.c_custkey == spend.o_custkey, "left")
        .join(visits, customer.c_custkey == visits.user_id, "left")
    )
    k = F.col("c_custkey")
    average = F.round("spent", 2) / F.col("n_orders")

    def share(c: Column) -> Column:
        return c / F.col("n_events")

    return joined.select(
        F.format_string("C-%05d", k + 1).alias("client_id"),
        F.when(k % 20 == 0, "nan")
        .when(k % 20 == 1, None)
        .when(k % 20 == 2, " 130 ")
        .when(k % 20 == 3, "abc")
        .otherwise((18 + (7 * k) % 60).cast("string"))
        .alias("age"),
        F.when(k % 9 == 0, " male")
        .when(k % 9 == 1, "M")
        .when(k % 9 == 2, "FEMALE ")
        .when(k % 9 == 3, "f")
        .when(k % 9 == 4, "unknown")
        .when(k % 9 == 5, "nan")
        .when(k % 9 == 6, "")
        .when(k % 9 == 8, "non binary")
        .alias("gender"),
        F.when(k % 29 == 0, None)
        .when(k % 7 == 0, F.concat(F.lit(" "), "n_name", F.lit("  ")))
        .otherwise(F.col("n_name"))
        .alias("country"),
        F.when(k % 3 == 0, F.lower("c_mktsegment"))
        .when(k % 3 == 1, F.concat("c_mktsegment", F.lit(" ")))
        .otherwise(F.col("c_mktsegment"))
        .alias("acquisition_channel"),
        F.when(k % 37 == 0, None)
        .when(F.col("c_acctbal") >= 4500, "Annual")
        .otherwise("Monthly")
        .alias("subscription_type"),
        F.col("priority").alias("payment_method"),
        F.when(k % 13 == 0, None)
        .when(k % 97 == 0, F.round(F.col("spent") * 50, 2))
        .otherwise(F.round("spent", 2))
        .alias("total_spent"),
        average.alias("avg_order_value"),
        F.round("revenue", 4).alias("lifetime_value"),
        F.coalesce("n_recent", F.lit(0)).cast("double").alias("last_3_month_purchase_freq"),
        F.round(F.abs("c_acctbal") / 10, 3).alias("marketing_spend_per_user"),
        F.coalesce("n_events", "n_orders", F.lit(0)).alias("total_visits"),
        F.coalesce(F.round("value", 2) / F.col("n_value"), average / 1000).alias("avg_session_time"),
        F.coalesce(F.col("n_events") / F.col("days"), (1 + k % 6).cast("double")).alias("pages_per_session"),
        F.coalesce(share(F.col("views")), (k % 10) / 10.0).alias("email_open_rate"),
        F.coalesce(share(F.col("clicks")), (k % 7) / 10.0).alias("email_click_rate"),
        F.coalesce(F.col("errors"), k % 4).alias("support_tickets"),
        F.coalesce("returned", F.lit(0)).alias("delivery_delay_days"),
        F.when(k % 11 != 0, (1 + (7 * k) % 5).cast("double")).alias("satisfaction_score"),
        ((13 * k) % 201 - 100).cast("double").alias("nps_score"),
    )


def client_number() -> Column:
    """The number in ``client_id``, from 0."""
    return F.substring("client_id", 3, 18).cast("long") - 1


def client_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of client_profile; every fiftieth appears twice, as duplicates to be found."""
    copies = F.when(client_number() % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return client_profile(spark, sf_dir).withColumn("copy", F.explode(copies)).drop("copy")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """client_id, label and score of every customer; scores have ties."""
    k = F.col("c_custkey")
    label = ((31 * k) % 100 < 45).cast("int")
    return table(spark, sf_dir, "customer").select(
        F.format_string("C-%05d", k + 1).alias("client_id"),
        label.alias("label"),
        F.round(0.8 * ((7919 * k) % 1000) / 1000 + 0.2 * label, 3).alias("score"),
    )


def scored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """client_profile with the score as ``conversion_score``, as campaign operators expect it."""
    return client_profile(spark, sf_dir).join(
        scored(spark, sf_dir).withColumnRenamed("score", "conversion_score"), "client_id"
    )
