"""The driver's tables as the operators' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that stands before the SQL of queries over document revisions.
DOCS_SQL = """
WITH RECURSIVE d0 AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS TIMESTAMP) AS t,
         lag(o_orderkey, 1) OVER w AS p1, lag(o_orderkey, 2) OVER w AS p2 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
docs AS (SELECT CAST(k AS VARCHAR) AS doc_id, CAST(CASE WHEN k % 3 = 0 THEN NULL WHEN k % 11 = 0 THEN p2 ELSE p1 END AS VARCHAR) AS parent_id,
         CASE WHEN k % 101 = 0 THEN 'other' ELSE CAST(c AS VARCHAR) END AS entity_id, CASE WHEN k % 83 <> 0 THEN t END AS available_at,
         CASE WHEN k % 3 = 0 THEN '120' ELSE '130' END AS doc_type, k % 211 = 0 AS incomplete, k FROM d0)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its timestamps as instants in UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as revised observations: a series is a user and an event type, a later event revises it."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    return e.select(
        k.alias("record_id"),
        F.lit("events").alias("source_id"),
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("series_id"),
        k.alias("revision"),
        F.when(k % 41 != 0, F.col("ts")).alias("available_at"),
        (F.col("ts") + F.make_dt_interval((k % 5).cast("int"))).alias("recorded_at"),
        F.when(k % 17 != 0, F.col("value").cast("string")).alias("value"),
        F.lit("parse_failed").alias("value_reason"),
        F.when(k % 23 == 0, "withdrawn").otherwise("active").alias("state"),
        F.lit(False).alias("synthetic"),
        F.when(k % 29 == 0, "restated").otherwise("reported").alias("representation"),
        F.when(k % 31 == 0, "guessed").otherwise("structured").alias("method"),
        F.when(k % 37 == 0, "unverified").otherwise("source_tied").alias("verification"),
        F.col("event_type").alias("metric"),
    )


OBSERVATIONS_SQL = """
o AS (SELECT event_id AS record_id, user_id || '|' || event_type AS series_id, CASE WHEN event_id % 41 <> 0 THEN ts END AS available_at,
        ts + to_days(CAST(event_id % 5 AS INTEGER)) AS recorded_at, event_id AS k FROM events)
"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trading calendar over the orders' years: weekends closed, some days odd, missing or listed twice."""
    span = table(spark, sf_dir, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.date_add(F.to_date(F.max("o_orderdate")), 40).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day")).withColumn("e", F.datediff("day", F.lit("1970-01-01").cast("date")))
    kind = F.when((F.col("e") + 3) % 7 >= 5, "0").when(F.col("e") % 37 == 0, "3").when(F.col("e") % 97 == 0, "2").otherwise("1")
    listed = days.where(F.col("e") % 53 != 0).select("day", "e", kind.alias("hol_div"))
    return listed.select("day", "hol_div").union(listed.where(F.col("e") % 61 == 0).select("day", "hol_div"))


CALENDAR_SQL = """
span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) + 40 AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span),
cal0 AS (SELECT day, date_diff('day', DATE '1970-01-01', day) AS e FROM days),
cal AS (SELECT day, CASE WHEN (e + 3) % 7 >= 5 THEN '0' WHEN e % 37 = 0 THEN '3' WHEN e % 97 = 0 THEN '2' ELSE '1' END AS h, CASE WHEN e % 61 = 0 THEN 2 ELSE 1 END AS n FROM cal0 WHERE e % 53 <> 0)
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as filings: each of a customer's orders amends the one before, or the one before that."""
    from pyspark.sql import Window

    own, k = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"), F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("p1", F.lag("o_orderkey", 1).over(own)).withColumn("p2", F.lag("o_orderkey", 2).over(own))
    at = F.col("o_orderdate").cast("timestamp")
    return o.select(
        k.cast("string").alias("doc_id"),
        F.when(k % 3 == 0, None).when(k % 11 == 0, F.col("p2")).otherwise(F.col("p1")).cast("string").alias("parent_id"),
        F.when(k % 101 == 0, "other").otherwise(F.col("o_custkey").cast("string")).alias("entity_id"),
        F.when(k % 83 != 0, at).alias("available_at"),
        at.alias("recorded_at"),
        at.alias("retrieved_at"),
        F.when(k % 3 == 0, "120").otherwise("130").alias("doc_type"),
        (k % 211 == 0).alias("incomplete"),
        F.when(k % 61 == 0, F.array(F.struct(at.alias("available_at"), F.lit("withdrawn").alias("blocked_reason")))).otherwise(F.array().cast("array<struct<available_at:timestamp,blocked_reason:string>>")).alias("events"),
        F.when(k % 67 == 0, "artifact_hash_mismatch").alias("failure"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows as facts of those filings."""
    li, k = table(spark, sf_dir, "lineitem"), F.col("l_suppkey")
    doc = F.col("l_orderkey").cast("string")
    o = documents(spark, sf_dir).select(F.col("doc_id").alias("d"), "recorded_at")
    rows = li.join(o, doc == F.col("d"))
    return rows.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], F.col("l_quantity").cast("int").cast("string")).alias("fact_id"),
        doc.alias("doc_id"),
        F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("key"),
        F.when(k % 29 != 0, F.col("l_quantity").cast("int").cast("string")).alias("value"),
        F.lit("parse_failed").alias("value_reason"),
        F.when(F.col("l_partkey") % 37 == 0, "unverified").otherwise("source_tied").alias("verification"),
        F.lit("reported").alias("representation"),
        F.lit(False).alias("synthetic"),
        (F.col("recorded_at") + F.make_dt_interval((F.col("l_linenumber") % 3).cast("int"))).alias("available_at"),
    )


FACTS_SQL = """
facts AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS fact_id, CAST(l_orderkey AS VARCHAR) AS doc_id, l_returnflag || l_linestatus || l_linenumber AS key,
         CASE WHEN l_suppkey % 29 <> 0 THEN CAST(l_quantity AS INTEGER) END AS v, l_partkey % 37 = 0 AS unverified, CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(l_linenumber % 3 AS INTEGER)) AS fact_at
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
