"""The given tables seen as interactions, clicks, items and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Timestamps in the files carry no zone; read them as UTC.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to orders as (user_id, parent_asin, rating, timestamp)."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("parent_asin"),
        (F.lit(1.0) + F.col("l_quantity") % 5).alias("rating"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return lines.join(orders, "o_orderkey").select("user_id", "parent_asin", "rating", "timestamp")


def distinct_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interactions unique on (user, item, time): the smallest rating of copies."""
    rows = interactions(spark, sf_dir)
    return rows.groupBy("user_id", "parent_asin", "timestamp").agg(F.min("rating").alias("rating"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (user_id, parent_asin, rating, timestamp), item from the JSON props."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("parent_asin"),
        F.col("value").alias("rating"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_type",
        "event_id",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as item metadata."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("parent_asin"),
        F.col("p_type").alias("main_category"),
        F.split("p_name", " ").alias("categories"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("string")).alias("price"),
        F.col("p_name").alias("title"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), "label"
    )


# The same views for the checking engine, as WITH entries.
INTERACTIONS_SQL = """interactions AS (
  SELECT o_custkey AS user_id, l_partkey AS parent_asin, 1.0::DOUBLE + (l_quantity % 5) AS rating,
         l_shipdate AS ts, epoch(l_shipdate)::BIGINT AS sec
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
DISTINCT_SQL = INTERACTIONS_SQL + """, uniq AS (
  SELECT user_id, parent_asin, ts, sec, min(rating) AS rating
  FROM interactions GROUP BY ALL)"""
CLICKS_SQL = """clicks AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS parent_asin, value AS rating,
         ts, epoch_us(ts) AS us, floor(epoch(ts))::BIGINT AS sec, event_type, event_id
  FROM events)"""
ITEMS_SQL = """items AS (
  SELECT p_partkey AS parent_asin, p_type AS main_category, string_split(p_name, ' ') AS categories,
         '$' || p_retailprice::VARCHAR AS price, p_name AS title
  FROM part)"""
