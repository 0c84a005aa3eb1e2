"""Queries that write a given table in some form, read it back by the operator for that form, and return the rows."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import sampling as s
from tidemark.operators import temporal as t
from tidemark.operators import transforms as x
from tidemark.operators.ordering import row_numbers
from tidemark.operators.slices import tasks_for
from tidemark.plans.tables import CLICKS_SQL, DISTINCT_SQL, INTERACTIONS_SQL, ITEMS_SQL, distinct_interactions, interactions, items, table
from tidemark.plans.temporal import _ITEM_STATS
from tidemark.schemas import CORRUPT, ITEM_VIEW
from tidemark.session import materialize, shared_dir
from tidemark.sources import compaction, reviews, snapshots, tables
from tidemark.streaming import capture as cap

#: Row threshold and rows a task of ``compaction_rewrite``, small enough that both matter on the given tables.
COMPACT_ROWS, COMPACT_BLOCK = 5000, 2000

def _place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def review_scan(spark, sf_dir):
    """Reviews as JSON lines, some of them cut short, read by the declared schema; ratings are cast, unused columns go."""
    rows = interactions(spark, sf_dir).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"), F.col("parent_asin").cast("string").alias("parent_asin"),
        "rating", F.unix_millis("timestamp").alias("timestamp"), F.lit("t").alias("title"), F.lit(1).alias("helpful_vote"),
    )
    line = F.to_json(F.struct(*rows.columns))
    cut = F.when(F.col("timestamp") / 86_400_000 % 13 == 0, F.substring(line, 1, 20)).otherwise(line)
    place = _place(spark, "reviews")
    rows.select(cut.alias("value")).write.text(place)
    read = reviews.parsed_interactions(reviews.training_columns(reviews.read_reviews(spark, place)))
    return read.select("user_id", "parent_asin", "rating", F.unix_seconds("timestamp").alias("sec"), F.col(CORRUPT).alias("bad"))


def snapshot_scan(spark, sf_dir):
    """Orders as one dated snapshot a month; the five newest are read."""
    month = F.trunc("o_orderdate", "month")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy_MM").alias("month"), month.alias("day"))
    place = _place(spark, "snapshots")
    snapshots.write_dated(orders, place, "orders", F.col("day"))
    return snapshots.read_newest(spark, place, 5).drop("day")


def compaction_rewrite(spark, sf_dir):
    """Interactions in many small files by month, merged: every row, and whether its output is named for it and filled."""
    rows = interactions(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp"))
    place = _place(spark, "small")
    # Dealt by rows: by bytes, few tasks would create all of the files. Ranges leave few files short of 500 rows.
    dealt = reviews.with_month(rows).repartitionByRange(tasks_for(rows, rows.count()), "year_month", "ts", "user_id", "parent_asin")
    dealt.write.option("maxRecordsPerFile", 500).partitionBy("year_month").parquet(f"{place}/in")
    compaction.compact(spark, f"{place}/in", f"{place}/out", "merged", COMPACT_ROWS, COMPACT_BLOCK)
    merged = spark.read.parquet(f"{place}/out")
    part = lambda i: F.split("output", "_")[i]
    sizes = merged.groupBy("output").agg(F.count(F.lit(1)).alias("n"))
    last = sizes.agg(F.max(F.substring(part(3), 3, 20).cast("bigint"))).scalar()
    filled = (F.col("n") >= COMPACT_ROWS) | (F.substring(part(3), 3, 20).cast("bigint") == last)
    month = F.col("year_month").cast("string")
    return merged.join(sizes.select("output", filled.alias("is_filled")), "output").select(
        "user_id", "parent_asin", "rating", F.unix_seconds("ts").alias("sec"), month.alias("month"),
        month.between(part(1), part(2)).alias("is_named"), "is_filled",
    )


def _crash(batch_id):
    if batch_id == 2:
        raise RuntimeError("stopped before the commit")


def stream_snapshots(spark, sf_dir):
    """Events that arrive in four spans of time, captured as dated snapshots; the third capture stops before its commit.

    The restart writes the batch again. The two newest snapshots are read, each row once.
    """
    rows = table(spark, sf_dir, "events").withColumn("sec", F.unix_seconds(F.col("ts").cast("timestamp")))
    ends = rows.agg(F.min("sec").alias("lo"), F.max("sec").alias("hi")).first()
    span = F.floor((F.col("sec") - ends["lo"]) * 4 / (ends["hi"] - ends["lo"] + 1))
    body = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"), F.get_json_object("props", "$.k").alias("item_id"),
        F.col("value").alias("rating"), F.col("sec").alias("timestamp"),
    ))
    place = _place(spark, "upto")
    for no in range(4):
        rows.filter(span == no).select(body.alias("value")).write.mode("append").text(f"{place}/in")
        for stop in (_crash, None) if no == 2 else (None,):
            try:
                cap.capture_snapshots(
                    cap.folder_messages(spark, f"{place}/in"), f"{place}/good", f"{place}/bad", f"{place}/checkpoint",
                    by_event_time=True, before_commit=stop,
                )
            except StreamingQueryException:
                if stop is None:
                    raise
    newest = snapshots.read_newest(spark, f"{place}/good", 2)
    return newest.select("user_id", "parent_asin", "rating", F.unix_seconds("timestamp").alias("sec"))


def materialised_runs(spark, sf_dir):
    """Item features brought into a store year by year, one year twice; runs are merged, the newest rows read."""
    stats = materialize(t.item_window_stats(interactions(spark, sf_dir)))
    place = _place(spark, "runs")
    for year in (1993, 1994, 1995, 1996, 1997, 1995, 1998, 2030):
        tables.materialise(spark, stats, ITEM_VIEW, place, f"{year}-01-01 00:00:00")
    newest = tables.read_store(spark, ITEM_VIEW, place)
    return newest.select("parent_asin", F.unix_seconds("timestamp").alias("sec"), "parent_asin_rating_cnt_365d", "parent_asin_rating_cnt_7d")


def appended_table(spark, sf_dir):
    """Item features saved as a table in two appends and read back through their view."""
    stats = materialize(t.item_window_stats(interactions(spark, sf_dir)))
    base = f"w{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{_place(spark, base)}'")
    early = F.col("timestamp") < F.lit("1995-06-01").cast("timestamp")
    tables.replace_table(stats.filter(early), f"{base}.features")
    tables.append_table(stats.filter(~early), f"{base}.features")
    rows = tables.feature_table(spark, f"{base}.features", ITEM_VIEW)
    return rows.select("parent_asin", F.unix_seconds("timestamp").alias("sec"), "parent_asin_rating_cnt_365d", "parent_asin_rating_cnt_7d")


def vector_collection(spark, sf_dir):
    """Embeddings rebuilt as a collection of unit vectors: every slot."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    place = _place(spark, "vectors")
    tables.replace_vectors(rows, place)
    read = spark.read.parquet(place)
    return read.select("id", F.posexplode("vec").alias("slot", "value")).select("id", F.col("slot").cast("bigint").alias("slot"), F.round(F.col("value").cast("double"), 5).alias("value"))


def month_of_file(spark, sf_dir):
    """Interactions written by month, counted by the month in each file's path."""
    rows = interactions(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp"))
    place = _place(spark, "bymonth")
    reviews.write_by_month(reviews.with_month(rows), place)
    read = spark.read.parquet(place).select(c.month_of_path("_metadata.file_path").alias("month"), "rating")
    return read.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("ratings"))


def known_keys(spark, sf_dir):
    """Rows with a user and an item; those without are dropped."""
    rows = interactions(spark, sf_dir)
    gaps = rows.withColumns({
        "user_id": F.when(F.col("user_id") % 5 != 0, F.col("user_id")), "parent_asin": F.when(F.col("parent_asin") % 7 != 0, F.col("parent_asin")),
    })
    return reviews.with_known_keys(gaps, "user_id", "parent_asin").select("user_id", "parent_asin", "rating", F.unix_seconds("timestamp").alias("sec"))


def user_time_order(spark, sf_dir):
    """Every interaction's place in the order by user, time and item."""
    rows = distinct_interactions(spark, sf_dir)
    placed = row_numbers(rows, [F.col("user_id"), F.col("timestamp"), F.col("parent_asin")], "position")
    return placed.select("user_id", F.unix_seconds("timestamp").alias("sec"), "parent_asin", "position")


def sampled_count(spark, sf_dir):
    """Row count by a sample, and whether it is within a tenth of the exact one."""
    rows = interactions(spark, sf_dir)
    exact = rows.agg(F.count(F.lit(1))).scalar()
    estimate = s.approximate_rows(rows, 0.2).withColumn("exact", exact)
    return estimate.select(F.col("exact").alias("n_rows"), (F.abs(F.col("n_rows") - F.col("exact")) <= F.col("exact") * 0.1).alias("is_close"))


def tagged_item_vectors(spark, sf_dir):
    """Item vectors with the tag embedding appended: every slot."""
    tags = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("parent_asin"), "embedding")
    rows = items(spark, sf_dir).select("parent_asin", array_to_vector(F.array(c.price_number("price"), F.lit(0.0))).alias("item_vector"))
    joined = x.with_tag_embedding(rows.join(tags, "parent_asin", "left"), "embedding", 48)
    return joined.select("parent_asin", F.posexplode(vector_to_array("features")).alias("slot", "value"))


QUERIES = {
    f.__name__: f
    for f in (
        review_scan, snapshot_scan, compaction_rewrite, stream_snapshots, materialised_runs, appended_table, vector_collection, month_of_file, known_keys, user_time_order,
        sampled_count, tagged_item_vectors,
    )
}

_LINE = """'{"user_id":"u' || user_id || '","parent_asin":"' || parent_asin || '","rating"'"""
ORACLE = {
    "review_scan": f"""WITH {INTERACTIONS_SQL}, r AS (SELECT *, (sec // 86400) % 13 = 0 AS cut FROM interactions)
SELECT CASE WHEN NOT cut THEN 'u' || user_id END AS user_id, CASE WHEN NOT cut THEN parent_asin::VARCHAR END AS parent_asin,
  CASE WHEN NOT cut THEN rating END AS rating, CASE WHEN NOT cut THEN sec END AS sec, CASE WHEN cut THEN substr({_LINE}, 1, 20) END AS bad FROM r""",
    "snapshot_scan": """WITH m AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y_%m') AS month FROM orders)
SELECT * FROM m WHERE month IN (SELECT DISTINCT month FROM m ORDER BY month DESC LIMIT 5)""",
    "compaction_rewrite": f"""WITH {INTERACTIONS_SQL} SELECT user_id, parent_asin, rating, sec, strftime(ts, '%Y-%m') AS month, true AS is_named, true AS is_filled FROM interactions""",
    "stream_snapshots": f"""WITH {CLICKS_SQL}, e AS (SELECT min(sec) AS lo, max(sec) AS hi FROM clicks), s AS (SELECT clicks.*, (sec - lo) * 4 // (hi - lo + 1) AS span FROM clicks, e)
SELECT user_id::VARCHAR AS user_id, parent_asin::VARCHAR AS parent_asin, rating, sec FROM s WHERE span IN (SELECT DISTINCT span FROM s ORDER BY span DESC LIMIT 2)""",
    "materialised_runs": f"""WITH {INTERACTIONS_SQL}, stats AS ({_ITEM_STATS})
SELECT parent_asin, sec, parent_asin_rating_cnt_365d, parent_asin_rating_cnt_7d FROM stats
QUALIFY row_number() OVER (PARTITION BY parent_asin ORDER BY sec DESC) = 1""",
    "appended_table": f"WITH {INTERACTIONS_SQL}, stats AS ({_ITEM_STATS}) SELECT parent_asin, sec, parent_asin_rating_cnt_365d, parent_asin_rating_cnt_7d FROM stats",
    "vector_collection": """WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)
SELECT id, unnest(range(len(e))) AS slot, round(unnest(list_transform(e, lambda x: (x / n)::FLOAT))::DOUBLE, 5) AS value FROM v""",
    "month_of_file": f"WITH {INTERACTIONS_SQL} SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n_rows, sum(rating) AS ratings FROM interactions GROUP BY 1",
    "known_keys": f"WITH {INTERACTIONS_SQL} SELECT user_id, parent_asin, rating, sec FROM interactions WHERE user_id % 5 <> 0 AND parent_asin % 7 <> 0",
    "user_time_order": f"WITH {DISTINCT_SQL} SELECT user_id, sec, parent_asin, row_number() OVER (ORDER BY user_id, sec, parent_asin) AS position FROM uniq",
    "sampled_count": f"WITH {INTERACTIONS_SQL} SELECT count(*) AS n_rows, true AS is_close FROM interactions",
    "tagged_item_vectors": f"""WITH {ITEMS_SQL}, j AS (SELECT parent_asin, price, embedding::DOUBLE[] AS e FROM items LEFT JOIN embeddings ON vec_id = parent_asin),
  s AS (SELECT *, unnest(range(50)) AS slot FROM j)
SELECT parent_asin, slot::INTEGER AS slot, CASE WHEN slot = 0 THEN substr(price, 2)::DOUBLE WHEN slot = 1 THEN 0 ELSE coalesce(e[slot - 1], 0) END::DOUBLE AS value FROM s""",
}
