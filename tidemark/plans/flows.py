"""Queries over sources, sinks, streams, models and the training table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import models as m
from tidemark.operators import temporal as t
from tidemark.operators import training as tr
from tidemark.operators.negatives import popularity
from tidemark.operators.sampling import chronological_split
from tidemark.operators.similarity import top_inner_products
from tidemark.plans.tables import CLICKS_SQL, DISTINCT_SQL, INTERACTIONS_SQL, clicks, distinct_interactions, interactions, table
from tidemark.schemas import USER_FRESH_VIEW, ITEM_VIEW
from tidemark.session import materialize, shared_dir
from tidemark.sources import compaction, reviews, snapshots, tables
from tidemark.streaming import capture as cap
from tidemark.streaming import recent_items as recent


def _place(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def month_partition_counts(spark, sf_dir):
    """Interactions written by month from epoch milliseconds, read back by partition."""
    rows = interactions(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp"))
    place = _place(spark, "months")
    reviews.write_by_month(reviews.with_month(rows), place)
    return spark.read.parquet(place).groupBy(F.col("year_month").cast("string").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


BIN_ROWS = 5000


def compaction_bins(spark, sf_dir):
    """Months as files: which are merged to reach the row threshold."""
    rows = reviews.with_month(interactions(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp")))
    counts = rows.groupBy(F.col("year_month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    named = counts.select(F.concat(F.lit("data/year_month="), "month").alias("name"), "n", "month")
    return compaction.bin_names(compaction.bins(named, BIN_ROWS), "merged")


def _files(spark, sf_dir):
    day = F.date_format("o_orderdate", "yyyy_MM_dd")
    names = table(spark, sf_dir, "orders").select(F.concat(F.lit("interactions_upto_"), day, F.lit(".parquet")).alias("path"))
    return snapshots.dated(names.distinct())


def newest_snapshots(spark, sf_dir):
    return snapshots.newest(_files(spark, sf_dir)).select("path", F.col("snapshot_date").cast("string").alias("snapshot_date"))


def freshness(spark, sf_dir):
    """Is the newest order file as new as the newest event day."""
    as_of = table(spark, sf_dir, "events").agg(F.max(F.to_date("ts"))).scalar()
    return snapshots.freshness(_files(spark, sf_dir), as_of).select(F.col("newest").cast("string").alias("newest"), "is_fresh")


def warehouse_load(spark, sf_dir):
    """Old and new orders' interactions as one warehouse table, by year."""
    rows = interactions(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp"))
    early = F.col("timestamp") < 946684800000
    train, val = rows.filter(early).withColumn("images", F.array(F.lit("x"))), rows.filter(~early)
    loaded = tables.warehouse_rows(train, val)
    return loaded.groupBy(F.year("timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("ratings")
    )


def event_messages(spark, sf_dir):
    """Events as JSON messages with the item taken from the props."""
    rows = clicks(spark, sf_dir).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("parent_asin").cast("string").alias("item_id"),
        F.col("rating"),
        F.when(F.col("event_type") != "error", F.unix_seconds("timestamp")).alias("timestamp"),
    )
    return tables.event_messages(rows, 1700000000)


def _event_stream(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return spark.readStream.schema(rows.schema).parquet(f"{sf_dir}/event[s].parquet")


def stream_capture(spark, sf_dir):
    """Event rows as JSON messages, some broken, some without user, some NULL, captured by a stream."""
    stream = _event_stream(spark, sf_dir)
    body = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        F.col("value").alias("rating"),
        F.when(F.col("event_type") != "view", F.unix_seconds(F.col("ts").cast("timestamp"))).alias("timestamp"),
    ))
    nameless = F.to_json(F.struct(F.get_json_object("props", "$.k").alias("item_id"), F.col("value").alias("rating")))
    broken = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), body))
        .when(F.col("event_id") % 7 == 3, nameless)
        .when(F.col("event_id") % 11 != 5, body)
    )
    place = _place(spark, "capture")
    cap.capture(stream.select(broken.alias("value")), f"{place}/good", f"{place}/bad", f"{place}/checkpoints", 1700000000)
    good = spark.read.parquet(f"{place}/good").select(
        F.lit("good").alias("kind"), "user_id", F.col("parent_asin"), "rating", F.unix_seconds("timestamp").alias("sec"),
        F.lit(None).cast("string").alias("value"),
    )
    bad = spark.read.schema("value string").parquet(f"{place}/bad").select(
        F.lit("bad").alias("kind"), F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("string").alias("parent_asin"),
        F.lit(None).cast("double").alias("rating"), F.lit(None).cast("bigint").alias("sec"), "value",
    )
    return good.unionByName(bad)


def stream_recent_items(spark, sf_dir):
    """Newest ten items per user, kept by the stateful stream."""
    stream = _event_stream(spark, sf_dir).select(
        "user_id", F.get_json_object("props", "$.k").alias("item"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    )
    place = _place(spark, "recent")
    recent.run_available(recent.recent_items_stream(stream), f"{place}/out", f"{place}/checkpoint")
    lists = recent.current_lists(spark.read.parquet(f"{place}/out"))
    text = lambda name: F.concat_ws(",", F.transform(name, lambda x: x.cast("string"))).alias(name)
    return lists.select("user_id", "at", text("items"), text("times"))


def materialised_features(spark, sf_dir):
    """Item features brought into a store in two runs, then read as the newest rows."""
    stats = materialize(t.item_window_stats(interactions(spark, sf_dir)))
    place = _place(spark, "store")
    tables.materialise(spark, stats, ITEM_VIEW, place, "1999-01-01 00:00:00")
    tables.materialise(spark, stats, ITEM_VIEW, place, "2030-01-01 00:00:00")
    newest = tables.read_store(spark, ITEM_VIEW, place)
    return newest.select("parent_asin", F.unix_seconds("timestamp").alias("sec"), "parent_asin_rating_cnt_365d", "parent_asin_rating_cnt_7d")


def live_features(spark, sf_dir):
    """User rows still fresh one day after the newest event."""
    rows = clicks(spark, sf_dir)
    lists = t.recent_items(rows).withColumns(
        {"user_rating_cnt_90d": F.lit(0), "user_rating_avg_prev_rating_90d": F.lit(0.0)}
    )
    newest = t.latest_per_key(lists, "user_id", "timestamp")
    as_of = rows.agg(F.max("timestamp") + F.expr("interval 20 hours")).scalar()
    return USER_FRESH_VIEW.live(newest, as_of).select("user_id", F.unix_micros("timestamp").alias("us"), "user_rating_list_10_recent_asin")


def train_and_validation(spark, sf_dir):
    # The split and all that is made from its parts read the rows many times: they are joined once.
    rows = materialize(distinct_interactions(spark, sf_dir))
    return chronological_split(rows, "timestamp", ["user_id", "parent_asin", "rating"])


def ranker_training_table(spark, sf_dir):
    """Rows, user features and item counts of the training table by split and label."""
    rows = tr.ranker_training_table(*train_and_validation(spark, sf_dir))
    return rows.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("user_rating_cnt_90d").alias("user_cnt"),
        F.sum(F.when(F.col("label") == 1, F.col("parent_asin_rating_cnt_365d"))).alias("item_cnt"),
    )


def item2vec_vectors(spark, sf_dir):
    """Item embeddings from user sequences: every item with a neighbour has one (training is not repeatable elsewhere)."""
    vectors = m.item_embeddings(distinct_interactions(spark, sf_dir), dim=16)
    sound = F.forall("vec", lambda v: ~F.isnan(v) & (F.abs(v) < 1000)) & F.exists("vec", lambda v: v != 0)
    return vectors.select("id", F.size("vec").alias("size"), sound.alias("is_sound"))


def user_top_items(spark, sf_dir):
    """All users scored against all items with vectors; the ten best each."""
    rows = clicks(spark, sf_dir)
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    users = m.user_vectors(rows, vectors, 64)
    found = top_inner_products(users, vectors.withColumn("vec", F.col("vec").cast("array<double>")), 10, block_rows=64)
    return found.select(F.col("qid").alias("user_id"), F.col("id").alias("parent_asin"), "rank", F.round("score", 6).alias("score"))


QUERIES = {
    f.__name__: f
    for f in (
        month_partition_counts, compaction_bins, newest_snapshots, freshness, warehouse_load, event_messages,
        stream_capture, stream_recent_items, materialised_features, live_features, ranker_training_table,
        item2vec_vectors, user_top_items,
    )
}

from tidemark.plans.temporal import _ITEM_STATS, _RECENT, _USER_STATS  # noqa: E402

ORACLE = {
    "item2vec_vectors": f"""WITH {DISTINCT_SQL}, r AS (SELECT parent_asin, count(*) OVER (PARTITION BY user_id) AS n FROM uniq)
SELECT DISTINCT parent_asin AS id, 16 AS size, true AS is_sound FROM r WHERE n > 1""",
    "month_partition_counts": f"WITH {INTERACTIONS_SQL} SELECT strftime(ts, '%Y-%m') AS year_month, count(*) AS n_rows FROM interactions GROUP BY 1",
    "compaction_bins": f"""WITH RECURSIVE {INTERACTIONS_SQL}, f AS (SELECT month, n, row_number() OVER (ORDER BY month) AS i FROM
    (SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n FROM interactions GROUP BY 1)),
  b AS (SELECT i, month, n, 1::BIGINT AS bin, n AS filled FROM f WHERE i = 1
    UNION ALL SELECT f.i, f.month, f.n, CASE WHEN b.filled >= {BIN_ROWS} THEN b.bin + 1 ELSE b.bin END,
      CASE WHEN b.filled >= {BIN_ROWS} THEN f.n ELSE b.filled + f.n END FROM b JOIN f ON f.i = b.i + 1)
SELECT bin, 'merged_' || min(month) || '_' || max(month) || '_id' || bin AS output, sum(n)::BIGINT AS n_rows FROM b GROUP BY bin""",
    "newest_snapshots": """SELECT DISTINCT 'interactions_upto_' || strftime(o_orderdate, '%Y_%m_%d') || '.parquet' AS path,
  strftime(o_orderdate, '%Y-%m-%d') AS snapshot_date FROM orders ORDER BY snapshot_date DESC LIMIT 5""",
    "freshness": """SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS newest,
  max(o_orderdate)::DATE = (SELECT max(ts)::DATE FROM events) AS is_fresh FROM orders""",
    "warehouse_load": f"""WITH {INTERACTIONS_SQL} SELECT year(ts)::INTEGER AS year, count(*) AS n_rows, sum(rating) AS ratings FROM interactions GROUP BY 1""",
    "event_messages": f"""WITH {CLICKS_SQL} SELECT 'u' || user_id AS key, '{{"user_id":"u' || user_id || '","item_id":"' || parent_asin
  || '","rating":' || rating || ',"timestamp":' || CASE WHEN event_type <> 'error' THEN sec ELSE 1700000000 END || '}}' AS value FROM clicks""",
    "stream_capture": f"""WITH {CLICKS_SQL}, m AS (SELECT *, CASE WHEN event_type = 'error' THEN 0 WHEN event_id % 7 = 3 THEN 1 WHEN event_id % 11 = 5 THEN 2 ELSE 3 END AS kind FROM clicks)
SELECT 'good' AS kind, user_id::VARCHAR AS user_id, parent_asin::VARCHAR AS parent_asin, rating,
  CASE WHEN event_type = 'view' THEN 1700000000 ELSE sec END AS sec, NULL AS value FROM m WHERE kind = 3
UNION ALL SELECT 'bad', NULL, NULL, NULL, NULL, CASE kind WHEN 0 THEN '{{broken {{"user_id":"' || user_id || '","item_id":"' || parent_asin || '","rating":' || rating || ',"timestamp":' || sec || '}}'
  WHEN 1 THEN '{{"item_id":"' || parent_asin || '","rating":' || rating || '}}' END FROM m WHERE kind < 3""",
    "stream_recent_items": f"""WITH {CLICKS_SQL}, r AS (SELECT user_id, us, parent_asin::VARCHAR AS item FROM clicks
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, parent_asin::VARCHAR DESC) <= 10)
SELECT user_id, max(us) AS at, string_agg(item, ',' ORDER BY us, item) AS items, string_agg(us::VARCHAR, ',' ORDER BY us, item) AS times
FROM r GROUP BY 1""",
    "materialised_features": f"""WITH {INTERACTIONS_SQL}, stats AS ({_ITEM_STATS})
SELECT parent_asin, sec, parent_asin_rating_cnt_365d, parent_asin_rating_cnt_7d FROM stats
QUALIFY row_number() OVER (PARTITION BY parent_asin ORDER BY sec DESC) = 1""",
    "live_features": f"""WITH {CLICKS_SQL}, lists AS ({_RECENT.format(t="us", src="clicks")}),
  newest AS (SELECT user_id, us, user_rating_list_10_recent_asin FROM lists QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC) = 1)
SELECT * FROM newest WHERE us >= (SELECT max(us) FROM clicks) + {20 * 3600 * 1_000_000} - {24 * 3600 * 1_000_000}""",
    "ranker_training_table": f"""WITH {DISTINCT_SQL.replace("interactions AS (", "interactions AS MATERIALIZED (", 1)},
  numbered AS (SELECT *, row_number() OVER (ORDER BY sec, user_id, parent_asin, rating) AS rn, count(*) OVER () AS total FROM uniq),
  cut AS (SELECT max(sec) + 1 AS c FROM numbered WHERE rn <= floor(total * 0.8)),
  us AS ({_USER_STATS.replace("(SELECT DISTINCT * FROM interactions)", "uniq")}),
  its AS ({_ITEM_STATS.replace("(SELECT DISTINCT * FROM interactions)", "uniq")}),
  j AS (SELECT uniq.*, user_rating_cnt_90d, parent_asin_rating_cnt_365d, CASE WHEN uniq.sec < c THEN 'train' ELSE 'val' END AS split
    FROM uniq JOIN us USING (user_id, sec) JOIN its USING (parent_asin, sec), cut)
SELECT split, label, count(*) AS n_rows, sum(user_rating_cnt_90d)::BIGINT AS user_cnt,
  sum(CASE WHEN label = 1 THEN parent_asin_rating_cnt_365d END)::BIGINT AS item_cnt
FROM j, (VALUES (0), (1)) l(label) GROUP BY ALL""",
    "user_top_items": f"""WITH {CLICKS_SQL}, v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings),
  held AS (SELECT DISTINCT user_id, parent_asin FROM clicks),
  slots AS (SELECT user_id, i, avg(vec[i]) AS m FROM held JOIN v ON id = parent_asin, range(1, 65) r(i) GROUP BY ALL),
  u AS (SELECT user_id, list(m ORDER BY i) AS vec FROM slots GROUP BY 1),
  s AS (SELECT user_id, v.id, list_dot_product(u.vec, v.vec) AS score FROM u, v)
SELECT user_id, id AS parent_asin, round(s.score, 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY s.score DESC, id)::INTEGER AS rank
FROM s QUALIFY rank <= 10""",
}
