"""Queries over rolling statistics, recent items, point-in-time joins and latest rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import recency_buckets
from tidemark.operators import temporal as t
from tidemark.operators.asof import as_of_join
from tidemark.operators.keys import first_per_key, uniqueness_violations
from tidemark.operators.recommend import fresh_or_batch
from tidemark.plans.tables import (
    CLICKS_SQL,
    DISTINCT_SQL,
    INTERACTIONS_SQL,
    clicks,
    distinct_interactions,
    interactions,
)

DAY = t.DAY
SECONDS = lambda c="timestamp": F.unix_seconds(c)


def _with_sec(df):
    return df.withColumn("sec", SECONDS()).drop("timestamp")


def item_window_stats(spark, sf_dir):
    return _with_sec(t.item_window_stats(interactions(spark, sf_dir)))


def user_window_stats(spark, sf_dir):
    return _with_sec(t.user_window_stats(interactions(spark, sf_dir)))


def click_window_stats(spark, sf_dir):
    """Sub-second stamps; some values are NaN, some very large, some very small: they count while they are in the window."""
    odd = F.when(F.col("event_id") % 97 == 0, float("nan")).when(F.col("event_id") % 101 == 0, F.col("rating") * 1e19)
    odd = odd.when(F.col("event_id") % 3 == 0, F.col("rating") * 1e-10).otherwise(F.col("rating"))
    rows = clicks(spark, sf_dir).select("parent_asin", "timestamp", odd.alias("rating"), "user_id")
    stats = t.rolling_stats(
        rows, "parent_asin", "timestamp", "rating",
        [t.Rolling("cnt_7d", 7 * DAY, "count"), t.Rolling("avg_7d", 7 * DAY, "mean"),
         t.Rolling("cnt_1d_now", DAY, "count_now")],
    )
    return stats.select(
        "parent_asin", F.unix_micros("timestamp").alias("us"), "cnt_7d", "cnt_1d_now",
        F.when(F.isnan("avg_7d"), -1.0).when(F.col("avg_7d").isNotNull(), F.format_string("%.8e", "avg_7d").cast("double")).alias("avg_7d"),
    )


def user_recent_items(spark, sf_dir):
    lists = t.recent_items(interactions(spark, sf_dir))
    return lists.select(
        "user_id", SECONDS().alias("sec"),
        "user_rating_list_10_recent_asin", "user_rating_list_10_recent_asin_timestamp",
        F.col("dedup_rn").cast("bigint").alias("dedup_rn"),
    )


def user_features(spark, sf_dir):
    return t.user_features(interactions(spark, sf_dir)).select(
        "user_id", SECONDS().alias("sec"), "user_rating_cnt_90d", "user_rating_avg_prev_rating_90d",
        "user_rating_list_10_recent_asin",
    )


def _click_queries(spark, sf_dir):
    return clicks(spark, sf_dir).filter("event_type = 'click'").select("event_id", "user_id", "timestamp")


def _click_features(spark, sf_dir):
    """Feature rows: one per (user, time) of purchases, with the value seen."""
    rows = clicks(spark, sf_dir).filter("event_type = 'purchase'")
    return rows.groupBy("user_id", "timestamp").agg(F.max("rating").alias("last_value"))


def _asof(spark, sf_dir, ttl):
    joined = as_of_join(
        _click_queries(spark, sf_dir), _click_features(spark, sf_dir), "user_id", "timestamp",
        ["last_value"], ttl,
    )
    return joined.select(
        "event_id", "user_id", F.unix_micros("timestamp").alias("us"),
        F.unix_micros("feature_time").alias("feature_us"), "last_value",
    )


def asof_features(spark, sf_dir):
    return _asof(spark, sf_dir, None)


def asof_features_ttl(spark, sf_dir):
    return _asof(spark, sf_dir, 6 * 3600)


def asof_item_features(spark, sf_dir):
    """Item statistics of the interactions joined back at the order date, within 365 days."""
    from tidemark.plans.tables import table

    rows = interactions(spark, sf_dir)
    features = t.item_window_stats(rows)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("parent_asin"))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
    )
    queries = lines.join(orders, "l_orderkey").distinct()
    joined = as_of_join(
        queries, features, "parent_asin", "timestamp",
        ["parent_asin_rating_cnt_365d", "parent_asin_rating_avg_prev_rating_365d"], 365 * DAY,
        hot_from=rows,
    )
    return joined.select(
        "l_orderkey", "parent_asin", SECONDS().alias("sec"), SECONDS("feature_time").alias("feature_sec"),
        "parent_asin_rating_cnt_365d", "parent_asin_rating_avg_prev_rating_365d",
    )


def latest_features(spark, sf_dir):
    stats = t.item_window_stats(interactions(spark, sf_dir))
    return _with_sec(t.latest_per_key(stats, "parent_asin", "timestamp")).select(
        "parent_asin", "sec", "parent_asin_rating_cnt_365d", "parent_asin_rating_avg_prev_rating_365d"
    )


def fresh_or_batch_features(spark, sf_dir):
    """Views live on the last day of events are fresh; others fall back to the whole-history row."""
    rows = clicks(spark, sf_dir)
    newest = rows.agg(F.max("timestamp")).scalar()
    lists = t.recent_items(rows).select("user_id", "timestamp", "user_rating_list_10_recent_asin")
    batch = t.latest_per_key(lists, "user_id", "timestamp")
    recent = lists.filter(F.col("timestamp") >= newest - F.expr("interval 3 hours"))
    fresh = t.latest_per_key(recent, "user_id", "timestamp")
    users = rows.select("user_id").distinct()
    return fresh_or_batch(users, fresh, batch, "user_id", "user_rating_list_10_recent_asin").select(
        "user_id", F.unix_micros("timestamp").alias("us"), "user_rating_list_10_recent_asin", "is_fresh"
    )


def history_sequence_padded(spark, sf_dir):
    rows = distinct_interactions(spark, sf_dir)
    out = t.history_sequences(rows, item="parent_asin")
    return out.select(
        "user_id", "parent_asin", SECONDS().alias("sec"),
        F.array_join("item_sequence", ",").alias("item_sequence"),
    )


def sequence_ts_buckets(spark, sf_dir):
    """Ages of the recent items at each row's time, bucketed, -1 where padded."""
    lists = t.recent_items(interactions(spark, sf_dir))
    padded = t.left_pad(F.col("recent_times"), 10, -1)
    return lists.select(
        "user_id", SECONDS().alias("sec"),
        F.array_join(recency_buckets(padded, SECONDS()), ",").alias("buckets"),
    )


def dedup_keys(spark, sf_dir):
    rows = interactions(spark, sf_dir).select("user_id", "parent_asin", "rating", "timestamp")
    return _with_sec(first_per_key(rows, ["user_id", "parent_asin", "timestamp"], ["rating"]))


def uniqueness_check(spark, sf_dir):
    rows = _with_sec(interactions(spark, sf_dir))
    return uniqueness_violations(rows, ["user_id", "sec"])


def first_row_per_user(spark, sf_dir):
    rows = distinct_interactions(spark, sf_dir).select("user_id", "timestamp", "parent_asin", "rating")
    return _with_sec(first_per_key(rows, ["user_id"], ["timestamp", "parent_asin"]))


QUERIES = {
    f.__name__: f
    for f in (
        item_window_stats, user_window_stats, click_window_stats, user_recent_items, user_features,
        asof_features, asof_features_ttl, asof_item_features, latest_features,
        fresh_or_batch_features, history_sequence_padded, sequence_ts_buckets, dedup_keys,
        first_row_per_user,
    )
}
QUERIES["uniqueness_violations"] = uniqueness_check

_ITEM_STATS = "SELECT DISTINCT parent_asin, sec," + ",".join(
    f"""
  count(*) OVER w{d} AS parent_asin_rating_cnt_{d}d,
  avg(rating) OVER w{d} AS parent_asin_rating_avg_prev_rating_{d}d"""
    for d in (365, 90, 30, 7)
) + "\nFROM (SELECT DISTINCT * FROM interactions)\nWINDOW " + ",\n  ".join(
    f"w{d} AS (PARTITION BY parent_asin ORDER BY sec RANGE BETWEEN {d * DAY} PRECEDING AND 1 PRECEDING)"
    for d in (365, 90, 30, 7)
)
_USER_STATS = f"""SELECT DISTINCT user_id, sec,
  count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN {90 * DAY} PRECEDING AND CURRENT ROW) AS user_rating_cnt_90d,
  avg(rating) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN {90 * DAY} PRECEDING AND 1 PRECEDING) AS user_rating_avg_prev_rating_90d
FROM (SELECT DISTINCT * FROM interactions)"""
_RECENT = """SELECT user_id, {t}, items AS user_rating_list_10_recent_asin,
  times AS user_rating_list_10_recent_asin_timestamp, dedup_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, {t} ORDER BY n DESC, parent_asin, rating) AS dedup_rn FROM (
    SELECT user_id, {t}, parent_asin, rating, count(*) OVER w AS n,
      string_agg(parent_asin::VARCHAR, ',') OVER w AS items, string_agg(sec::VARCHAR, ',') OVER w AS times
    FROM (SELECT DISTINCT user_id, {t}, sec, parent_asin, rating FROM {src})
    WINDOW w AS (PARTITION BY user_id ORDER BY {t}, parent_asin, rating ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)))
WHERE dedup_rn = 1"""
_ASOF = CLICKS_SQL + """, f AS (SELECT user_id, us, max(rating) AS last_value FROM clicks
    WHERE event_type = 'purchase' GROUP BY ALL),
  q AS (SELECT event_id, user_id, us FROM clicks WHERE event_type = 'click'),
  j AS (SELECT q.event_id, q.user_id, q.us, f.us AS fus, f.last_value AS v
    FROM q ASOF LEFT JOIN f ON q.user_id = f.user_id AND q.us >= f.us)"""

# Exact sums: values from 1e9 on in units of 2 ** 10, the others in units of 2 ** -80.
_LARGE = "(coalesce(sum(CASE WHEN rating >= 1e9 AND NOT isnan(rating) THEN (rating / 1024)::HUGEINT END) OVER w7, 0)::DOUBLE * 1024)"
_SMALL = "(coalesce(sum(CASE WHEN rating < 1e9 THEN (rating * pow(2, 80))::HUGEINT END) OVER w7, 0)::DOUBLE / pow(2, 80))"
_MEAN = f"CASE WHEN count(rating) OVER w7 > 0 THEN printf('%.8e', ({_LARGE} + {_SMALL}) / (count(rating) OVER w7))::DOUBLE END"

ORACLE = {
    "item_window_stats": f"WITH {INTERACTIONS_SQL} {_ITEM_STATS}",
    "user_window_stats": f"WITH {INTERACTIONS_SQL} {_USER_STATS}",
    "click_window_stats": f"""WITH {CLICKS_SQL}, o AS (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 101 = 0 THEN rating * 1e19 WHEN event_id % 3 = 0 THEN rating * 1e-10 ELSE rating END AS odd FROM clicks),
  d AS (SELECT DISTINCT parent_asin, us, sec, odd AS rating, user_id FROM o)
SELECT DISTINCT parent_asin, us,
  count(*) OVER (PARTITION BY parent_asin ORDER BY sec RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING) AS cnt_7d,
  count(*) OVER (PARTITION BY parent_asin ORDER BY sec RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW) AS cnt_1d_now,
  CASE WHEN isnan(avg(rating) OVER w7) THEN -1 ELSE {_MEAN} END AS avg_7d
FROM d WINDOW w7 AS (PARTITION BY parent_asin ORDER BY sec RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING)""",
    "user_recent_items": f"WITH {INTERACTIONS_SQL} " + _RECENT.format(t="sec", src="interactions"),
    "user_features": f"""WITH {INTERACTIONS_SQL}, lists AS ({_RECENT.format(t="sec", src="interactions")}),
  stats AS ({_USER_STATS})
SELECT user_id, sec, user_rating_cnt_90d, user_rating_avg_prev_rating_90d, user_rating_list_10_recent_asin
FROM stats JOIN lists USING (user_id, sec)""",
    "asof_features": f"WITH {_ASOF} SELECT event_id, user_id, us, fus AS feature_us, v AS last_value FROM j",
    "asof_features_ttl": f"""WITH {_ASOF} SELECT event_id, user_id, us,
  CASE WHEN us - fus <= {6 * 3600 * 1_000_000} THEN fus END AS feature_us,
  CASE WHEN us - fus <= {6 * 3600 * 1_000_000} THEN v END AS last_value FROM j""",
    "asof_item_features": f"""WITH {INTERACTIONS_SQL}, stats AS ({_ITEM_STATS}),
  q AS (SELECT DISTINCT l_orderkey, l_partkey AS parent_asin, epoch(o_orderdate)::BIGINT AS sec
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  j AS (SELECT q.*, CASE WHEN q.sec - s.sec <= {365 * DAY} THEN s.sec END AS feature_sec,
          s.parent_asin_rating_cnt_365d AS c, s.parent_asin_rating_avg_prev_rating_365d AS a
        FROM q ASOF LEFT JOIN stats s ON q.parent_asin = s.parent_asin AND q.sec >= s.sec)
SELECT l_orderkey, parent_asin, sec, feature_sec,
  CASE WHEN feature_sec IS NOT NULL THEN c END AS parent_asin_rating_cnt_365d,
  CASE WHEN feature_sec IS NOT NULL THEN a END AS parent_asin_rating_avg_prev_rating_365d FROM j""",
    "latest_features": f"""WITH {INTERACTIONS_SQL}, stats AS ({_ITEM_STATS})
SELECT parent_asin, sec, parent_asin_rating_cnt_365d, parent_asin_rating_avg_prev_rating_365d
FROM stats QUALIFY row_number() OVER (PARTITION BY parent_asin ORDER BY sec DESC) = 1""",
    "fresh_or_batch_features": f"""WITH {CLICKS_SQL}, lists AS ({_RECENT.format(t="us", src="clicks")}),
  batch AS (SELECT user_id, us, user_rating_list_10_recent_asin AS l FROM lists
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC) = 1),
  fresh AS (SELECT * FROM batch WHERE us >= (SELECT max(us) FROM clicks) - {3 * 3600 * 1_000_000})
SELECT u.user_id, CASE WHEN f.l IS NOT NULL THEN f.us ELSE b.us END AS us,
  coalesce(f.l, b.l) AS user_rating_list_10_recent_asin, f.l IS NOT NULL AS is_fresh
FROM (SELECT DISTINCT user_id FROM clicks) u LEFT JOIN fresh f USING (user_id) LEFT JOIN batch b USING (user_id)""",
    "history_sequence_padded": f"""WITH {DISTINCT_SQL}, h AS (
  SELECT user_id, sec, first_value(l) OVER (PARTITION BY user_id, sec ORDER BY parent_asin) AS l, parent_asin
  FROM (SELECT *, list(parent_asin) OVER (PARTITION BY user_id ORDER BY sec, parent_asin
          ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l FROM uniq))
SELECT user_id, parent_asin, sec,
  array_to_string(list_concat(list_resize([]::BIGINT[], 10 - coalesce(len(l), 0), -1), coalesce(l, [])), ',') AS item_sequence
FROM h""",
    "sequence_ts_buckets": f"""WITH {INTERACTIONS_SQL}, lists AS ({_RECENT.format(t="sec", src="interactions")}),
  r AS (SELECT user_id, sec, coalesce(list_transform(string_split(user_rating_list_10_recent_asin_timestamp, ','), lambda x: x::BIGINT), []) AS l FROM lists)
SELECT user_id, sec, array_to_string(list_concat(list_resize([]::INTEGER[], 10 - len(l), -1),
  list_transform(l, lambda x: CASE WHEN sec - x < 600 THEN 0 WHEN sec - x < 3600 THEN 1 WHEN sec - x < 86400 THEN 2
    WHEN sec - x < 604800 THEN 3 WHEN sec - x < 2592000 THEN 4 WHEN sec - x < 31536000 THEN 5
    WHEN sec - x < 94608000 THEN 6 WHEN sec - x < 157680000 THEN 7 WHEN sec - x < 315360000 THEN 8 ELSE 9 END)), ',') AS buckets
FROM r""",
    "dedup_keys": f"""WITH {INTERACTIONS_SQL} SELECT user_id, parent_asin, sec, min(rating) AS rating
FROM interactions GROUP BY ALL""",
    "uniqueness_violations": f"""WITH {INTERACTIONS_SQL} SELECT user_id, sec, count(*) AS n_rows
FROM interactions GROUP BY ALL HAVING count(*) > 1""",
    "first_row_per_user": f"""WITH {DISTINCT_SQL} SELECT user_id, sec, parent_asin, rating FROM uniq
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sec, parent_asin) = 1""",
}
