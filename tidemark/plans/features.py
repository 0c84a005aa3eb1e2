"""Queries over fitted transforms, text functions and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import evaluate as e
from tidemark.operators import temporal as t
from tidemark.operators import transforms as x
from tidemark.operators.keys import first_per_key
from tidemark.operators.sampling import hash_share
from tidemark.plans.tables import CLICKS_SQL, INTERACTIONS_SQL, ITEMS_SQL, clicks, interactions, items, table
from tidemark.plans.temporal import _ITEM_STATS
from tidemark.session import materialize

STATS = [m.name for m in t.ITEM_MEASURES]


def price_scaled(spark, sf_dir):
    rows = items(spark, sf_dir).select("parent_asin", "price")
    return x.min_max_scaled(rows, {"price_scaled": c.price_number("price")})


def onehot_category(spark, sf_dir):
    """Active slot and vector size of each item's category."""
    rows = items(spark, sf_dir).select("parent_asin", "main_category")
    return x.with_category_slot(rows, x.category_slots(rows, "main_category"), "main_category").select("parent_asin", "slot", "n_slots")


def category_counts(spark, sf_dir):
    return x.category_counts(items(spark, sf_dir), "parent_asin")


def rating_stats_scaled(spark, sf_dir):
    """Newest statistics of each item, standardised."""
    # Read twice, for the scale and for the rows: one row an item.
    latest = materialize(t.latest_per_key(t.item_window_stats(interactions(spark, sf_dir)), "parent_asin", "timestamp"))
    scaled = x.standardised(latest, STATS)
    return scaled.select("parent_asin", *[F.round(s, 5).alias(s) for s in STATS])


def item_vectors(spark, sf_dir):
    """The whole item encoder: squared length of each vector and its size."""
    from pyspark.ml.functions import vector_to_array

    latest = t.latest_per_key(t.item_window_stats(interactions(spark, sf_dir)), "parent_asin", "timestamp")
    rows = materialize(items(spark, sf_dir).join(latest, "parent_asin"))
    encoded = x.ItemEncoder.fit(rows, STATS).transform(rows)
    array = vector_to_array("item_vector")
    return encoded.select("parent_asin", F.size(array).alias("size"), F.round(c.dot(array, array), 6).alias("squared"))


def tfidf_terms(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return x.tfidf(docs, "doc_id", "text").withColumn("weight", F.round("weight", 5))


def category_lines(spark, sf_dir):
    return items(spark, sf_dir).select("parent_asin", c.joined_lines("categories").alias("lines"))


def tags_top5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", c.top_tags(c.parsed_tags("text")).alias("tags"))


def prompt_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", c.tag_prompt("text").alias("prompt"))


def fixed_vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    longer = rows.select("vec_id", F.posexplode(c.fixed_length("embedding", 384)).alias("slot", "value"))
    shorter = rows.select("vec_id", F.posexplode(c.fixed_length("embedding", 10)).alias("slot", "value"))
    return longer.withColumn("size", F.lit(384)).unionByName(shorter.withColumn("size", F.lit(10)))


def item_tag_vectors(spark, sf_dir):
    """Every item with its tag embedding in fixed shape, zeros where it has none."""
    tags = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("parent_asin"), "embedding")
    joined = items(spark, sf_dir).select("parent_asin").join(tags, "parent_asin", "left")
    return joined.select("parent_asin", F.posexplode(c.fixed_length("embedding", 384)).alias("slot", "value"))


def parsed_numbers(spark, sf_dir):
    """Numbers and texts taken from free text without failing."""
    rows = table(spark, sf_dir, "events")
    return rows.select(
        "event_id", c.as_float(F.get_json_object("props", "$.k")).alias("k"),
        c.as_float("event_type").alias("not_a_number"), c.as_text(F.get_json_object("props", "$.none")).alias("none"),
        c.price_number("props").alias("first_number"), c.utc_stamp("ts").alias("stamp"),
    )


def _scored(spark, sf_dir):
    """Labels with a fixed score of three digits, so that scores tie."""
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return rows.withColumn("score", F.floor(hash_share(["doc_id"], 7) * 100) / 100)


def roc_auc(spark, sf_dir):
    return e.roc_auc(_scored(spark, sf_dir)).select(F.round("roc_auc", 9).alias("roc_auc"))


def average_precision(spark, sf_dir):
    return e.average_precision(_scored(spark, sf_dir)).select(F.round("average_precision", 9).alias("average_precision"))


def pr_table(spark, sf_dir):
    return e.precision_recall_table(_scored(spark, sf_dir))


def weighted_logloss(spark, sf_dir):
    weighted = e.class_weights(_scored(spark, sf_dir))
    return e.weighted_logloss(weighted, weight="weight").withColumn("logloss", F.round("logloss", 8))


K, TOP = 10, 20
LABELS_FROM = "2000-01-01"


def ranking_metrics(spark, sf_dir):
    """Hash-scored known pairs as recommendations, interactions since 2000 as labels."""
    rows = interactions(spark, sf_dir)
    pairs = rows.select("user_id", "parent_asin").distinct()
    scored = pairs.withColumn("score", hash_share(["user_id", "parent_asin"], 3))
    recs = e.recommendation_ranks(scored, k=TOP)
    since = rows.filter(F.col("timestamp") >= F.lit(LABELS_FROM).cast("timestamp"))
    best = since.groupBy("user_id", "parent_asin").agg(
        F.max("rating").alias("rating"), F.max("timestamp").alias("timestamp")
    )
    merged = e.recs_with_labels(recs, e.label_ranks(best), TOP)
    out = e.ranking_metrics(merged, K, TOP)
    metrics = ["ndcg", "precision", "recall", "fbeta", "personalization"]
    return out.select("n_users", *[F.round(m, 9).alias(m) for m in metrics])


def label_ranks(spark, sf_dir):
    rows = interactions(spark, sf_dir).groupBy("user_id", "parent_asin").agg(
        F.max("rating").alias("rating"), F.max("timestamp").alias("timestamp")
    )
    return e.label_ranks(rows)


def _halves(spark, sf_dir):
    rows = clicks(spark, sf_dir)
    value = lambda df: df.groupBy(F.concat(F.lit("val_"), "event_type").alias("metric")).agg(F.max("rating").alias("value")).unionByName(
        df.groupBy(F.concat(F.lit("rows_"), "event_type").alias("metric")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    )
    middle = F.lit("2024-01-16").cast("timestamp")
    return value(rows.filter(F.col("timestamp") < middle)), value(rows.filter(F.col("timestamp") >= middle))


def metric_diff(spark, sf_dir):
    return e.metric_diff(*_halves(spark, sf_dir))


def _log(spark, sf_dir):
    return clicks(spark, sf_dir).select(
        F.col("event_type").alias("tag"), F.col("event_id").alias("step"), F.round(F.col("rating") * 100).alias("value")
    )


def metric_log_summary(spark, sf_dir):
    return e.metric_log_summary(_log(spark, sf_dir))


def final_gap(spark, sf_dir):
    return e.final_gap(_log(spark, sf_dir), "click", "purchase")


def promotion_candidates(spark, sf_dir):
    """Order priorities as models, customers as runs, prices as metrics."""
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("model"), F.col("o_custkey").alias("run")).agg(
        (F.max("o_totalprice") / 500000).alias("val_roc_auc"), (F.min("o_totalprice") / 500000).alias("roc_auc")
    )
    return e.promotion_candidates(runs, 0.5)


def undeployed_versions(spark, sf_dir):
    status = F.col("o_orderstatus")
    aliases = F.when(status == "F", F.array(F.lit("newly"))).when(status == "O", F.array(F.lit("newly"), F.lit("deployed")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", aliases.alias("aliases"))
    return e.undeployed_versions(rows).select("o_orderkey")


QUERIES = {
    f.__name__: f
    for f in (
        price_scaled, onehot_category, category_counts, rating_stats_scaled, item_vectors, tfidf_terms,
        category_lines, tags_top5, prompt_text, fixed_vectors, item_tag_vectors, parsed_numbers, roc_auc, average_precision,
        pr_table, weighted_logloss, ranking_metrics, label_ranks, metric_diff, metric_log_summary,
        final_gap, promotion_candidates, undeployed_versions,
    )
}

_SHARE = "('0x' || substr(md5(concat_ws('|', {keys})), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE"
_SCORED = f"""scored AS (SELECT doc_id, quality AS label, floor({_SHARE.format(keys="doc_id, 7")} * 100) / 100 AS score FROM labels),
  st AS (SELECT score, sum(CASE WHEN label > 0 THEN 1 ELSE 0 END)::BIGINT AS pos, sum(CASE WHEN label > 0 THEN 0 ELSE 1 END)::BIGINT AS neg
    FROM scored GROUP BY 1),
  cum AS (SELECT *, sum(pos) OVER (ORDER BY score DESC)::BIGINT AS tp, sum(neg) OVER (ORDER BY score DESC)::BIGINT AS fp FROM st)"""
_WORDS = """regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"""
_PROMPT_BEFORE, _PROMPT_AFTER = (p.replace("'", "''") for p in c.TAG_PROMPT.split("{text}"))
_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
_LATEST = f"stats AS ({_ITEM_STATS}), latest AS (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY parent_asin ORDER BY sec DESC) = 1)"
_Z = "CASE WHEN stddev_pop(coalesce({s}, 0)) OVER () > 0 THEN (coalesce({s}, 0) - avg(coalesce({s}, 0)) OVER ()) / stddev_pop(coalesce({s}, 0)) OVER () ELSE coalesce({s}, 0) - avg(coalesce({s}, 0)) OVER () END"
_PRICE = "coalesce(try_cast(nullif(regexp_extract(price, '\\b((?:\\d+\\.\\d*)|(?:\\d+))\\b', 1), '') AS DOUBLE), 0)"

ORACLE = {
    "price_scaled": f"""WITH {ITEMS_SQL}, p AS (SELECT parent_asin, price, {_PRICE} AS v FROM items)
SELECT parent_asin, price, CASE WHEN max(v) OVER () > min(v) OVER () THEN (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) ELSE 0 END AS price_scaled
FROM p""",
    "onehot_category": f"""WITH {ITEMS_SQL} SELECT parent_asin, dense_rank() OVER (ORDER BY main_category) - 1 AS slot,
  (SELECT count(DISTINCT main_category) FROM items) AS n_slots FROM items""",
    "category_counts": f"""WITH {ITEMS_SQL}, tok AS (SELECT parent_asin, lower(unnest(categories)) AS token FROM items),
  n AS (SELECT parent_asin, token, count(*) AS n FROM tok GROUP BY ALL)
SELECT parent_asin, token, dense_rank() OVER (ORDER BY token) - 1 AS slot, n FROM n""",
    "rating_stats_scaled": f"WITH {INTERACTIONS_SQL}, {_LATEST} SELECT parent_asin, "
    + ", ".join(f"round({_Z.format(s=s)}, 5) AS {s}" for s in STATS) + " FROM latest",
    "item_vectors": f"""WITH {INTERACTIONS_SQL}, {ITEMS_SQL}, {_LATEST},
  rows AS (SELECT items.*, latest.* EXCLUDE (parent_asin) FROM items JOIN latest USING (parent_asin)),
  tok AS (SELECT parent_asin, lower(unnest(categories)) AS token FROM rows),
  tn AS (SELECT parent_asin, token, count(*)::DOUBLE AS n FROM tok GROUP BY ALL),
  total AS (SELECT count(*)::DOUBLE AS total FROM rows),
  tv AS (SELECT token, sum(n * n) / any_value(total) - power(sum(n) / any_value(total), 2) AS var FROM tn, total GROUP BY 1),
  cats AS (SELECT parent_asin, sum(n * n / CASE WHEN var > 1e-12 THEN var ELSE 1 END) AS q FROM tn JOIN tv USING (token) GROUP BY 1),
  cv AS (SELECT main_category, count(*) / any_value(total) * (1 - count(*) / any_value(total)) AS var FROM rows, total GROUP BY 1),
  price AS (SELECT parent_asin, {_PRICE} AS p FROM rows),
  scaled AS (SELECT parent_asin, (p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER ()) AS p FROM price),
  z AS (SELECT parent_asin, {" + ".join("CASE WHEN stddev_pop(coalesce(" + s + ", 0)) OVER () > 0 THEN power(" + _Z.format(s=s) + ", 2) ELSE 0 END" for s in STATS)} AS q FROM rows)
SELECT rows.parent_asin, ((SELECT count(*) FROM cv) + (SELECT count(*) FROM tv) + 1 + {len(STATS)})::INTEGER AS size,
  round(coalesce(cats.q, 0) + 1 / CASE WHEN cv.var > 1e-12 THEN cv.var ELSE 1 END + power(scaled.p / (SELECT stddev_pop(p) FROM scaled), 2) + z.q, 6) AS squared
FROM rows JOIN cv USING (main_category) JOIN scaled USING (parent_asin) JOIN z USING (parent_asin) LEFT JOIN cats USING (parent_asin)""",
    "tfidf_terms": f"""WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
  t AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
  vocab AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY 1 HAVING count(*) >= 5 ORDER BY total DESC, term LIMIT 1000),
  wt AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1) AS x FROM tf JOIN vocab USING (term))
SELECT doc_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 5) AS weight FROM wt""",
    "category_lines": f"WITH {ITEMS_SQL} SELECT parent_asin, array_to_string(categories, chr(10)) AS lines FROM items",
    "tags_top5": f"""SELECT doc_id, array_to_string(list_slice(list_transform(string_split(trim(text, {_WS}), ','), lambda t: trim(t, {_WS})), 1, 5), ', ') AS tags
FROM documents""",
    "prompt_text": f"SELECT doc_id, '{_PROMPT_BEFORE}' || coalesce(text, '') || '{_PROMPT_AFTER}' AS prompt FROM documents",
    "fixed_vectors": """SELECT vec_id, size, slot::INTEGER AS slot, coalesce(embedding[slot + 1]::DOUBLE, 0) AS value
FROM (SELECT *, unnest(range(size)) AS slot FROM embeddings, (VALUES (384), (10)) s(size))""",
    "item_tag_vectors": """SELECT p_partkey AS parent_asin, slot::INTEGER AS slot, coalesce(embedding[slot + 1]::DOUBLE, 0) AS value
FROM (SELECT p_partkey, unnest(range(384)) AS slot FROM part) LEFT JOIN embeddings ON vec_id = p_partkey""",
    "parsed_numbers": """SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k, 0.0::DOUBLE AS not_a_number,
  '' AS none, try_cast(nullif(regexp_extract(props, '\\b((?:\\d+\\.\\d*)|(?:\\d+))\\b', 1), '') AS DOUBLE) AS first_number,
  strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events""",
    "roc_auc": f"""WITH {_SCORED} SELECT round(1 - sum(pos::DOUBLE * fp - pos * neg / 2) / (sum(pos)::DOUBLE * sum(neg)), 9) AS roc_auc FROM cum""",
    "average_precision": f"WITH {_SCORED} SELECT round(sum(pos * (tp / (tp + fp))) / sum(pos), 9) AS average_precision FROM cum",
    "pr_table": f"""WITH {_SCORED}, n AS (SELECT max(tp + fp) AS n, max(tp) AS p FROM cum),
  goal AS (SELECT s::INTEGER AS top_perc, greatest(n * s // 100, 1) AS g, p FROM n, range(5, 101, 5) r(s))
SELECT top_perc, tp + fp AS count, score AS prob, tp, fp, tp / (tp + fp) AS precision, tp / p AS recall
FROM goal JOIN cum ON g > tp + fp - pos - neg AND g <= tp + fp""",
    "weighted_logloss": f"""WITH {_SCORED}, w AS (SELECT *, least(greatest(score, 1e-7), 1 - 1e-7) AS q,
    CASE WHEN label > 0 THEN (SELECT sum(neg) / sum(pos) FROM st) ELSE 1 END AS weight FROM scored)
SELECT round(avg(-weight * CASE WHEN label > 0 THEN ln(q) ELSE ln(1 - q) END), 8) AS logloss, count(*) AS n_rows FROM w""",
    "ranking_metrics": f"""WITH {INTERACTIONS_SQL}, pairs AS (SELECT DISTINCT user_id, parent_asin FROM interactions),
  recs AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_SHARE.format(keys="user_id, parent_asin, 3")} DESC, parent_asin) AS rk
    FROM pairs QUALIFY rk <= {TOP}),
  best AS (SELECT user_id, parent_asin, max(rating) AS rating, max(sec) AS sec FROM interactions WHERE ts >= TIMESTAMP '{LABELS_FROM}' GROUP BY ALL),
  labels2 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, sec DESC, parent_asin) AS ik FROM best),
  m AS (SELECT user_id, parent_asin, coalesce(rating, 0) AS rating, coalesce(rk, {TOP} + 1) AS rk, ik
    FROM recs FULL JOIN labels2 USING (user_id, parent_asin)),
  u AS (SELECT user_id, count(*) FILTER (rating > 0) AS rel, count(*) FILTER (rating > 0 AND rk <= {K}) AS h,
      count(*) FILTER (rating > 0 AND rk <= {TOP}) AS ht,
      coalesce(sum(rating / log2(rk + 1)) FILTER (rating > 0 AND rk <= {K}), 0) AS dcg,
      coalesce(sum(rating / log2(ik + 1)) FILTER (rating > 0 AND ik <= {K}), 0) AS idcg FROM m GROUP BY 1),
  shown AS (SELECT parent_asin, count(*) AS n FROM m WHERE rk <= {K} GROUP BY 1),
  nu AS (SELECT count(DISTINCT user_id) AS n FROM m WHERE rk <= {K})
SELECT count(*) AS n_users, round(avg(dcg / idcg), 9) AS ndcg, round(avg(h / {K}), 9) AS precision, round(avg(ht / rel), 9) AS recall,
  round(avg(CASE WHEN h > 0 THEN 2 * (h / {K}) * (h / rel) / (h / {K} + h / rel) ELSE 0 END), 9) AS fbeta,
  (SELECT round(1 - sum(shown.n * (shown.n - 1) / 2) / (any_value(nu.n) * (any_value(nu.n) - 1) / 2 * {K}), 9) FROM shown, nu) AS personalization
FROM u WHERE rel > 0""",
    "label_ranks": f"""WITH {INTERACTIONS_SQL}, b AS (SELECT user_id, parent_asin, max(rating) AS rating, max(sec) AS sec FROM interactions GROUP BY ALL)
SELECT user_id, parent_asin, rating, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, sec DESC, parent_asin)::INTEGER AS rating_rank FROM b""",
    "metric_diff": """WITH m AS (SELECT 'val_' || event_type AS metric, max(value) FILTER (ts < TIMESTAMP '2024-01-16') AS curr,
    max(value) FILTER (ts >= TIMESTAMP '2024-01-16') AS new FROM events GROUP BY 1)
SELECT metric, curr, new, new - curr AS diff, (new - curr) / curr AS diff_perc FROM m WHERE curr IS NOT NULL AND new IS NOT NULL""",
    "metric_log_summary": """SELECT event_type AS tag, count(*) AS steps, avg(v) AS mean, min(v) AS min, max(v) AS max,
  arg_min(v, event_id) AS first, arg_max(v, event_id) AS last FROM (SELECT *, round(value * 100) AS v FROM events) GROUP BY 1""",
    "final_gap": """WITH l AS (SELECT arg_max(round(value * 100), event_id) FILTER (event_type = 'click') AS train_last,
  arg_max(round(value * 100), event_id) FILTER (event_type = 'purchase') AS eval_last FROM events)
SELECT train_last, eval_last, train_last - eval_last AS gap FROM l""",
    "promotion_candidates": """WITH r AS (SELECT o_orderpriority AS model, o_custkey AS run, max(o_totalprice) / 500000 AS val_roc_auc,
  min(o_totalprice) / 500000 AS roc_auc FROM orders GROUP BY ALL),
  b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY model ORDER BY val_roc_auc DESC, run DESC) = 1)
SELECT model, run, roc_auc, val_roc_auc FROM b WHERE roc_auc >= 0.5""",
    "undeployed_versions": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
}
