"""Queries over activity sampling, splits, id maps, negatives and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import replace_padding
from tidemark.operators import keys as k
from tidemark.operators import negatives as neg
from tidemark.operators import sampling as s
from tidemark.operators import sequences as q
from tidemark.operators import temporal as t
from tidemark.operators.ordering import row_numbers
from tidemark.session import materialize
from tidemark.plans.tables import (
    DISTINCT_SQL,
    INTERACTIONS_SQL,
    ITEMS_SQL,
    distinct_interactions,
    interactions,
    items,
    table,
)

from tidemark.plans.temporal import _RECENT

# Thresholds that need several rounds on the given tables without emptying them.
MIN_USER = MIN_ITEM = 22
TRAIN_UNTIL = "1995-06-01"
TIES = ["user_id", "parent_asin", "rating"]


def _seconds(df, *columns):
    return df.select(*columns, F.unix_seconds("timestamp").alias("sec"))


def _core(spark, sf_dir):
    return s.k_core(interactions(spark, sf_dir), min_user=MIN_USER, min_item=MIN_ITEM).rows


def kcore_sample(spark, sf_dir):
    return _seconds(_core(spark, sf_dir), "user_id", "parent_asin", "rating")


def low_activity_users(spark, sf_dir):
    """Users under the threshold, with their interactions."""
    counts = interactions(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") < MIN_USER)


def _split(spark, sf_dir, ratio=0.8):
    return s.chronological_split(interactions(spark, sf_dir), "timestamp", TIES, ratio)


def time_split(spark, sf_dir):
    train, val = _split(spark, sf_dir)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return _seconds(both, "user_id", "parent_asin", "rating", "split")


def time_split_nulls(spark, sf_dir):
    """A split of rows of which some have no time: those come first."""
    rows = interactions(spark, sf_dir).withColumn("timestamp", F.when(F.col("parent_asin") % 9 != 0, F.col("timestamp")))
    train, val = s.chronological_split(rows, "timestamp", TIES, 0.6)
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    return _seconds(both, "user_id", "parent_asin", "rating", "split")


def warm_validation(spark, sf_dir):
    train, val = _split(spark, sf_dir)
    return _seconds(s.warm_rows(val, train), "user_id", "parent_asin", "rating")


def cold_start_users(spark, sf_dir):
    """Customers the oldest twentieth of interactions does not know."""
    train, _ = _split(spark, sf_dir, 0.05)
    everyone = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return s.cold_start(everyone, train, "user_id")


def cold_start_items(spark, sf_dir):
    train, _ = _split(spark, sf_dir, 0.05)
    return s.cold_start(items(spark, sf_dir), train, "parent_asin")


def cutoff_split(spark, sf_dir):
    """Everything split one second after the newest row of the older orders."""
    rows = interactions(spark, sf_dir)
    train = rows.filter(F.col("timestamp") < F.lit("2000-01-01").cast("timestamp"))
    before, after = s.cutoff_split(rows, train, "timestamp")
    both = before.withColumn("split", F.lit("train")).unionByName(after.withColumn("split", F.lit("val")))
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.unix_seconds("timestamp")).alias("newest")
    )


def hashed_holdout(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return s.hashed_holdout(docs, ["doc_id"])


def metadata_semi_join(spark, sf_dir):
    """Item metadata restricted to items that survive sampling."""
    kept = _core(spark, sf_dir).select("parent_asin").distinct()
    return items(spark, sf_dir).join(kept, "parent_asin", "left_semi").select("parent_asin", "main_category", "price")


def _named(spark, sf_dir):
    """Training rows (before 1995-06) with text ids."""
    rows = interactions(spark, sf_dir).filter(F.col("timestamp") < F.lit(TRAIN_UNTIL).cast("timestamp"))
    return rows.select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("user_id"))


def id_map(spark, sf_dir):
    return k.fit_id_map(_named(spark, sf_dir), "user_id", "user_indice")


def id_map_lookup(spark, sf_dir):
    """Every customer's index in the training map; others get the map's size."""
    known = id_map(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("user_id"), "c_custkey"
    )
    return k.to_index(customers, known, "user_id", "user_indice")


def id_map_reverse(spark, sf_dir):
    """Indices 0..customers-1 back to ids, 'unknown_user' beyond the map."""
    known = id_map(spark, sf_dir)
    wanted = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 3).alias("user_indice"))
    return k.to_key(wanted, known, "user_id", "user_indice", k.UNKNOWN_USER).select("user_indice", "user_id")


def indexed_history(spark, sf_dir):
    """Padded history of dense item indices, padding replaced by the unknown index."""
    rows = distinct_interactions(spark, sf_dir)
    items_map = k.fit_id_map(rows, "parent_asin", "item_indice")
    mapped = k.to_index(rows, items_map, "parent_asin", "item_indice")
    sequences = t.history_sequences(mapped, n=10)
    size = items_map.agg(F.count(F.lit(1))).scalar()
    filled = sequences.withColumn("_n", size)
    return filled.select(
        "user_id", "item_indice", F.unix_seconds("timestamp").alias("sec"),
        F.array_join(replace_padding("item_sequence", F.col("_n")), ",").alias("item_sequence"),
    )


def item_popularity(spark, sf_dir):
    """Interactions of each item and its share of all."""
    rows = interactions(spark, sf_dir)
    weights = neg.popularity(rows, "parent_asin")
    total = weights.agg(F.sum("weight")).scalar()
    return weights.select("parent_asin", "weight", (F.col("weight") / total).alias("probability"))


def sequence_frequency(spark, sf_dir):
    return q.sequence_frequency(interactions(spark, sf_dir))


def user_sequences(spark, sf_dir):
    return q.user_sequences(distinct_interactions(spark, sf_dir), max_rows=60)


def skipgram_pairs(spark, sf_dir):
    pairs = q.skipgram_pairs(distinct_interactions(spark, sf_dir), window=2)
    return pairs.select(
        F.col("user").alias("user_id"), F.unix_seconds("at").alias("sec"), "item", "step", "target", "context"
    )


def seen_together(spark, sf_dir):
    """For each item and the next by id: do they share a user."""
    held = q.holders(interactions(spark, sf_dir))
    degree = held.groupBy("_item").agg(F.count(F.lit(1)).alias("weight"))
    pairs = items(spark, sf_dir).select("parent_asin", (F.col("parent_asin") + 1).alias("candidate"))
    return q.seen_together(pairs, held, degree, "parent_asin", "candidate", per_bucket=16)


RATIO = 2


def _positives(spark, sf_dir):
    return materialize(distinct_interactions(spark, sf_dir)).select(
        F.col("user_id").alias("user_indice"), F.col("parent_asin").alias("item_indice"), "timestamp", "rating"
    )


def negative_samples(spark, sf_dir):
    """Two unseen items per positive row, by hashed draws over popularity."""
    return _sampled(_positives(spark, sf_dir))


def _sampled(rows):
    keyed = rows.select(
        "user_indice", F.col("item_indice").alias("source"), F.unix_seconds("timestamp").alias("sec")
    )
    seen = rows.select("user_indice", "item_indice").distinct()
    return neg.sample_negatives(
        keyed, neg.popularity(rows, "item_indice"), neg.listed(seen, "user_indice", "item_indice"),
        "user_indice", "item_indice", ["user_indice", "source", "sec"], RATIO,
    ).withColumn("draw_order", F.col("draw_order").cast("bigint"))


def negative_samples_violations(spark, sf_dir):
    """Negatives that are positives of the user, or short rows: must be empty."""
    rows = _positives(spark, sf_dir)
    picked = _sampled(rows)
    seen = rows.select("user_indice", "item_indice").distinct()
    wrong = picked.join(seen, ["user_indice", "item_indice"], "left_semi").select("user_indice", "source", "sec")
    key = ["user_indice", "source", "sec"]
    enough = picked.groupBy(*key).agg(F.countDistinct("item_indice").alias("n")).filter(F.col("n") == RATIO)
    all_rows = rows.select("user_indice", F.col("item_indice").alias("source"), F.unix_seconds("timestamp").alias("sec"))
    return wrong.unionByName(all_rows.join(enough, key, "left_anti"))


def skipgram_dataset(spark, sf_dir):
    """Labelled pairs: counts per user, so that the whole sample is covered."""
    data = q.skipgram_dataset(materialize(distinct_interactions(spark, sf_dir)))
    return data.groupBy(F.col("user").alias("user_id")).agg(
        F.sum(F.col("label").cast("bigint")).alias("n_positive"),
        F.sum((1 - F.col("label")).cast("bigint")).alias("n_negative"),
    )


def skipgram_negatives(spark, sf_dir):
    """Two never co-occurring items per skip-gram pair."""
    rows = materialize(distinct_interactions(spark, sf_dir))
    picked = q.skipgram_negatives(rows, materialize(q.skipgram_pairs(rows)))
    return picked.select("user", "item", "step", "target", F.col("parent_asin").alias("negative"), F.col("draw_order").cast("bigint").alias("draw_order"))


def mapped_sequence_ids(spark, sf_dir):
    """Recent-item texts turned into padded indices of the training items."""
    rows = interactions(spark, sf_dir)
    known = k.fit_id_map(rows.filter(F.col("timestamp") < F.lit(TRAIN_UNTIL).cast("timestamp")), "parent_asin", "item_indice")
    lists = t.recent_items(rows).select("user_id", "timestamp", "user_rating_list_10_recent_asin")
    mapped = q.mapped_sequences(
        lists, ["user_id", "timestamp"], "user_rating_list_10_recent_asin", known, "parent_asin", "item_indice"
    )
    return mapped.select("user_id", F.unix_seconds("timestamp").alias("sec"), F.array_join("item_sequence", ",").alias("item_sequence"))


def activity_overview(spark, sf_dir):
    """One pass over the interactions; the approximate counts are reported as close or not."""
    rows = interactions(spark, sf_dir)
    exact = rows.agg(F.struct(F.countDistinct("user_id").alias("u"), F.countDistinct("parent_asin").alias("i"))).scalar()
    close = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.col(b) * 0.1
    out = s.overview(rows).withColumn("_e", exact)
    return out.select("n_rows", F.unix_seconds("newest").alias("newest"), close("users", "_e.u").alias("users_close"), close("items", "_e.i").alias("items_close"))


def seeded_order(spark, sf_dir):
    """Position of every document in the seeded shuffle."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = row_numbers(docs.withColumn("_bits", s.hash_bits(["doc_id"], 5)), [F.col("_bits"), F.col("doc_id")], "position")
    return placed.select("doc_id", "position")


def validated_join(spark, sf_dir):
    """Interactions per main category through a join that insists on unique item keys."""
    joined = k.many_to_one_join(interactions(spark, sf_dir), items(spark, sf_dir), ["parent_asin"])
    return joined.groupBy("main_category").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("rating").alias("ratings"))


QUERIES = {
    f.__name__: f
    for f in (
        kcore_sample, low_activity_users, time_split, time_split_nulls, warm_validation, cold_start_users,
        cold_start_items, cutoff_split, hashed_holdout, metadata_semi_join, id_map, id_map_lookup,
        id_map_reverse, indexed_history, item_popularity, sequence_frequency, user_sequences,
        skipgram_pairs, seen_together, negative_samples, negative_samples_violations,
        skipgram_negatives, skipgram_dataset, mapped_sequence_ids, activity_overview, seeded_order,
        validated_join,
    )
}

SQL_ROUNDS = 9


def _core_sql() -> str:
    """The fixpoint as unrolled rounds; more rounds than needed change nothing."""
    parts, source = [], "interactions"
    for i in range(SQL_ROUNDS):
        parts.append(
            f"""u{i} AS MATERIALIZED (SELECT * FROM {source} WHERE user_id IN
    (SELECT user_id FROM {source} GROUP BY 1 HAVING count(*) >= {MIN_USER})),
  i{i} AS MATERIALIZED (SELECT * FROM u{i} WHERE parent_asin IN
    (SELECT parent_asin FROM u{i} GROUP BY 1 HAVING count(*) >= {MIN_ITEM}))"""
        )
        source = f"i{i}"
    return f"{INTERACTIONS_SQL}, " + ",\n  ".join(parts) + f", core AS (SELECT * FROM {source})"


_SPLIT = INTERACTIONS_SQL + """, numbered AS (
  SELECT *, row_number() OVER (ORDER BY sec, user_id, parent_asin, rating) AS rn, count(*) OVER () AS total FROM interactions),
  split AS (SELECT *, CASE WHEN rn <= floor(total * 0.8) THEN 'train' ELSE 'val' END AS split FROM numbered)"""
_MAP = INTERACTIONS_SQL + f""", named AS (SELECT DISTINCT 'U' || user_id AS user_id FROM interactions WHERE ts < TIMESTAMP '{TRAIN_UNTIL}'),
  map AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_indice FROM named)"""
_BITS = "('0x' || substr(md5({text}), 1, 15))::BIGINT"
# The first two rounds of draws: ratio, then 8.
_DRAWS = RATIO + 8
_NEG = DISTINCT_SQL + f""", pop AS (SELECT parent_asin, count(*)::BIGINT AS weight FROM uniq GROUP BY 1),
  ranges AS (SELECT parent_asin, sum(weight) OVER (ORDER BY parent_asin)::BIGINT AS hi, weight FROM pop),
  draws AS (SELECT user_id, parent_asin AS source, sec, d,
      {_BITS.format(text="concat_ws('|', user_id, parent_asin, sec, d, 42)")} % (SELECT sum(weight)::BIGINT FROM pop) AS at
    FROM uniq, range({_DRAWS}) r(d)),
  hit AS (SELECT draws.*, ranges.parent_asin AS drawn FROM draws ASOF JOIN ranges ON draws.at < ranges.hi),
  fresh AS (SELECT user_id, source, sec, drawn, min(d) AS d FROM hit
    WHERE NOT EXISTS (SELECT 1 FROM uniq u WHERE u.user_id = hit.user_id AND u.parent_asin = hit.drawn) GROUP BY ALL),
  picked AS (SELECT *, row_number() OVER (PARTITION BY user_id, source, sec ORDER BY d) AS draw_order FROM fresh
    QUALIFY draw_order <= {RATIO})"""
_NEAR = """lead(parent_asin, {n}) OVER w AS c{n}, lead(sec, {n}) OVER w AS s{n}"""

ORACLE = {
    "kcore_sample": f"WITH {_core_sql()} SELECT user_id, parent_asin, rating, sec FROM core",
    "low_activity_users": f"""WITH {INTERACTIONS_SQL} SELECT user_id, count(*) AS n_rows FROM interactions
GROUP BY 1 HAVING count(*) < {MIN_USER}""",
    "time_split": f"WITH {_SPLIT} SELECT user_id, parent_asin, rating, sec, split FROM split",
    "time_split_nulls": f"""WITH {INTERACTIONS_SQL}, n AS (SELECT user_id, parent_asin, rating, CASE WHEN parent_asin % 9 <> 0 THEN sec END AS sec FROM interactions),
  numbered AS (SELECT *, row_number() OVER (ORDER BY sec NULLS FIRST, user_id, parent_asin, rating) AS rn, count(*) OVER () AS total FROM n)
SELECT user_id, parent_asin, rating, sec, CASE WHEN rn <= floor(total * 0.6) THEN 'train' ELSE 'val' END AS split FROM numbered""",
    "warm_validation": f"""WITH {_SPLIT} SELECT user_id, parent_asin, rating, sec FROM split WHERE split = 'val'
AND user_id IN (SELECT user_id FROM split WHERE split = 'train')
AND parent_asin IN (SELECT parent_asin FROM split WHERE split = 'train')""",
    "cold_start_users": f"""WITH {_SPLIT.replace("0.8", "0.05")} SELECT c_custkey AS user_id FROM customer
EXCEPT SELECT user_id FROM split WHERE split = 'train'""",
    "cold_start_items": f"""WITH {_SPLIT.replace("0.8", "0.05")} SELECT p_partkey AS parent_asin FROM part
EXCEPT SELECT parent_asin FROM split WHERE split = 'train'""",
    "cutoff_split": f"""WITH {INTERACTIONS_SQL}, cut AS (SELECT max(sec) + 1 AS c FROM interactions WHERE ts < TIMESTAMP '2000-01-01')
SELECT CASE WHEN sec < c THEN 'train' ELSE 'val' END AS split, count(*) AS n_rows, max(sec) AS newest
FROM interactions, cut GROUP BY 1""",
    "hashed_holdout": f"""SELECT doc_id, {_BITS.format(text="concat_ws('|', doc_id, 42)")} / 1152921504606846976.0::DOUBLE < 0.1 AS is_holdout
FROM documents""",
    "metadata_semi_join": f"""WITH {_core_sql()}, {ITEMS_SQL} SELECT parent_asin, main_category, price FROM items
WHERE parent_asin IN (SELECT parent_asin FROM core)""",
    "id_map": f"WITH {_MAP} SELECT user_id, user_indice FROM map",
    "id_map_lookup": f"""WITH {_MAP} SELECT 'U' || c_custkey AS user_id, c_custkey,
  coalesce(user_indice, (SELECT count(*) FROM map)) AS user_indice
FROM customer LEFT JOIN map ON map.user_id = 'U' || c_custkey""",
    "id_map_reverse": f"""WITH {_MAP} SELECT c_custkey + 3 AS user_indice, coalesce(map.user_id, 'unknown_user') AS user_id
FROM customer LEFT JOIN map ON map.user_indice = c_custkey + 3""",
    "indexed_history": f"""WITH {DISTINCT_SQL}, imap AS (SELECT parent_asin, row_number() OVER (ORDER BY parent_asin) - 1 AS item_indice
    FROM (SELECT DISTINCT parent_asin FROM uniq)),
  rows AS (SELECT user_id, sec, item_indice FROM uniq JOIN imap USING (parent_asin)),
  h AS (SELECT user_id, sec, item_indice, first_value(l) OVER (PARTITION BY user_id, sec ORDER BY item_indice) AS l
  FROM (SELECT *, list(item_indice) OVER (PARTITION BY user_id ORDER BY sec, item_indice
          ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l FROM rows))
SELECT user_id, item_indice, sec, array_to_string(list_concat(
  list_resize([]::BIGINT[], 10 - coalesce(len(l), 0), (SELECT count(*) FROM imap)), coalesce(l, [])), ',') AS item_sequence
FROM h""",
    "item_popularity": f"""WITH {INTERACTIONS_SQL} SELECT parent_asin, count(*) AS weight,
  count(*)::DOUBLE / (SELECT count(*) FROM interactions) AS probability FROM interactions GROUP BY 1""",
    "sequence_frequency": f"""WITH {INTERACTIONS_SQL} SELECT parent_asin, count(DISTINCT user_id) AS weight
FROM interactions GROUP BY 1""",
    "user_sequences": f"""WITH {DISTINCT_SQL} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY sec, parent_asin) AS position, parent_asin
FROM uniq QUALIFY count(*) OVER (PARTITION BY user_id) > 1""",
    "skipgram_pairs": f"""WITH {DISTINCT_SQL}, near AS (
  SELECT user_id, sec, parent_asin, {_NEAR.format(n=1)}, {_NEAR.format(n=2)}
  FROM uniq WINDOW w AS (PARTITION BY user_id ORDER BY sec, parent_asin)),
  p AS (SELECT user_id, s1 AS sec, c1 AS item, 1 AS d, parent_asin AS o FROM near WHERE c1 IS NOT NULL
    UNION ALL SELECT user_id, s2, c2, 2, parent_asin FROM near WHERE c2 IS NOT NULL)
SELECT user_id, sec, item, (-d)::INTEGER AS step, item AS target, o AS context FROM p
UNION ALL SELECT user_id, sec, item, d, o, item FROM p""",
    "seen_together": f"""WITH {INTERACTIONS_SQL}, held AS (SELECT DISTINCT user_id, parent_asin FROM interactions)
SELECT DISTINCT a.parent_asin, b.parent_asin AS candidate FROM held a JOIN held b
ON a.user_id = b.user_id AND b.parent_asin = a.parent_asin + 1
WHERE a.parent_asin IN (SELECT p_partkey FROM part)""",
    "negative_samples": f"""WITH {_NEG} SELECT user_id AS user_indice, source, sec, drawn AS item_indice, draw_order FROM picked""",
    "negative_samples_violations": f"""WITH {DISTINCT_SQL} SELECT user_id AS user_indice, parent_asin AS source, sec FROM uniq WHERE false""",
    "mapped_sequence_ids": f"""WITH {INTERACTIONS_SQL}, imap AS (SELECT parent_asin::VARCHAR AS item, row_number() OVER (ORDER BY parent_asin) - 1 AS i
    FROM (SELECT DISTINCT parent_asin FROM interactions WHERE ts < TIMESTAMP '{TRAIN_UNTIL}')),
  lists AS ({_RECENT.format(t="sec", src="interactions")}),
  e AS (SELECT user_id, sec, unnest(string_split(user_rating_list_10_recent_asin, ',')) AS item,
    generate_subscripts(string_split(user_rating_list_10_recent_asin, ','), 1) AS p FROM lists WHERE user_rating_list_10_recent_asin IS NOT NULL),
  m AS (SELECT user_id, sec, list(coalesce(i, (SELECT count(*) FROM imap)) ORDER BY p) AS l FROM e LEFT JOIN imap USING (item) GROUP BY ALL)
SELECT user_id, sec, array_to_string(list_concat(list_resize([]::BIGINT[], 10 - coalesce(len(l), 0), -1), coalesce(l, [])), ',') AS item_sequence
FROM lists LEFT JOIN m USING (user_id, sec)""",
    "activity_overview": f"""WITH {INTERACTIONS_SQL} SELECT count(*) AS n_rows, max(sec) AS newest, true AS users_close, true AS items_close FROM interactions""",
    "seeded_order": f"""SELECT doc_id, row_number() OVER (ORDER BY {_BITS.format(text="concat_ws('|', doc_id, 5)")}, doc_id) AS position FROM documents""",
    "validated_join": f"""WITH {INTERACTIONS_SQL} SELECT p_type AS main_category, count(*) AS n_rows, sum(rating) AS ratings
FROM interactions LEFT JOIN part ON p_partkey = parent_asin GROUP BY 1""",
    "skipgram_negatives": f"""WITH {DISTINCT_SQL}, held AS (SELECT DISTINCT user_id, parent_asin FROM uniq),
  ranges AS (SELECT parent_asin, sum(round(pow(n, 0.75) * 1000000)::BIGINT) OVER (ORDER BY parent_asin)::BIGINT AS hi
    FROM (SELECT parent_asin, count(*) AS n FROM held GROUP BY 1)),
  near AS (SELECT user_id, parent_asin, lead(parent_asin) OVER w AS c1, lead(ts) OVER w AS s1 FROM uniq WINDOW w AS (PARTITION BY user_id ORDER BY sec, parent_asin)),
  p AS (SELECT user_id, s1 AS tm, c1 AS item, -1 AS step, c1 AS target FROM near WHERE c1 IS NOT NULL
    UNION ALL SELECT user_id, s1, c1, 1, parent_asin FROM near WHERE c1 IS NOT NULL),
  draws AS (SELECT p.*, d, {_BITS.format(text="concat_ws('|', user_id, strftime(tm, '%Y-%m-%d %H:%M:%S'), item, step, target, d, 42)")} % (SELECT max(hi) FROM ranges) AS x
    FROM p, range({RATIO + 8 + 64}) r(d)),
  hit AS (SELECT draws.*, ranges.parent_asin AS drawn FROM draws ASOF JOIN ranges ON draws.x < ranges.hi),
  together AS (SELECT DISTINCT a.parent_asin AS target, b.parent_asin AS drawn FROM held a JOIN held b USING (user_id)),
  fresh AS (SELECT user_id, tm, item, step, target, drawn, min(d) AS d FROM hit ANTI JOIN together USING (target, drawn) GROUP BY ALL)
SELECT user_id AS user, item, step, target, drawn AS negative, row_number() OVER (PARTITION BY user_id, tm, item, step, target ORDER BY d) AS draw_order
FROM fresh QUALIFY draw_order <= {RATIO}""",
    "skipgram_dataset": f"""WITH {DISTINCT_SQL} SELECT user_id, 2 * (count(*) - 1) AS n_positive, 4 * (count(*) - 1) AS n_negative
FROM uniq GROUP BY 1 HAVING count(*) > 1""",
}
