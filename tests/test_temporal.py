import math
from datetime import datetime, timedelta, timezone
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators import temporal as t
from tidemark.operators.asof import as_of_join
from tidemark.operators.slices import hot_key_grid, with_slices
from tidemark.functions.columns import recency_bucket, recency_buckets

DAY = 86_400


def rows_of(df):
    return df.select("user_id", "parent_asin", "rating", F.unix_seconds("timestamp")).collect()


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_rolling_stats_match_brute_force(log, max_rows):
    rows = set(map(tuple, rows_of(log)))
    measures = [t.Rolling("c", 7 * DAY, "count"), t.Rolling("m", 7 * DAY, "mean"), t.Rolling("now", 3 * DAY, "count_now")]
    got = t.rolling_stats(log, "user_id", "timestamp", "rating", measures, max_rows)
    seen = {}
    for r in got.select("user_id", F.unix_seconds("timestamp").alias("s"), "c", "m", "now").collect():
        assert (r.user_id, r.s) not in seen
        seen[(r.user_id, r.s)] = (r.c, r.m, r.now)
    assert len(seen) == len({(u, s) for u, _, _, s in rows})
    for (user, sec), (c, m, now) in seen.items():
        week = [x for u, _, x, s in rows if u == user and sec - 7 * DAY <= s <= sec - 1]
        known = [x for x in week if x is not None]
        assert c == len(week)
        assert m == pytest.approx(sum(known) / len(known)) if known else m is None
        assert now == sum(1 for u, _, _, s in rows if u == user and sec - 3 * DAY <= s <= sec)


def test_window_edges_are_inclusive_to_the_second(spark):
    base = 1_700_000_000
    secs = [base - 7 * DAY - 1, base - 7 * DAY, base - 1, base, base]
    rows = [("u", f"i{n}", 1.0, s) for n, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "u string, i string, r double, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    got = t.rolling_stats(df, "u", "ts", "r", [t.Rolling("c", 7 * DAY, "count"), t.Rolling("n", 7 * DAY, "count_now")])
    last = got.filter(F.unix_seconds("ts") == base).first()
    assert (last.c, last.n) == (2, 4)


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_recent_items_match_brute_force(log, max_rows):
    got = {
        (r.user_id, r.s): (r.user_rating_list_10_recent_asin, r.user_rating_list_10_recent_asin_timestamp)
        for r in t.recent_items(log, max_rows=max_rows).withColumn("s", F.unix_seconds("timestamp")).collect()
    }
    rows = sorted(set(map(tuple, rows_of(log))), key=lambda r: (r[3], r[1], r[2] is not None, r[2] or 0))
    want = {}
    for user in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == user]
        for n, row in enumerate(mine):
            before = mine[max(0, n - 10) : n]
            size, items, times = len(before), ",".join(r[1] for r in before), ",".join(str(r[3]) for r in before)
            key = (user, row[3])
            if key not in want or size > want[key][0]:
                want[key] = (size, items or None, times or None)
    assert got == {k: v[1:] for k, v in want.items()}


@pytest.mark.parametrize("max_rows", [10**6, 20])
@pytest.mark.parametrize("n", [3, 10])
def test_history_is_strictly_earlier(log, n, max_rows):
    rows = log.withColumn("item_indice", F.substring("parent_asin", 2, 5).cast("bigint"))
    got = t.history_sequences(rows, n=n, max_rows=max_rows)
    data = [(r.user_id, r.item_indice, r.timestamp) for r in rows.collect()]
    out = got.select("user_id", "timestamp", "item_sequence").collect()
    assert len(out) == len(data)
    for r in out:
        past = [i for _, i in sorted((ts, i) for u, i, ts in data if u == r.user_id and ts < r.timestamp)][-n:]
        assert list(r.item_sequence) == [-1] * (n - len(past)) + past


@pytest.mark.parametrize("max_rows", [10**6, 15])
@pytest.mark.parametrize("ttl", [None, 2 * DAY])
def test_as_of_join_matches_brute_force(spark, log, ttl, max_rows):
    features = log.groupBy("user_id", "timestamp").agg(F.count("*").alias("n")).filter("hash(user_id, timestamp) % 3 = 0")
    queries = log.withColumn("timestamp", F.col("timestamp") + F.expr("interval 1 hour")).unionByName(log)
    known = [(r.user_id, r.timestamp, r.n) for r in features.collect()]
    got = as_of_join(queries, features, "user_id", "timestamp", ["n"], ttl, max_rows=max_rows)
    assert got.count() == queries.count()
    for r in got.collect():
        past = [(ts, n) for u, ts, n in known if u == r.user_id and ts <= r.timestamp]
        if ttl is not None:
            past = [(ts, n) for ts, n in past if r.timestamp - ts <= timedelta(seconds=ttl)]
        assert (r.feature_time, r.n) == (max(past) if past else (None, None))


def test_latest_per_key_and_first_row(log):
    newest = t.latest_per_key(log.groupBy("user_id", "timestamp").agg(F.count("*").alias("n")), "user_id", "timestamp")
    top = {r.user_id: r.t for r in log.groupBy("user_id").agg(F.max("timestamp").alias("t")).collect()}
    assert {r.user_id: r.timestamp for r in newest.collect()} == top


def test_padding_keeps_the_last_entries(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (None,), (list(range(12)),)], "a array<bigint>")
    got = [r.p for r in df.select(t.left_pad(F.col("a"), 10, -1).alias("p")).collect()]
    assert got == [[-1] * 7 + [1, 2, 3], [-1] * 10, [-1] * 10, list(range(2, 12))]


def test_recency_buckets(spark):
    ages = [-5, 0, 599, 600, 3599, 3600, DAY, 7 * DAY, 30 * DAY, 365 * DAY, 3 * 365 * DAY, 5 * 365 * DAY, 10 * 365 * DAY]
    df = spark.createDataFrame([(a,) for a in ages], "age bigint")
    assert [r.b for r in df.select(recency_bucket("age").alias("b")).collect()] == [0, 0, 0, 1, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    seq = spark.createDataFrame([([-1, 100, 1000],)], "s array<bigint>").select(recency_buckets("s", F.lit(1000)).alias("b")).first().b
    assert seq == [-1, 1, 0]


def test_means_are_exact_and_nan_leaves_with_its_window(spark):
    nan, inf = float("nan"), float("inf")
    values = [1e16, 0.1, 0.25, nan, 3.0, inf, -inf, 2.0, None, 4.5]
    rows = spark.createDataFrame([("k", i * 10, v) for i, v in enumerate(values)], "k string, sec bigint, v double")
    stats = t.rolling_stats(rows.selectExpr("k", "timestamp_seconds(sec) as at", "v"), "k", "at", "v", [t.Rolling("m", 10, "mean"), t.Rolling("w", 30, "mean")])
    got = {r["s"] // 10: (r["m"], r["w"]) for r in stats.selectExpr("unix_seconds(at) as s", "m", "w").collect()}
    assert [got[i][0] for i in (1, 2, 3)] == [1e16, 0.1, 0.25]
    assert math.isnan(got[4][0]) and got[5][0] == 3.0 and got[6][0] == inf and got[7][0] == -inf and got[8][0] == 2.0 and got[9][0] is None
    assert got[2][1] == (1e16 + 0.1) / 2 and math.isnan(got[6][1]) and math.isnan(got[8][1]) and got[9][1] == -inf


def exact_mean(values):
    return float(sum(map(Fraction, values)) / len(values))


@pytest.mark.parametrize("max_rows", [10**6, 4])
def test_means_of_values_of_any_size(spark, max_rows):
    values = [1e-10, 3e-10, 1e19, 1e19, 5e-324, 1.7e308, -1.7e308, 2.0**-1040, 0.1, 0.2, -1e19, 1e-10, 0.0, 7.0, 1e300, 2.5]
    rows = spark.createDataFrame([("k", i * 10, v) for i, v in enumerate(values)], "k string, sec bigint, v double")
    spans = {"a": 10, "b": 20, "c": 70}
    stats = t.rolling_stats(
        rows.selectExpr("k", "timestamp_seconds(sec) as at", "v"), "k", "at", "v", [t.Rolling(n, s, "mean") for n, s in spans.items()], max_rows
    )
    got = {r["s"]: r for r in stats.selectExpr("unix_seconds(at) as s", *spans).collect()}
    for i in range(1, len(values)):
        for name, span in spans.items():
            assert got[i * 10][name] == pytest.approx(exact_mean(values[max(0, i - span // 10) : i]), rel=1e-15, abs=0), (i, name)


def burst(spark):
    """A key and the NULL key with nearly all rows in one second, and one row years before."""
    rows = [(k, f"i{n % 37:02d}", float(n % 5), 0 if n == 0 else 10**9 + (n > 380)) for k in ("hot", None) for n in range(400)]
    rows += [("cold", f"i{n}", 1.0, 10**9 + n) for n in range(5)]
    frame = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, sec bigint")
    return frame.selectExpr("user_id", "parent_asin", "rating", "timestamp_seconds(sec) as timestamp")


def test_slices_follow_the_rows(spark):
    rows = burst(spark).distinct().withColumn("at", F.struct(F.unix_seconds("timestamp").alias("s"), "parent_asin", "rating"))
    grid = hot_key_grid(rows, "user_id", "at", 20)
    cut = with_slices(rows, grid, "user_id", "at")
    sizes = {(r.user_id, r._slice): r["count"] for r in cut.groupBy("user_id", "_slice").count().collect()}
    for key in ("hot", None):
        slices = sorted(s for k, s in sizes if k == key)
        assert slices == list(range(len(slices))) and len(slices) > 5
        assert max(sizes[key, s] for s in slices) <= 20
    assert sizes["cold", 0] == 5 and hot_key_grid(rows, "user_id", "at", 1000) is None


def test_bursts_and_null_keys_change_nothing(spark):
    rows = burst(spark)
    for operator in (t.recent_items, t.user_window_stats):
        plain, split = (sorted(map(str, operator(rows, max_rows=m).collect())) for m in (10**6, 20))
        assert plain == split
    numbered = rows.distinct().withColumn("item_indice", F.substring("parent_asin", 2, 3).cast("bigint"))
    plain, split = (sorted(map(str, t.history_sequences(numbered, max_rows=m).collect())) for m in (10**6, 20))
    assert plain == split
    features = rows.groupBy("user_id", "timestamp").agg(F.count("*").alias("n"))
    plain, split = (sorted(map(str, as_of_join(rows, features, "user_id", "timestamp", ["n"], max_rows=m).collect())) for m in (10**6, 20))
    assert plain == split


def test_windows_run_in_tasks_of_bounded_size(spark, monkeypatch):
    from tidemark.operators import slices, temporal
    from tidemark.operators.asof import as_of_join

    monkeypatch.setattr(slices, "TASK_ROWS", 20)
    rows = spark.range(800).selectExpr("id % 400 as user_id", "id % 7 as parent_asin", "1.0D as rating", "timestamp_seconds(id * 1000) as timestamp")
    stats = temporal.user_window_stats(rows)
    made = [stats, temporal.recent_items(rows), as_of_join(rows, stats, "user_id", "timestamp", ["user_rating_cnt_90d"])]
    for out in made:
        tasks = out.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
        assert tasks[0] > 20 and tasks[1] <= 80 and tasks[2] == 800
