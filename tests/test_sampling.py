from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import keys as k
from tidemark.operators import sampling as s
from tidemark.operators.ordering import row_numbers, running_totals


def frame(spark, pairs):
    return spark.createDataFrame([(u, i, n) for n, (u, i) in enumerate(pairs)], "user_id string, parent_asin string, n bigint")


def brute_core(pairs, lo_user, lo_item):
    while True:
        users, left = Counter(u for u, _ in pairs), pairs
        pairs = [(u, i) for u, i in pairs if users[u] >= lo_user]
        items = Counter(i for _, i in pairs)
        pairs = [(u, i) for u, i in pairs if items[i] >= lo_item]
        if pairs == left:
            return pairs


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("uvwxyz")), max_size=40))
def test_k_core_is_the_largest_fixpoint(spark, pairs):
    got = s.k_core(frame(spark, pairs), min_user=2, min_item=3)
    assert sorted((r.user_id, r.parent_asin) for r in got.rows.collect()) == sorted(brute_core(pairs, 2, 3))
    assert got.converged


def test_k_core_cascades_and_may_end_empty(spark):
    pairs = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "y")]
    got = s.k_core(frame(spark, pairs), min_user=2, min_item=3)
    assert got.rows.count() == 0 and got.converged and got.rounds >= 2


def test_k_core_stops_at_the_round_limit(spark):
    chain = [("u%d" % n, "i%d" % n) for n in range(12)] + [("u%d" % n, "i%d" % (n + 1)) for n in range(12)]
    got = s.k_core(frame(spark, chain), min_user=2, min_item=2, max_rounds=2)
    assert got.rounds == 2 and not got.converged


def test_k_core_keeps_rows_with_null_keys(spark):
    pairs = [(None, "x"), ("a", "x"), ("a", "x"), ("b", None)]
    got = s.k_core(frame(spark, pairs), min_user=2, min_item=2).rows
    assert sorted(map(tuple, got.select("user_id", "parent_asin").collect()), key=str) == sorted([("a", "x"), ("a", "x"), (None, "x")], key=str)


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.5, 0.8, 1.0])
def test_split_is_chronological_and_exact(log, ratio):
    train, val = s.chronological_split(log, "timestamp", ["user_id", "parent_asin", "rating"], ratio)
    rows = sorted(map(tuple, log.select("timestamp", "user_id", "parent_asin", F.coalesce("rating", F.lit(-1.0))).collect()))
    got = sorted(map(tuple, train.select("timestamp", "user_id", "parent_asin", F.coalesce("rating", F.lit(-1.0))).collect()))
    assert got == rows[: int(len(rows) * ratio)]
    assert val.count() == len(rows) - len(got)


def test_split_inside_one_tie_group(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("user_id"), F.timestamp_seconds(F.lit(5)).alias("timestamp"))
    train, val = s.chronological_split(df, "timestamp", ["user_id"], 0.8)
    assert (train.count(), val.count()) == (80, 20)
    assert max(r.user_id for r in train.collect()) < min(r.user_id for r in val.collect())


def test_warm_and_cold(spark):
    train = frame(spark, [("a", "x"), ("b", "y")])
    val = frame(spark, [("a", "y"), ("c", "x"), ("a", "z")])
    assert [(r.user_id, r.parent_asin) for r in s.warm_rows(val, train).collect()] == [("a", "y")]
    assert [r.user_id for r in s.cold_start(val, train, "user_id").collect()] == ["c"]


def test_cutoff_split(spark, log):
    train = log.orderBy("timestamp").limit(100)
    before, after = s.cutoff_split(log, train, "timestamp")
    cut = train.agg(F.max("timestamp")).first()[0]
    assert before.filter(F.col("timestamp") > F.lit(cut)).count() == 0
    assert before.count() + after.count() == 300


def test_shuffle_and_holdout_do_not_depend_on_partitions(spark):
    ids = spark.range(500).withColumnRenamed("id", "k")
    one = [r.k for r in s.shuffled(ids.repartition(1), ["k"], 7).collect()]
    assert one == [r.k for r in s.shuffled(ids.repartition(8), ["k"], 7).collect()]
    assert one != sorted(one) and sorted(one) == list(range(500))
    held = s.hashed_holdout(ids, ["k"], 0.1).filter("is_holdout").count()
    assert 25 <= held <= 80


def test_row_numbers_and_running_totals(spark):
    df = spark.range(1000).select("id", (F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 5).alias("w"))
    numbered = {r.v: r.row_id for r in row_numbers(df, [F.col("v").desc()]).collect()}
    assert numbered == {v: 1000 - v for v in range(1000)}
    totals = {r.v: r.t for r in running_totals(df, [F.col("v")], {"w": "t"}).collect()}
    w = {r.v: r.w for r in df.collect()}
    assert totals == {v: sum(w[x] for x in range(v + 1)) for v in range(1000)}
    assert running_totals(df.limit(0), [F.col("v")], {"w": "t"}).count() == 0


def test_id_map_and_unknown_keys(spark):
    known = k.fit_id_map(frame(spark, [("b", "x"), ("a", "y"), ("b", "z"), (None, "x")]), "user_id", "u")
    assert sorted(map(tuple, known.collect())) == [("a", 0), ("b", 1)]
    asked = spark.createDataFrame([("a",), ("zz",), (None,)], "user_id string")
    got = k.to_index(asked, known, "user_id", "u")
    assert sorted((str(r.user_id), r.u) for r in got.collect()) == [("None", 2), ("a", 0), ("zz", 2)]
    back = k.to_key(got.select("u"), known, "user_id", "u", k.UNKNOWN_USER)
    assert sorted(r.user_id for r in back.collect()) == ["a", "unknown_user", "unknown_user"]


def test_key_checks(spark):
    df = frame(spark, [("a", "x"), ("a", "y"), ("b", "x")])
    assert [r.n_rows for r in k.uniqueness_violations(df, ["user_id"]).collect()] == [2]
    assert k.first_per_key(df, ["user_id"], ["n"]).count() == 2
    right = df.select("user_id").withColumn("z", F.lit(1))
    with pytest.raises(ValueError):
        k.many_to_one_join(df, right, ["user_id"])
    assert k.many_to_one_join(df, right.distinct(), ["user_id"]).count() == 3


def test_rows_without_time_come_first(spark):
    rows = [(f"u{i}", f"i{i}", None if i in (3, 7) else i * 100) for i in range(10)]
    df = spark.createDataFrame(rows, "user_id string, parent_asin string, sec bigint").selectExpr("user_id", "parent_asin", "timestamp_seconds(sec) as timestamp")
    for ratio, want in ((0.8, {0, 1, 2, 3, 4, 5, 6, 7}), (0.1, {3}), (0.2, {3, 7}), (0.3, {3, 7, 0})):
        train, val = s.chronological_split(df, "timestamp", ["user_id"], ratio)
        assert {int(r.user_id[1:]) for r in train.collect()} == want
        assert train.count() + val.count() == 10


def test_k_core_writes_the_pairs_again_only_when_some_go(spark, monkeypatch):
    from tidemark.operators import sampling

    written = []

    def spy(df, *args, **kwargs):
        out = materialize(df, *args, **kwargs)
        if "_n" in out.columns:
            written.append(out.count())
        return out

    materialize = sampling.materialize
    monkeypatch.setattr(sampling, "materialize", spy)
    rows = spark.range(100).selectExpr("id % 10 as user_id", "id div 10 as parent_asin")
    core = sampling.k_core(rows, min_user=10, min_item=10)
    assert core.converged and core.rounds == 1 and core.rows.count() == 100
    assert sum(written) == 100


def test_row_numbers_of_few_rows_are_few_tasks(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        numbered = row_numbers(spark.range(60).select((F.col("id") * 7 % 60).alias("v")), [F.col("v")])
        assert {r.v: r.row_id for r in numbered.collect()} == {v: v + 1 for v in range(60)}
        assert len(numbered.inputFiles()) < 5
        totals = running_totals(spark.range(60).select("id"), [F.col("id")], {"id": "upto"})
        assert {r.id: r.upto for r in totals.collect()} == {i: i * (i + 1) // 2 for i in range(60)}
        assert len(totals.inputFiles()) < 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
