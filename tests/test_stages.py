"""What stays on the disk between the steps of a job."""

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import models, negatives, sequences, training


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return sum("/shuffle_" in f for f in files.split())


@pytest.fixture(scope="module")
def sparse(spark):
    """80 users with four of 70 items each: most pairs of items share no user."""
    rows = spark.range(320).select((F.col("id") % 80).alias("user_id"), F.pmod(F.xxhash64("id"), F.lit(70)).alias("parent_asin"), F.timestamp_seconds(F.col("id") * 60).alias("timestamp"))
    return session.materialize(rows)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    spark.sparkContext._jvm.System.gc()
    was, setting = shuffle_files(spark), spark.conf.get(session.SHUFFLE_CLEANUP)
    stored = session.materialize(spark.range(20_000).repartition(8, "id").groupBy((F.col("id") % 5000).alias("k")).count())
    assert shuffle_files(spark) <= was
    assert stored.count() == 5000 and spark.conf.get(session.SHUFFLE_CLEANUP) == setting


def test_passing_stages_go_with_their_block(spark):
    before = len(session._MADE)
    with session.passing_stages() as keep:
        gone = session.materialize(spark.range(3))
        with session.passing_stages() as inner:
            kept = keep(inner(session.materialize(spark.range(4))))
            session.release(session.materialize(spark.range(2)))
    assert kept.count() == 4 and session._MADE[before:] == [kept._stage]
    with pytest.raises(Exception):
        gone.count()


def test_waves_draw_the_same_negatives(spark, sparse, monkeypatch):
    pairs = session.materialize(sequences.skipgram_pairs(sparse))
    one = sorted(map(str, sequences.skipgram_negatives(sparse, pairs).collect()))
    before = len(session._MADE)
    monkeypatch.setattr(negatives, "WAVE_DRAWS", 100)
    monkeypatch.setattr(negatives, "WAVES", 2)
    assert sorted(map(str, sequences.skipgram_negatives(sparse, pairs).collect())) == one and one
    names = [set(spark.read.parquet(p).columns) for p in session._MADE[before:]]
    # Draws and tested pairs are gone, wave by wave.
    assert not any("_drawn" in n and "target" in n for n in names)
    assert sum("_picks" in n for n in names) >= negatives.WAVES


def test_embeddings_keep_only_the_pairs_that_they_train_on(spark, sparse):
    before = len(session._MADE)
    found = models.item_embeddings(sparse, dim=4, partitions=2)
    stored = [spark.read.parquet(p).columns for p in session._MADE[before:]]
    assert ["target", "context", "label"] in stored and not any("user" in c or "_user" in c or "user_id" in c for c in stored)
    assert found.count() == sparse.select("parent_asin").distinct().count()


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_user_vectors_shuffle_no_partial_sums(spark, few, monkeypatch):
    monkeypatch.setattr(models, "FEW_NUMBERS", few)
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 2), (3, 9), (None, 1)], "user_id bigint, parent_asin bigint")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 4.0])], "id bigint, vec array<float>")
    found = models.user_vectors(rows, vectors, 2)
    assert {r["qid"]: r["vec"] for r in found.collect()} == {1: [0.75, 2.0], 2: [0.5, 4.0], None: [1.0, 0.0]}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") < plan.index("Exchange hashpartitioning(user_id")


def test_lists_share_the_lookups_of_their_chunk(spark):
    known = spark.createDataFrame([(f"i{i}", i) for i in range(50)], "item string, no bigint")
    lists = [(u, t, ",".join(f"i{j}" for j in range(t, t + 3 + u % 9))) for u in range(20) for t in range(48)] + [(99, 0, None), (99, 1, "i1,x,i2"), (None, 2, "i1")]
    rows = spark.createDataFrame(lists, "u bigint, t bigint, ids string").coalesce(1)
    before = len(session._MADE)
    found = sequences.mapped_sequences(rows, ["u", "t"], "ids", known, "item", "no", n=4)
    got = {(r["u"], r["t"]): r["item_sequence"] for r in found.collect()}
    want = {}
    for u, t, ids in lists:
        entries = [int(x[1:]) if x[0] == "i" and int(x[1:]) < 50 else 50 for x in ids.split(",")][-4:] if ids and u is not None else []
        want[u, t] = [-1] * (4 - len(entries)) + entries
    assert got == want
    maps = [spark.read.parquet(p) for p in session._MADE[before:]]
    looked_up = sum(m.agg(F.sum(F.size("_map"))).first()[0] for m in maps if "_map" in m.columns)
    assert looked_up < sum(min(4, len(x[2].split(","))) for x in lists if x[2]) / 2


def test_likely_places_hold_the_best_and_skip_most():
    import numpy as np

    from tidemark.operators.similarity import _likely

    rng = np.random.default_rng(1)
    for scale in (1.0, 1e-20, 1e20):
        q, s = rng.normal(size=(30, 16)) * scale, rng.normal(size=(4000, 16))
        s[100:200] = s[0] * (1 + 1e-9 * rng.normal(size=(100, 1)))  # too close for single precision
        q[0], q[1] = s[0] * scale, 0.0
        visit = np.ones((30, 2), dtype=bool)
        visit[2] = [True, False]
        floors = np.full(30, -np.inf)
        floors[3] = np.sort(q[3] @ s.T)[-2]
        qi, si = _likely(q, s, np.array([0, 2000]), np.array([2000, 4000]), visit, floors, 10)
        sims = q @ s.T
        sims[2, 2000:] = -np.inf
        for i in range(30):
            best = np.argsort(-sims[i], kind="stable")[:10] if i != 3 else np.argsort(-sims[3])[:2]
            assert set(best) <= set(si[qi == i])
        assert len(si[qi == 4]) < 40 and len(si[qi == 3]) < 20 and set(si[qi == 2]) <= set(range(2000))


def test_blocks_to_visit_travel_as_bits(spark, monkeypatch):
    from tidemark.operators import similarity as sim

    seen, old = [], sim._score_shelves
    monkeypatch.setattr(sim, "_score_shelves", lambda q, *rest: seen.append(q.schema["blocks"].dataType.simpleString()) or old(q, *rest))
    vectors = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)], "id bigint, vec array<float>")
    sim.top_inner_products(vectors.withColumnRenamed("id", "qid"), vectors, 3, block_rows=8)
    assert seen == ["binary", "binary"]


def test_user_lists_do_not_travel_with_the_items(spark):
    rows = spark.range(400).select((F.col("id") % 40).alias("user_id"), F.pmod(F.xxhash64("id"), F.lit(60)).alias("parent_asin"), (F.col("id") % 5 + 1.0).alias("rating"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"))
    rows = session.materialize(rows)
    cut = F.timestamp_seconds(F.lit(300 * 3600))
    table = training.ranker_training_table(rows.filter(F.col("timestamp") < cut), rows.filter(F.col("timestamp") >= cut))
    assert table.count() == 800
    by_moment = table.groupBy("user_id", "timestamp").agg(F.count_distinct(F.struct(*training.USER_FEATURES)).alias("n"))
    assert by_moment.filter("n <> 1").isEmpty()
    assert table.filter(F.col("user_rating_cnt_90d") != F.floor(F.unix_seconds("timestamp") / 3600 / 40) + 1).isEmpty()
    plan = table.agg(F.sum("user_rating_cnt_90d"), F.sum("label"))._jdf.queryExecution().executedPlan().toString()
    assert "user_rating_cnt_90d" in plan and "recent_asin" not in plan


def test_user_features_are_put_together_where_their_rows_stand(spark):
    from tidemark.operators import temporal

    rows = session.materialize(spark.range(400).select((F.col("id") % 40).alias("user_id"), (F.col("id") % 7).alias("parent_asin"), (F.col("id") % 5 + 1.0).alias("rating"), F.timestamp_seconds(F.col("id") * 3600).alias("timestamp")))
    rows = rows.unionByName(rows.limit(3).withColumn("user_id", F.lit(None).cast("bigint")))
    found = temporal.user_features(rows)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    assert found.count() == 400 and found.filter("dedup_rn <> 1 OR user_rating_cnt_90d IS NULL").isEmpty()
    hot = temporal.user_features(rows, max_rows=4)
    assert hot.exceptAll(found).isEmpty() and hot.count() == 400
