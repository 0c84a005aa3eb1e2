import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions import columns as c
from tidemark.operators import models as m
from tidemark.operators import transforms as x


def test_price_texts(spark):
    texts = ["$20.99", None, "from 12.99", "7.", "none", "", "1,299.00", "a5 6"]
    df = spark.createDataFrame([(t,) for t in texts], "price string")
    got = [r.p for r in df.select(c.price_number("price").alias("p")).collect()]
    assert got == [20.99, None, 12.99, 7.0, None, None, 1.0, 6.0]


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a , b,c ,d,e,f", ["x", "y"], "1__2__3"), (None, None, None)], "t string, a array<string>, ids string")
    got = df.select(
        c.top_tags(c.parsed_tags("t")).alias("tags"), c.joined_lines("a").alias("lines"),
        c.last_in_list("ids").alias("last"), F.size(c.id_list("ids", "__")).alias("n"), c.as_float("t").alias("f"), c.as_text("t").alias("s"),
    ).collect()
    assert got[0].tags == "a, b, c, d, e" and got[0].lines == "x\ny" and (got[0].last, got[0].n) == ("3", 3)
    assert (got[1].lines, got[1].last, got[1].n, got[1].f, got[1].s) == ("", None, 0, 0.0, "")


def test_fixed_length_vectors(spark):
    rows = [(None,), ([1.0, 2.0, float("nan")],), ([float(i) for i in range(400)],)]
    df = spark.createDataFrame(rows, "v array<double>")
    got = [r.v for r in df.select(c.fixed_length("v", 384).alias("v")).collect()]
    assert [len(v) for v in got] == [384] * 3
    assert sum(got[0]) == 0 and got[1][:4] == [1.0, 2.0, 0.0, 0.0] and got[2][-1] == 383.0


def test_titles_and_names(spark):
    df = spark.createDataFrame([("t" * 51,), ("t" * 50,), (None,)], "t string")
    assert [r.t for r in df.select(c.short_title("t").alias("t")).collect()] == ["t" * 50 + "...", "t" * 50, "N/A"]
    paths = spark.createDataFrame([("a/x_upto_2025_01_31.parquet",), ("x_upto_2025_01_31_120000.parquet",), ("x_upto_2025_13_31.parquet",), ("y.parquet",)], "p string")
    assert [str(r.d) for r in paths.select(c.snapshot_date("p").alias("d")).collect()] == ["2025-01-31", "2025-01-31", "None", "None"]


def test_scalers_use_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (4.0, 5.0)], "a double, k double")
    got = x.standardised(df, ["a", "k"]).collect()
    a = np.array([1.0, 0.0, 4.0])
    assert [r.a for r in got] == pytest.approx(list((a - a.mean()) / a.std()))
    assert [r.k for r in got] == [0.0, 0.0, 0.0]
    scaled = x.min_max_scaled(df, {"s": F.col("a"), "t": F.col("k")}).collect()
    assert [r.s for r in scaled] == [0.25, 0.0, 1.0] and [r.t for r in scaled] == [0.0] * 3


def test_one_hot_unseen_and_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "main_category string")
    new = spark.createDataFrame([("a",), ("b",), (None,), ("zz",)], "main_category string")
    out = x.with_one_hot(x.one_hot_slots(fit, "main_category"), new, "main_category")
    got = [r.v for r in out.select(vector_to_array("main_category_onehot").alias("v")).collect()]
    assert got[0] == [0, 1, 0] and got[1] == [0, 0, 1] and got[2] == [1, 0, 0] and got[3] == [0, 0, 0]


def test_category_counts_lower_case_and_line_breaks(spark):
    df = spark.createDataFrame([("i", ["Books", "b\nbooks"]), ("j", None)], "k string, categories array<string>")
    got = {(r.k, r.token): (r.slot, r.n) for r in x.category_counts(df, "k").collect()}
    assert got == {("i", "books"): (1, 2), ("i", "b"): (0, 1)}


def test_tfidf_matches_brute_force(spark):
    texts = ["The cat sat, the cat ran", "a cat AND the dog", "dog eat dog x", "", "cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "d int, t string")
    got = {(r.d, r.term): r.weight for r in x.tfidf(df, "d", "t", min_df=2, max_terms=3).collect()}
    docs = []
    for t in texts:
        words = [w for w in "".join(ch if ch.isalnum() else " " for ch in t.lower()).split() if len(w) > 1]
        docs.append(Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]))
    df_ = Counter(t for d in docs for t in d)
    total = sum(docs, Counter())
    vocab = sorted((t for t in df_ if df_[t] >= 2), key=lambda t: (-total[t], t))[:3]
    want = {}
    for i, d in enumerate(docs):
        raw = {t: d[t] * (math.log((1 + len(texts)) / (1 + df_[t])) + 1) for t in vocab if t in d}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        want.update({(i, t): v / norm for t, v in raw.items()})
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


STATS = ["n", "avg"]


def item_rows(spark):
    rows = [(f"i{i}", "AB"[i % 2], ["X", "Y"][: 1 + i % 2], f"${i}.50", float(i), None if i == 0 else i / 2) for i in range(8)]
    return spark.createDataFrame(rows, "parent_asin string, main_category string, categories array<string>, price string, n double, avg double")


def test_item_encoder_scales_each_slot(spark):
    rows = item_rows(spark)
    encoder = x.ItemEncoder.fit(rows.union(rows), STATS)
    out = encoder.transform(rows).orderBy("n")
    got = np.array([r.v for r in out.select(vector_to_array("item_vector").alias("v")).collect()])
    assert got.shape == (8, 2 + 2 + 1 + 2)
    spread = got.std(axis=0)
    assert all(s == pytest.approx(1.0) or s == pytest.approx(0.0) for s in spread)
    assert [r.n for r in out.collect()] == [float(i) for i in range(8)]
    unseen = rows.limit(1).withColumn("main_category", F.lit("??"))
    first = encoder.transform(unseen).select(vector_to_array("item_vector").alias("v")).first().v
    assert first[:2] == [0.0, 0.0]
    tagged = x.with_tag_embedding(encoder.transform(rows).withColumn("tag", F.lit(None).cast("array<double>")), "tag", 4)
    assert len(tagged.select(vector_to_array("features").alias("v")).first().v) == 11


def test_ranker_learns_an_easy_rule(spark):
    rows = spark.range(400).select((F.col("id") % 4 == 0).cast("int").alias("label"), (F.col("id") % 4).cast("double").alias("f"))
    for kind in ("logistic", "gbt"):
        scored = m.rank_scores(m.fit_ranker(rows, ["f"], kind), rows)
        high = scored.filter("label = 1").agg(F.min("score")).first()[0]
        assert high > scored.filter("label = 0").agg(F.max("score")).first()[0]


def test_models_score_after_the_session_has_observed_a_query(spark):
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = spark.range(40).select((F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 2).cast("double").alias("f"))
    assert m.rank_scores(m.fit_ranker(rows, ["f"]), rows).filter("score BETWEEN 0 AND 1").count() == 40
    machine = FMClassifier(featuresCol="ranker_input", labelCol="label", maxIter=2, seed=1)
    ready = VectorAssembler(inputCols=["f"], outputCol="ranker_input").transform(rows)
    scored = m.without_summary(machine.fit(ready)).transform(ready)
    assert scored.select(F.sum(vector_to_array("probability")[1])).first()[0] > 0


def test_item_embeddings_cover_all_items(spark):
    log = spark.range(200).select(
        (F.col("id") % 20).cast("string").alias("user_id"), (F.col("id") * 7 % 13).cast("string").alias("parent_asin"),
        F.timestamp_seconds("id").alias("timestamp"),
    )
    assert {len(r.vec) for r in m.item_embeddings(log, dim=8).collect()} == {8}
    by_als = m.item_embeddings(log, dim=4, method="als").collect()
    assert len(by_als) == 13 and {len(r.vec) for r in by_als} == {4}
