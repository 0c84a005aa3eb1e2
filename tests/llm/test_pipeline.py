"""The stages in a row on planted documents, each on what its predecessor kept."""

import random

import pytest
from helpers import documents, prose
from test_documents import BENCH, INSULTS, labelled



@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(11)
    made = labelled(rng, 500)
    rows = [(i, t) for i, t, _ in made]
    passage = prose(rng, 40)
    rows += [(1000, passage + " " + prose(rng, 30)), (1001, rows[0][1] + " more words here"), (1002, "yes " + " ".join(INSULTS)), (1003, None), (1004, "")]
    sources = [rng.choice(["a", "b", None]) for _ in rows]
    documents(spark, rows, sources).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, x) for i, _, x in made], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage, 0, "x")], BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), {i for i, _, x in made if x}


def test_pipeline(spark, folder):
    pipeline = pytest.importorskip("corpus_pipeline")
    path, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for n, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, path)
        assert n == len(pipeline.STAGES) - 1 or out.dtypes == docs.dtypes
        out.write.parquet(f"{path}/out-{name}")
        docs = spark.read.parquet(f"{path}/out-{name}")
        kept.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    after = [set(k) for k in kept]
    assert 1002 not in after[0] and len(after[0] & toxic) <= 3 and {1003, 1004} <= after[0]
    assert len(kept[0]) >= 505 - len(toxic) - 1 - 3
    assert 1001 not in after[1] or 0 not in after[0]
    assert after[1] - after[2] == {1000}
    assert after[3] <= after[2] and sorted(kept[3]) == sorted(kept[4])
    assert [r["start"] for r in docs.orderBy("start").collect()][0] == 0
    whole = pipeline.run(spark, path)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
