import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import month_of_path
from tidemark.operators import temporal as t
from tidemark.schemas import EVENT_SCHEMA, ITEM_VIEW, USER_FRESH_VIEW, require_columns
from tidemark.sources import compaction, reviews, snapshots, tables
from tidemark.streaming import capture as cap
from tidemark.streaming import recent_items as recent
from tidemark import session


def test_reviews_read_write_by_month(spark, tmp_path):
    lines = [json.dumps({"user_id": "u", "parent_asin": "p", "rating": 4, "timestamp": ms, "images": []}) for ms in (0, -1, 2678400000)]
    (tmp_path / "r.jsonl").write_text("\n".join([*lines, "{broken"]))
    df = reviews.read_reviews(spark, str(tmp_path / "r.jsonl")).cache()
    assert df.count() == 4 and df.filter("_corrupt_record is not null").count() == 1
    good = df.filter("_corrupt_record is null").drop("_corrupt_record")
    reviews.write_by_month(reviews.with_month(good), str(tmp_path / "months"))
    back = spark.read.parquet(str(tmp_path / "months"))
    assert {r.year_month: r["count"] for r in back.groupBy("year_month").count().collect()} == {"1970-01": 1, "1969-12": 1, "1970-02": 1}
    assert "images" not in reviews.training_columns(back).columns
    parsed = reviews.parsed_interactions(good.limit(1)).first()
    assert parsed.timestamp.year == 1970 and parsed.rating == 4.0


def test_units_are_explicit(spark):
    event = spark.createDataFrame([("u", "i", "5", 1_700_000_000), ("u", "i", "bad", None)], "user_id string, item_id string, rating string, timestamp bigint")
    got = reviews.parsed_interactions(event, "seconds", {"item_id": "parent_asin"}).collect()
    assert got[0].timestamp.year == 2023 and got[0].parent_asin == "i" and got[1].rating is None
    with pytest.raises(ValueError):
        reviews.parsed_interactions(event, "hours")
    with pytest.raises(ValueError):
        require_columns(event.drop("rating"), EVENT_SCHEMA)


def test_snapshots(spark, tmp_path):
    for day in ("2025_01_01", "2025_01_03", "2025_01_02", "2024_12_31"):
        spark.createDataFrame([(day,)], "d string").toPandas().to_parquet(tmp_path / f"recsys_data_upto_{day}.parquet")
    (tmp_path / "other.parquet").write_text("not read")
    got = sorted(r.d for r in snapshots.read_newest(spark, str(tmp_path), 2).collect())
    assert got == ["2025_01_02", "2025_01_03"]
    files = snapshots.manifest(spark, str(tmp_path))
    assert snapshots.freshness(files, "2025-01-03").first().is_fresh
    assert not snapshots.freshness(files, "2025-01-04").first().is_fresh
    assert not snapshots.freshness(files.limit(0), "2025-01-04").first().is_fresh


def test_compaction(spark, tmp_path):
    rows = spark.range(90).select("id", F.concat(F.lit("2025-0"), (1 + F.floor(F.col("id") / 30)).cast("string")).alias("year_month"))
    rows.repartition(3).write.partitionBy("year_month").parquet(str(tmp_path / "in"))
    counts = compaction.file_counts(spark, str(tmp_path / "in"))
    listed = sorted((r.name, r.n) for r in counts.collect())
    want, current, filled = {}, 1, 0
    for name, n in listed:
        want[name] = current
        filled += n
        if filled >= 25:
            current, filled = current + 1, 0
    assert {r.name: r.bin for r in compaction.bins(counts, 25).collect()} == want
    compaction.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), "m", 25)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == list(range(90))
    per = out.groupBy("output").agg(F.count("*").alias("n"), F.countDistinct(F.col("_metadata.file_path")).alias("files")).collect()
    assert all(r.files == 1 for r in per) and sum(r.n < 25 for r in per) <= 1


def test_compaction_cuts_large_files_into_blocks(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("2025-01").alias("year_month"))
    rows.coalesce(1).write.partitionBy("year_month").parquet(str(tmp_path / "in"))
    # Blocks this small would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compaction.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), "m", 25, 10)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    assert [r.output for r in out.select("output").distinct().collect()] == ["m_2025-01_2025-01_id1"]
    assert out.select("_metadata.file_path").distinct().count() > 4


def test_snapshots_of_part_files_and_commit_lists(spark, tmp_path):
    rows = spark.range(40).select("id", F.expr("date '2025-01-01' + cast(id div 10 as int)").alias("day"))
    snapshots.write_dated(rows, str(tmp_path / "dated"), "r", F.col("day"), rows_per_file=3)
    files = snapshots.manifest(spark, str(tmp_path / "dated"))
    assert files.count() == 4
    assert sorted(r.id for r in snapshots.read_newest(spark, str(tmp_path / "dated"), 2).collect()) == list(range(20, 40))


def test_captured_snapshots_survive_a_failed_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    place = str(tmp_path)
    line = '{"user_id":"%s","item_id":"i","rating":5,"timestamp":%d}'

    def run(**options):
        cap.capture_snapshots(cap.folder_messages(spark, f"{place}/in"), f"{place}/out", f"{place}/bad", f"{place}/cp", by_event_time=True, **options)

    def crash(batch_id):
        raise RuntimeError("stopped")

    (tmp_path / "in" / "a.txt").write_text(line % ("a", 1_600_000_000) + "\n{broken")
    run()
    (tmp_path / "in" / "b.txt").write_text(line % ("b", 1_600_000_000))
    with pytest.raises(Exception, match="stopped"):
        run(before_commit=crash)
    # What the failed batch wrote does not count.
    assert [r.user_id for r in snapshots.read_newest(spark, f"{place}/out", 5).collect()] == ["a"]
    run()
    run()
    (tmp_path / "in" / "c.txt").write_text("{broken too")
    run()
    files = sorted(r.path.rpartition("/")[2] for r in snapshots.manifest(spark, f"{place}/out").collect())
    assert files == [f"events_b{b:09d}_upto_2020_09_13_122640.parquet" for b in (0, 1)]
    assert [r.user_id for r in snapshots.read_newest(spark, f"{place}/out", 1).collect()] == ["b"]
    assert sorted(r.user_id for r in snapshots.read_newest(spark, f"{place}/out", 5).collect()) == ["a", "b"]
    assert sorted(r.value for r in spark.read.parquet(f"{place}/bad").collect()) == ["{broken", "{broken too"]
    # A batch that comes again after its commit changes nothing.
    again = cap.parsed(spark.createDataFrame([(line % ("z", 1),)], "value string"))
    cap.snapshot_sink(f"{place}/out", f"{place}/bad", by_event_time=True)(again, 1)
    assert snapshots.manifest(spark, f"{place}/out").count() == 2


def test_store_merges_runs_and_replaces_one(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 86_400)
    rows = spark.range(40).select((F.col("id") % 7).cast("string").alias("parent_asin"), at.alias("timestamp"), "id")
    for f in ITEM_VIEW.fields:
        rows = rows.withColumn(f, F.col("id"))
    store, opened = str(tmp_path / "store"), []
    untils = [str(r.t) for r in rows.filter("id % 2 = 1").select(F.col("timestamp").cast("string").alias("t")).orderBy("t").collect()]
    for until in untils:
        tables.materialise(spark, rows, ITEM_VIEW, store, until)
        opened.append(len(tables.covering(tables._log(spark, store))))
    assert max(opened) <= 2 * (tables.FAN - 1) + 1 and len(untils) == 20
    got = {r.parent_asin: r[ITEM_VIEW.fields[0]] for r in tables.read_store(spark, ITEM_VIEW, store).collect()}
    assert got == {str(i % 7): i for i in range(33, 40)}
    changed = rows.withColumn(ITEM_VIEW.fields[0], F.col("id") + 1000)
    tables.materialise(spark, changed, ITEM_VIEW, store, untils[-2])
    got = {r.parent_asin: r[ITEM_VIEW.fields[0]] for r in tables.read_store(spark, ITEM_VIEW, store).collect()}
    assert got == {str(i % 7): i + 1000 * (i in (36, 37)) for i in range(33, 40)}
    with pytest.raises(FileNotFoundError):
        tables.read_store(spark, ITEM_VIEW, str(tmp_path / "none"))


def test_warehouse_rows_and_tables(spark, tmp_path):
    train = spark.createDataFrame([("a", 1000, ["x"])], "user_id string, timestamp bigint, images array<string>")
    val = spark.createDataFrame([("b", 2000, 1)], "user_id string, timestamp bigint, extra int")
    rows = tables.warehouse_rows(train, val)
    assert rows.columns == ["user_id", "timestamp", "extra"] and rows.count() == 2
    spark.sql(f"CREATE DATABASE IF NOT EXISTS w LOCATION '{tmp_path}/w'")
    tables.replace_table(rows, "w.t")
    tables.replace_table(rows, "w.t")
    tables.append_table(rows, "w.t")
    assert spark.table("w.t").count() == 4
    spark.sql("DROP DATABASE w CASCADE")


def test_vectors_and_messages(spark, tmp_path):
    df = spark.createDataFrame([(1, [3.0, 4.0])], "id int, vec array<double>")
    tables.replace_vectors(df, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).first().vec == pytest.approx([0.6, 0.8])
    events = spark.createDataFrame([("u", "i", 5.0, None)], EVENT_SCHEMA)
    out = tables.event_messages(events, 77).first()
    assert json.loads(out.value) == {"user_id": "u", "item_id": "i", "rating": 5.0, "timestamp": 77}


def test_materialise_is_incremental_and_repeatable(spark, log, tmp_path):
    stats = t.item_window_stats(log)
    store, half = str(tmp_path / "store"), str(log.agg(F.percentile_approx("timestamp", 0.5)).first()[0])
    for until in (half, half, "2100-01-01 00:00:00"):
        tables.materialise(spark, stats, ITEM_VIEW, store, until)
    runs = {r.run: r.n for r in spark.read.parquet(store).groupBy("run").agg(F.count("*").alias("n")).collect()}
    assert len(runs) == 2
    newest = t.latest_per_key(stats, "parent_asin", "timestamp")
    got = tables.read_store(spark, ITEM_VIEW, store)
    assert sorted(map(str, got.collect())) == sorted(map(str, newest.select(got.columns).collect()))
    later = stats.filter(F.col("timestamp") > F.lit(half).cast("timestamp")).select("parent_asin").distinct().count()
    assert min(runs.values()) <= later


def test_fresh_rows_expire(spark):
    rows = spark.createDataFrame([("a", "2025-01-01 00:00:00"), ("b", "2025-01-02 00:00:00"), ("c", "2025-01-03 00:00:00")], "user_id string, t string")
    full = rows.withColumn("timestamp", F.col("t").cast("timestamp"))
    for f in USER_FRESH_VIEW.fields:
        full = full.withColumn(f, F.lit(1))
    got = USER_FRESH_VIEW.live(full, "2025-01-02 00:00:00").collect()
    assert sorted(r.user_id for r in got) == ["a", "b"]


def test_capture_over_restarts(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def send(name, *lines):
        (source / name).write_text("\n".join(lines))
        cap.capture(cap.folder_messages(spark, str(source)), f"{out}/good", f"{out}/bad", f"{out}/cp", 1_700_000_000)

    send("a.txt", '{"user_id":"u","item_id":"i","rating":5,"timestamp":1600000000}', "{broken")
    send("b.txt", '{"user_id":"v","item_id":"j","rating":4}')
    send("c.txt", '{"user_id":"w","item_id":"k","rating":3,"timestamp":1600000001}', '{"item_id":"k","rating":3}', "", "null")
    good = spark.read.parquet(f"{out}/good")
    assert sorted((r.user_id, r.parent_asin, str(r.event_date)) for r in good.collect()) == [
        ("u", "i", "2020-09-13"), ("v", "j", "2023-11-14"), ("w", "k", "2020-09-13")
    ]
    bad = [r.value for r in spark.read.schema("value string").parquet(f"{out}/bad").collect()]
    assert sorted(bad) == ["", "null", '{"item_id":"k","rating":3}', "{broken"]
    events = cap.parsed(spark.createDataFrame([(None,), ('{"user_id":"u"}',)], "value string"))
    assert cap.good_events(events).count() == 0 and cap.bad_events(events).count() == 2 and cap.good_events(events, 5).count() == 1


def test_capture_to_table(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text('{"user_id":"u","item_id":"i","rating":5,"timestamp":1600000000}')
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cap LOCATION '{tmp_path}/cap'")
    for _ in range(2):
        cap.capture_to_table(cap.folder_messages(spark, str(source)), "cap.events", str(tmp_path / "cp"))
    assert spark.table("cap.events").count() == 1
    spark.sql("DROP DATABASE cap CASCADE")


def test_recent_items_stream_equals_batch(spark, log, tmp_path):
    events = log.select("user_id", F.col("parent_asin").alias("item"), F.unix_seconds("timestamp").alias("at"))
    place = str(tmp_path)
    initial = spark.createDataFrame([("u1", ["old,1", "old2"], [5, 6]), ("zz", ["q"], [1])], "user_id string, items array<string>, times array<bigint>")
    lost = spark.createDataFrame([(None, "x", 1), ("u1", None, 1), ("u1", "x", None)], "user_id string, item string, at bigint")
    assert recent.without_time(lost.union(events)).count() == 3
    events = events.union(lost)
    setting = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    # Newer rows first, so that the second run brings late events.
    middle = 1_600_000_000 + 30 * 43_200
    for part in (events.filter(F.col("at") >= middle), events.filter((F.col("at") < middle) | F.col("at").isNull())):
        part.coalesce(1).write.mode("append").parquet(f"{place}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{place}/in")
        recent.run_available(recent.recent_items_stream(stream, initial), f"{place}/out", f"{place}/cp")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == setting
    got = {r.user_id: list(zip(r.times, r["items"])) for r in recent.current_lists(spark.read.parquet(f"{place}/out")).collect()}
    for user, listed in got.items():
        rows = sorted((r["at"], r["item"]) for r in recent.with_time(events).collect() if r.user_id == user)
        if user == "u1":
            rows = [(5, "old,1"), (6, "old2")] + rows
        assert listed == sorted(rows)[-10:]


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    named = session.shared_dir(spark)
    assert named

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())


def test_month_of_path(spark):
    df = spark.createDataFrame([("a/year_month=2025-01/f.parquet",), ("b/f.parquet",)], "p string")
    assert [r.m for r in df.select(month_of_path("p").alias("m")).collect()] == ["2025-01", None]


def test_stage_folders_go_when_their_block_ends(spark, log):
    from pathlib import Path

    from tidemark.operators.sampling import k_core

    left = lambda: {p.name for p in Path(session.shared_dir(spark).removeprefix("file:")).glob("stage-*")}
    before = left()
    with session.stage_folders():
        assert k_core(log, min_user=2, min_item=3).rows.count() > 0
        assert left() > before
    assert left() == before


def test_compaction_deals_blocks_by_rows(spark, tmp_path):
    rows = spark.range(1000).select("id", F.lit("2025-01").alias("year_month"))
    rows.coalesce(1).write.partitionBy("year_month").parquet(str(tmp_path / "in"))
    # The bytes fit one task; creating the files must not be the work of one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        compaction.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), "m", 25, 10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    assert out.select("_metadata.file_path").distinct().count() > 4
