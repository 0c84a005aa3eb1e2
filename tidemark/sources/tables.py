"""Warehouse tables, feature stores and published payloads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import millis_to_timestamp, unit
from tidemark.operators.temporal import latest_per_key
from tidemark.schemas import FeatureView
from tidemark.sources import commits


def warehouse_rows(train: DataFrame, val: DataFrame) -> DataFrame:
    """Both splits by column name, UTC timestamps, without the nested image column."""
    both = train.unionByName(val, allowMissingColumns=True)
    return both.withColumn("timestamp", millis_to_timestamp("timestamp")).drop("images")


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def feature_table(spark: SparkSession, name: str, view: FeatureView) -> DataFrame:
    return view.rows(spark.table(name))


def replace_vectors(vectors: DataFrame, path: str) -> None:
    """Rebuild a vector collection: one L2-normalised vector per id."""
    rows = vectors.select("id", unit("vec").cast("array<float>").alias("vec"))
    rows.write.mode("overwrite").parquet(path)


def event_messages(events: DataFrame, as_of) -> DataFrame:
    """(key, value) messages; a missing timestamp becomes ``as_of`` epoch seconds."""
    body = F.struct("user_id", "item_id", "rating", F.coalesce("timestamp", F.lit(as_of).cast("bigint")).alias("timestamp"))
    return events.select(F.col("user_id").cast("string").alias("key"), F.to_json(body).alias("value"))


def publish_to_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the cluster."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


#: A store's commit list. A level 0 entry is one run; a higher one holds the newest rows of its members.
LOG, MERGED = "_log", "_merged"
LOG_SCHEMA = "name string, folder string, level int, members array<string>, mark string"
#: Runs of one level that are merged into one of the next.
FAN = 4


def _log(spark: SparkSession, store: str) -> list:
    """The commit list: one short row per run and merged run."""
    return commits.entries(spark, f"{store}/{LOG}", LOG_SCHEMA).collect()


def covering(entries: list) -> list:
    """The fewest entries that hold every run once: the highest levels first, in the order of their runs."""
    chosen, held = [], set()
    for entry in sorted(entries, key=lambda e: -e.level):
        if held.isdisjoint(entry.members):
            chosen.append(entry)
            held.update(entry.members)
    return sorted(chosen, key=lambda e: e.members[0])


def materialise(
    spark: SparkSession, source: DataFrame, view: FeatureView, store: str, until: str, start: str | None = None
) -> None:
    """Bring the newest row of each changed key into the store, up to ``until``.

    Only rows after the newest time of the earlier runs are read, and only changed keys are
    written, as one run of their own. That time stands in the commit list, so no run is read for it.
    Repeating a run replaces that run alone; merged runs that held it are made anew.
    """
    key, time = view.key, view.time
    run = until.replace(" ", "T").replace(":", "-")
    listed = _log(spark, store)
    mark = start or max((e.mark for e in listed if e.level == 0 and e.name < run and e.mark), default=None)
    for entry in listed:
        if run in entry.members:
            commits.drop(f"{store}/{LOG}", f"{entry.level}-{entry.name}")
            if entry.level:
                commits.remove_folders(f"{store}/{MERGED}", entry.folder.rpartition("/")[2])
    rows = view.rows(source).filter(F.col(time) <= F.lit(until).cast("timestamp"))
    if mark is not None:
        rows = rows.filter(F.col(time) > F.lit(mark).cast("timestamp"))
    seen = Observation()
    newest = F.date_format(F.max(time), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("mark")
    folder = f"run={run}"
    latest_per_key(rows, key, time).observe(seen, newest).write.mode("overwrite").parquet(f"{store}/{folder}")
    entry = {"name": run, "folder": folder, "level": 0, "members": [run], "mark": seen.get["mark"]}
    commits.put(f"{store}/{LOG}", f"0-{run}", entry)
    _merge_runs(spark, view, store)


def _merge_runs(spark: SparkSession, view: FeatureView, store: str) -> None:
    """Merge neighbouring runs of one level, ``FAN`` at a time, until no level has that many in a row.

    Runs stay, so that each can be replaced; a read opens at most ``FAN - 1`` entries a level after runs in order.
    """
    while True:
        cover = covering(_log(spark, store))
        groups = (cover[i : i + FAN] for i in range(len(cover) - FAN + 1))
        group = next((g for g in groups if len({e.level for e in g}) == 1), None)
        if group is None:
            return
        rows = _newest(spark, view, [f"{store}/{e.folder}" for e in group])
        name = f"{group[0].members[0]}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{store}/{MERGED}/{name}")
        level, members = group[0].level + 1, [m for e in group for m in e.members]
        entry = {"name": name, "folder": f"{MERGED}/{name}", "level": level, "members": members, "mark": None}
        commits.put(f"{store}/{LOG}", f"{level}-{name}", entry)


def _newest(spark: SparkSession, view: FeatureView, folders: list[str]) -> DataFrame:
    rows = spark.read.parquet(*folders).select(view.key, view.time, *view.fields)
    return latest_per_key(rows, view.key, view.time)


def read_store(spark: SparkSession, view: FeatureView, store: str, as_of=None) -> DataFrame:
    """Newest row per key over all runs, merged ones where there are, with expired rows left out at ``as_of``."""
    folders = [f"{store}/{e.folder}" for e in covering(_log(spark, store))]
    if not folders:
        raise FileNotFoundError(f"no run in {store}")
    newest = _newest(spark, view, folders)
    return newest if as_of is None else view.live(newest, as_of)
