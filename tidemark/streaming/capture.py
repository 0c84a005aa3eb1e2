"""Interaction events from a topic or folder into Parquet and tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import CORRUPT, EVENT_SCHEMA
from tidemark.sources import commits
from tidemark.sources.snapshots import COMMITS


def kafka_messages(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """JSON messages of a topic from the earliest offset. Needs the Kafka connector."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return stream.select(F.col("value").cast("string").alias("value"))


def folder_messages(spark: SparkSession, folder: str) -> DataFrame:
    """JSON messages from text files, one per line."""
    return spark.readStream.text(folder)


def parsed(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """The message as it came (``value``), its event columns, and what did not parse."""
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return messages.select(F.from_json("value", with_bad, options).alias("e"), "value").select("value", "e.*")


def _seconds(as_of: int | None):
    return F.col("timestamp") if as_of is None else F.coalesce("timestamp", F.lit(as_of).cast("bigint"))


def _is_good(as_of: int | None):
    return F.col(CORRUPT).isNull() & F.col("user_id").isNotNull() & _seconds(as_of).isNotNull()


def good_events(events: DataFrame, as_of: int | None = None) -> DataFrame:
    """Parsed events as interactions; a missing timestamp becomes ``as_of`` epoch seconds."""
    return events.filter(_is_good(as_of)).select(
        "user_id", F.col("item_id").alias("parent_asin"), "rating", F.timestamp_seconds(_seconds(as_of)).alias("timestamp")
    )


def bad_events(events: DataFrame, as_of: int | None = None) -> DataFrame:
    """Every other message as it came: broken, empty, or without user or time."""
    return events.filter(~_is_good(as_of)).select("value")


def capture(messages: DataFrame, out: str, bad_out: str, checkpoints: str, as_of: int | None = None) -> None:
    """Read what is available now, each message exactly once over all runs.

    Two queries with checkpoints of their own write good events by event date and
    bad messages as they came.
    """
    events = parsed(messages)
    good = good_events(events, as_of).withColumn("event_date", F.to_date("timestamp"))
    writes = [
        (good.writeStream.partitionBy("event_date"), out, "good"),
        (bad_events(events, as_of).writeStream, bad_out, "bad"),
    ]
    running = [
        w.format("parquet")
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .option("path", path)
        .trigger(availableNow=True)
        .start()
        for w, path, name in writes
    ]
    for query in running:
        query.awaitTermination()


def capture_to_table(messages: DataFrame, table: str, checkpoint: str, as_of: int | None = None) -> None:
    """Append what is available now to a table."""
    query = (
        good_events(parsed(messages), as_of)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()


def snapshot_sink(
    out: str, bad_out: str, prefix: str = "events", as_of: int | None = None, by_event_time: bool = False,
    before_commit: Callable[[int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch once as a dated snapshot, bad messages beside.

    A batch becomes the folder ``{prefix}_b{id}_upto_YYYY_MM_DD_HHMMSS.parquet``, named by the time of capture or by
    the newest event in it. It counts from the entry in the commit list on: a batch that is tried again finds its
    entry and does nothing, or removes what the failed attempt left and writes anew. A batch without good events
    has an entry but no snapshot. ``out`` belongs to one checkpoint, as batch ids do.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{batch_id:09d}"
        if commits.has(f"{out}/{COMMITS}", name):
            return
        commits.remove_folders(out, f"{prefix}_b{name}_")
        held = batch.persist()
        try:
            good = good_events(held, as_of)
            sums = good.agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("t")).select("n", F.unix_seconds("t").alias("t")).first()
            path = None
            if sums["n"]:
                seconds = sums["t"] if by_event_time else datetime.now(timezone.utc).timestamp()
                stamp = datetime.fromtimestamp(seconds, timezone.utc).strftime("%Y_%m_%d_%H%M%S")
                path = f"{prefix}_b{name}_upto_{stamp}.parquet"
                good.write.mode("overwrite").parquet(f"{out}/{path}")
            bad_events(held, as_of).write.mode("overwrite").parquet(f"{bad_out}/batch={batch_id}")
        finally:
            held.unpersist()
        if before_commit:
            before_commit(batch_id)
        commits.put(f"{out}/{COMMITS}", name, {"batch": batch_id, "path": path, "n_rows": sums["n"]})

    return write


def capture_snapshots(messages: DataFrame, out: str, bad_out: str, checkpoint: str, **options) -> None:
    """Read what is available now into dated snapshots, which ``snapshots.read_newest`` then finds."""
    query = (
        parsed(messages)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(snapshot_sink(out, bad_out, **options))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
