"""Each user's newest items, kept up to date from the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEEP = 10
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_time(events: DataFrame) -> DataFrame:
    """Events that have a user, an item and a time; the state takes no others."""
    return events.filter("user_id IS NOT NULL AND item IS NOT NULL AND at IS NOT NULL")


def without_time(events: DataFrame) -> DataFrame:
    """The rest, for a sink of their own."""
    return events.filter("user_id IS NULL OR item IS NULL OR at IS NULL")


def newest_per_batch(events: DataFrame, keep: int = KEEP) -> DataFrame:
    """Drop what cannot be among a user's newest ``keep`` rows, before the shuffle.

    Each Arrow batch keeps its newest rows per user; the state only ever needs
    those, so one very active user does not flood a single task.
    """

    def trim(batches):
        for pdf in batches:
            ordered = pdf.sort_values(["at", "item"], kind="stable")
            yield ordered.groupby("user_id", sort=False, dropna=False).tail(keep)

    return events.mapInPandas(trim, events.schema)


class RecentItems(StatefulProcessor):
    """State per user: newest items and their times in order, and a version."""

    def __init__(self, keep: int = KEEP):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType(
            [
                T.StructField("items", T.ArrayType(T.StringType())),
                T.StructField("times", T.ArrayType(T.LongType())),
                T.StructField("version", T.LongType()),
            ]
        )
        self.state = handle.getValueState("recent", schema)

    def _merge(self, rows):
        items, times, version = self.state.get() if self.state.exists() else ([], [], 0)
        merged = sorted([*zip(times, items), *rows])[-self.keep :]
        items, times = [i for _, i in merged], [t for t, _ in merged]
        self.state.update((items, times, version + 1))
        return (times[-1] if times else None), items, times, version + 1

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        fresh = []
        for pdf in rows:
            fresh.extend(zip((int(t) for t in pdf["at"]), (str(i) for i in pdf["item"])))
            fresh = sorted(fresh)[-self.keep :]
        newest, items, times, version = self._merge(fresh)
        yield pd.DataFrame(
            {"user_id": [key[0]], "at": [newest], "items": [items], "times": [times], "version": [version]}
        )

    def handleInitialState(self, key, initialState, timerValues):
        for items, times in zip(initialState["items"], initialState["times"]):
            if items is not None and len(items):
                self._merge([(int(t), str(i)) for t, i in zip(times, items)])

    def close(self) -> None:
        pass


def recent_items_stream(events: DataFrame, initial: DataFrame | None = None, keep: int = KEEP) -> DataFrame:
    """Updated (user_id, at, items, times, version) rows for (user_id, item, at) events.

    ``at`` is epoch time as BIGINT. Late events are placed by time; events without user,
    item or time are left out (``without_time`` has them). ``initial`` is (user_id, items,
    times) from the batch features, items as texts and times as BIGINT in arrays. Needs the
    RocksDB state store, which ``run_available`` asks for.
    """
    user = events.schema["user_id"].dataType.simpleString()
    named = with_time(events.select("user_id", "item", "at"))
    trimmed = newest_per_batch(named, keep)
    return trimmed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=RecentItems(keep),
        outputStructType=f"user_id {user}, at bigint, items array<string>, times array<bigint>, version bigint",
        outputMode="Append",
        timeMode="None",
        initialState=None if initial is None else initial.groupBy("user_id"),
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what is available now into Parquet, exactly once over all runs.

    The query takes the state store setting with it when it starts; the session gets its own back.
    """
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, ROCKSDB)
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(name, before)
    query.awaitTermination()


def current_lists(updates: DataFrame) -> DataFrame:
    """The latest version of each user's row."""
    newest = updates.groupBy("user_id").agg(F.max_by(F.struct("at", "items", "times"), "version").alias("r"))
    return newest.select("user_id", "r.*")
