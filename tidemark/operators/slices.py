"""Slices of hot keys.

A window over one key runs in one task. Keys with more than ``max_rows`` rows are
cut into slices of about ``max_rows`` rows in the order of the window, so that the
work of one key spreads over many tasks; operators then carry the state of earlier
slices into each slice. The edges follow the rows: a burst has many slices, a quiet
year has one. The NULL key is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_totals
from tidemark.session import materialize

HOT_ROWS = 1_000_000
#: Rows of ordinary keys that one task sorts: its memory does not grow with the table.
TASK_ROWS = 250_000
SLICE = "_slice"


def key_rows(df: DataFrame, key: str) -> tuple[int, int]:
    """Rows of the largest key, and all rows: one job over one column, combined before the shuffle."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = per_key.agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total")).first()
    return found["largest"] or 0, found["total"] or 0


def tasks_for(df: DataFrame, rows: int) -> int:
    """Partitions that keep ``rows`` at about ``TASK_ROWS`` a task, and all cores busy."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def hot_key_grid(df: DataFrame, key: str, at: str, max_rows: int = HOT_ROWS, shifts: Sequence[int] = (0,)) -> DataFrame | None:
    """(key, edges, step) for keys above ``max_rows``, or None when there are none.

    ``at`` is any ordered column; rows equal in it stay together. ``shifts`` are added
    to it when every row counts at several times. Looking for hot keys is one job over
    one column, combined before the shuffle; only their rows are read for the edges,
    which are the places where a running count passes a multiple of ``max_rows``. Edges
    come in groups of ``step``, so that finding a slice costs twice a square root. There
    are at most rows * shifts / max_rows of them.
    """
    hot = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > max_rows)
    if hot.isEmpty():
        return None
    hot = materialize(hot.select("_key"))
    rows = df.join(hot, F.col(key).eqNullSafe(F.col("_key")), "left_semi").select(F.col(key).alias("_key"), F.col(at).alias("_at"))
    if tuple(shifts) != (0,):
        rows = rows.select("_key", F.explode(F.array(*[F.col("_at") + s for s in shifts])).alias("_at"))
    counts = running_totals(rows.groupBy("_key", "_at").agg(F.count(F.lit(1)).alias("_n")), [F.col("_key"), F.col("_at")], {"_n": "_upto"})
    before = F.col("_upto") - F.col("_n")
    first = counts.groupBy(F.col("_key").alias("_same")).agg(F.min(before).alias("_first"))
    numbered = counts.join(first, F.col("_key").eqNullSafe(F.col("_same"))).withColumn("_no", F.floor((before - F.col("_first")) / max_rows))
    edges = numbered.groupBy("_key", "_no").agg(F.min("_at").alias("_edge")).groupBy("_key").agg(F.sort_array(F.collect_list("_edge")).alias("_e"))
    edges = edges.withColumn("_step", F.ceil(F.sqrt(F.size("_e"))).cast("int"))
    groups = F.transform(F.sequence(F.lit(1), F.size("_e"), F.col("_step")), lambda i: F.slice("_e", i, F.col("_step")))
    return materialize(edges.select("_key", groups.alias("_edges"), "_step"))


def with_slices(df: DataFrame, grid: DataFrame, key: str, at: str) -> DataFrame:
    """Add ``_slice`` (0 for ordinary keys) and ``_hot``. AQE picks the join by size."""
    joined = df.join(grid, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("_hot", F.col("_edges").isNotNull())
    group = F.greatest(F.size(F.filter("_edges", lambda e: e[0] <= F.col(at))) - 1, F.lit(0))
    inside = F.greatest(F.size(F.filter(F.get("_edges", group), lambda e: e <= F.col(at))) - 1, F.lit(0))
    number = F.when(F.col("_hot"), (group * F.col("_step") + inside).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumn(SLICE, number).drop("_key", "_edges", "_step")


def with_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    """``rows`` with what ``carry`` holds for their key and slice, NULLs where it has nothing."""
    named = carry.withColumnRenamed(key, "_key").withColumnRenamed(SLICE, "_no")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(SLICE) == F.col("_no"))
    return rows.join(named, same, "left").drop("_key", "_no")
