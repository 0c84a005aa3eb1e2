"""Distributed row numbers and running totals over a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

POSITION_MASK = (1 << 33) - 1


def _with_offsets(stored: DataFrame, totals: list[Column], names: list[str]) -> DataFrame:
    """Attach what all earlier range partitions add up to.

    There is one row per range partition (at most ``spark.sql.shuffle.partitions``; AQE joins
    neighbouring small ones), so the unpartitioned window and the broadcast are bounded by that setting.
    """
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per_part = stored.groupBy("_part").agg(*[t.alias(n) for t, n in zip(totals, names)])
    starts = per_part.select(
        "_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in names]
    )
    return stored.join(F.broadcast(starts), "_part")


def row_numbers(df: DataFrame, order_by: Sequence[Column], name: str = "row_id") -> DataFrame:
    """1-based position of each row in the global order, without a single-task sort.

    ``order_by`` should end in columns that tell rows apart: rows equal on all of
    them share a range partition.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    stored = materialize(
        ranged.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)),
            }
        )
    )
    placed = _with_offsets(stored, [F.count(F.lit(1))], ["_start"])
    return placed.withColumn(name, F.col("_start") + F.col("_pos") + 1).drop(
        "_part", "_pos", "_start"
    )


def running_totals(
    df: DataFrame, order_by: Sequence[Column], values: dict[str, str]
) -> DataFrame:
    """Inclusive running totals over the global order; ``values`` maps column to output.

    The summed columns must be BIGINT or DOUBLE and free of NULLs.
    """
    kinds = {c: df.schema[c].dataType for c in values}
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_part", F.spark_partition_id())
    )
    schema = T.StructType(
        ranged.schema.fields + [T.StructField(out, kinds[c]) for c, out in values.items()]
    )

    def accumulate(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        carried = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            arrays, names = list(batch.columns), list(batch.schema.names)
            for column, out in values.items():
                source = batch.column(names.index(column))
                start = pa.scalar(carried.get(column, 0), source.type)
                total = pc.cumulative_sum(source, start=start)
                carried[column] = total[-1].as_py()
                arrays.append(total)
            yield pa.RecordBatch.from_arrays(arrays, names + list(values.values()))

    stored = materialize(ranged.mapInArrow(accumulate, schema))
    starts = [f"_before_{out}" for out in values.values()]
    placed = _with_offsets(stored, [F.sum(c) for c in values], starts)
    return placed.withColumns(
        {out: F.col(out) + F.col(start) for out, start in zip(values.values(), starts)}
    ).drop("_part", *starts)


def ranks_within(
    df: DataFrame, key: str, order_by: Sequence[Column], name: str, max_rows: int = 1_000_000
) -> DataFrame:
    """1-based rank of each row within its key.

    A window while no key exceeds ``max_rows``. Otherwise the rows are numbered in one
    global order, which splits a heavy key over many tasks, and each key's first
    number is taken off. ``order_by`` should tell rows apart.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if counts.filter(F.col("_n") > max_rows).isEmpty():
        return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order_by)))
    numbered = row_numbers(df, [F.col(key), *order_by], "_row")
    first = numbered.groupBy(key).agg(F.min("_row").alias("_first"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    joined = numbered.join(first.withColumnRenamed(key, "_key"), same)
    return joined.withColumn(name, (F.col("_row") - F.col("_first") + 1).cast("int")).drop("_key", "_row", "_first")
