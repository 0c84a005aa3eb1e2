"""Merging small files into files of at least a given number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import month_of_path
from tidemark.operators.slices import tasks_for
from tidemark.session import materialize

MIN_ROWS = 100_000
#: Rows that one task writes of an output.
BLOCK_ROWS = 1_000_000
#: File lists up to this many rows are broadcast.
MAX_LISTED = 100_000


def file_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(name, month, n): rows per file, from Parquet footers; files without a month are left out."""
    rows = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("name"))
    counts = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("month", month_of_path("name")).filter("month is not null")


def bins(counts: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Add ``bin`` (from 1): files in name order, a bin closing once it has ``min_rows``.

    Where a bin ends depends on all earlier ones, so one task runs down the sorted
    file list. It holds one short row per file and keeps only two numbers.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema.fields)

    def number(batches):
        import pyarrow as pa

        current, filled = 1, 0
        for batch in batches:
            found = []
            for n in batch.column(batch.schema.names.index("n")).to_pylist():
                found.append(current)
                filled += n
                if filled >= min_rows:
                    current, filled = current + 1, 0
            columns = [*batch.columns, pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "bin"])

    ordered = counts.repartition(1).sortWithinPartitions("name")
    return ordered.mapInArrow(number, f"{kinds}, bin bigint")


def bin_names(binned: DataFrame, prefix: str) -> DataFrame:
    """Per bin the output name: first month, last month and running number."""
    spans = binned.groupBy("bin").agg(
        F.min_by("month", "name").alias("first"), F.max_by("month", "name").alias("last"), F.sum("n").alias("n_rows")
    )
    name = F.concat(
        F.lit(f"{prefix}_"), "first", F.lit("_"), "last", F.lit("_id"), F.col("bin").cast("string")
    )
    return spans.select("bin", name.alias("output"), "n_rows")


def compact(
    spark: SparkSession, folder: str, out: str, prefix: str = "merged", min_rows: int = MIN_ROWS, block_rows: int = BLOCK_ROWS
) -> None:
    """Rewrite ``folder`` with one output folder per bin.

    A row's place in its bin is its file's place there plus its index in the file. Bins are cut by place into blocks
    of ``block_rows``, the unit that is shuffled and written: neither a large file nor a bin is one task's work. Creating
    a file costs more than its few bytes, so blocks are dealt to tasks by rows and not by bytes.
    """
    binned = materialize(bins(file_counts(spark, folder), min_rows))
    before = Window.partitionBy("bin").orderBy("name").rowsBetween(Window.unboundedPreceding, -1)
    placed = binned.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    named = placed.join(bin_names(binned, prefix), "bin").select(F.col("name").alias("_file"), "output", "_before")
    found = binned.agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows")).first()
    if found["files"] <= MAX_LISTED:
        named = F.broadcast(named)
    read = spark.read.parquet(folder)
    rows = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    block = F.expr(f"(_before + _index) div {block_rows}")
    merged = rows.join(named, "_file").withColumn("_block", block).select(*read.columns, "output", "_block")
    merged.repartition(tasks_for(rows, found["rows"] or 0), "output", "_block").drop("_block").write.mode("overwrite").partitionBy("output").parquet(out)
