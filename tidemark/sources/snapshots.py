"""Dated snapshots: which are newest, are they fresh, read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import snapshot_date
from tidemark.sources import commits

#: Folder of a snapshot folder's commit list, and the entries in it.
COMMITS = "_commits"
COMMIT_SCHEMA = "batch bigint, path string, n_rows bigint"
#: The part files of a snapshot that is a folder.
PART_FILES = r"(_upto_\d{4}_\d{2}_\d{2}(?:_\d{6})?\.parquet)/.*$"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, snapshot_date) of dated snapshots, each a Parquet file or a folder of part files. Reads none of them.

    Where the folder has a commit list, only snapshots named there count; what a failed write left does not.
    """
    if commits.is_folder(f"{folder}/{COMMITS}"):
        listed = commits.entries(spark, f"{folder}/{COMMITS}", COMMIT_SCHEMA).filter("path is not null")
        return dated(listed.select(F.concat(F.lit(f"{folder}/"), "path").alias("path")))
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return dated(files.select(F.regexp_replace("path", PART_FILES, "$1").alias("path")).distinct())


def dated(files: DataFrame) -> DataFrame:
    return files.withColumn("snapshot_date", snapshot_date("path")).filter("snapshot_date is not null")


def newest(files: DataFrame, window_size: int = 5) -> DataFrame:
    """The ``window_size`` newest snapshots; a bounded top-n, no global sort."""
    return files.orderBy(F.col("snapshot_date").desc(), F.col("path").desc()).limit(window_size)


def freshness(files: DataFrame, as_of) -> DataFrame:
    """One row: the newest date and whether it is ``as_of`` (a date text or column)."""
    day = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    return files.agg(F.max("snapshot_date").alias("newest")).withColumn(
        "is_fresh", F.coalesce(F.col("newest") == day, F.lit(False))
    )


def read_newest(spark: SparkSession, folder: str, window_size: int = 5) -> DataFrame:
    """The rows of the newest snapshots; older files are never opened."""
    paths = [r["path"] for r in newest(manifest(spark, folder), window_size).collect()]
    if not paths:
        raise FileNotFoundError(f"no dated snapshot in {folder}")
    return spark.read.parquet(*paths)


def write_dated(df: DataFrame, folder: str, prefix: str, day, rows_per_file: int = 1_000_000) -> None:
    """One snapshot folder per value of ``day`` (a date column), in part files written by as many tasks as there are parts."""
    name = F.concat(F.lit(f"{prefix}_upto_"), F.date_format(day, "yyyy_MM_dd"), F.lit(".parquet"))
    named = df.withColumn("snapshot", name).hint("rebalance", "snapshot")
    named.write.option("maxRecordsPerFile", rows_per_file).partitionBy("snapshot").parquet(folder)
