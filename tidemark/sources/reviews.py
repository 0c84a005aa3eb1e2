"""Review logs: JSON lines in, month-partitioned Parquet out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import millis_to_timestamp, year_month
from tidemark.schemas import CORRUPT, REVIEW_SCHEMA, UNUSED_COLUMNS


def read_reviews(spark: SparkSession, *paths: str, schema: T.StructType = REVIEW_SCHEMA) -> DataFrame:
    """JSON lines with a declared schema; lines that do not parse keep their text."""
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_bad).option("columnNameOfCorruptRecord", CORRUPT).json(list(paths))


def with_month(df: DataFrame, time: str = "timestamp") -> DataFrame:
    """Add ``ts`` and ``year_month`` from epoch milliseconds."""
    ts = millis_to_timestamp(time)
    return df.withColumns({"ts": ts, "year_month": year_month(ts)})


def write_by_month(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet under year_month=; AQE evens out file sizes, splitting heavy months."""
    df.hint("rebalance", "year_month").write.mode(mode).partitionBy("year_month").parquet(path)


def training_columns(df: DataFrame) -> DataFrame:
    return df.drop(*UNUSED_COLUMNS)


def parsed_interactions(
    df: DataFrame, ts_unit: str = "milliseconds", renamed: dict[str, str] | None = None
) -> DataFrame:
    """Common form: renamed columns, UTC timestamp from the given unit, numeric rating."""
    make: dict[str, Column] = {
        "milliseconds": F.timestamp_millis(F.col("timestamp").cast("bigint")),
        "seconds": F.timestamp_seconds(F.col("timestamp").cast("bigint")),
    }
    if ts_unit not in make:
        raise ValueError(f"ts_unit is one of {sorted(make)}")
    return df.withColumnsRenamed(renamed or {}).withColumns(
        {"timestamp": make[ts_unit], "rating": F.col("rating").try_cast("double")}
    )


def with_known_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows with a NULL key; sampling keeps them otherwise."""
    return df.dropna(subset=list(keys))
