"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship

#: The white space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


#: Arrow batches of texts: a worker holds a batch several times over, as strings and as numbers.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "4000"}


def ready(spark: SparkSession) -> None:
    """Code for the workers, and small Arrow batches from now on in this session."""
    ship(spark)
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null reads as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def runs(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours that add up to about ``most``; a larger one stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``most`` bytes in each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for start, stop in runs(sizes, most):
            yield batch.slice(start, stop - start)
    pa.default_memory_pool().release_unused()  # the worker stays, for other tasks


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns.values(), schema)],
        schema=schema,
    )


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def hex_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
