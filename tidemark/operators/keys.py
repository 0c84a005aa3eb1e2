"""Key handling: deduplication, uniqueness, id maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import row_numbers

UNKNOWN_ITEM = "unknown_item"
UNKNOWN_USER = "unknown_user"


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order_by`` (a fixed choice, unlike dropDuplicates).

    A grouped ``min`` of structs combines before the shuffle, so a key with very
    many copies is reduced to one row per task first.
    """
    rest = list(order_by) + [c for c in df.columns if c not in keys and c not in order_by]
    if not rest:
        return df.select(*keys).distinct()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return smallest.select(*keys, "_row.*").select(*df.columns)


def uniqueness_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def many_to_one_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails unless ``right`` is unique on ``keys``."""
    if not uniqueness_violations(right, keys).isEmpty():
        raise ValueError(f"right side is not unique on {list(keys)}")
    return left.join(right, list(keys), "left")


def one_to_one_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join that fails unless both sides are unique on ``keys``."""
    for side in (left, right):
        if not uniqueness_violations(side, keys).isEmpty():
            raise ValueError(f"a side is not unique on {list(keys)}")
    return left.join(right, list(keys), "inner")


def fit_id_map(df: DataFrame, key: str, index: str) -> DataFrame:
    """Sorted distinct keys numbered 0..n-1, as a two-column table to save and join."""
    known = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return row_numbers(known, [F.col(key)], index).withColumn(index, F.col(index) - 1)


def to_index(df: DataFrame, id_map: DataFrame, key: str, index: str) -> DataFrame:
    """Add the dense index; unknown and NULL keys get n, the size of the map."""
    size = id_map.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.join(id_map, key, "left").withColumn(index, F.coalesce(F.col(index), size))


def to_key(df: DataFrame, id_map: DataFrame, key: str, index: str, unknown: str) -> DataFrame:
    """Add the original key of a dense index, ``unknown`` where there is none."""
    found: Column = F.coalesce(F.col(key), F.lit(unknown))
    return df.join(id_map, index, "left").withColumn(key, found)
