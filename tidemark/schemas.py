"""Declared schemas of the datasets, and feature view descriptors."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField(
            "images",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("small_image_url", T.StringType()),
                        T.StructField("medium_image_url", T.StringType()),
                        T.StructField("large_image_url", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
ITEM_SCHEMA = T.StructType(
    [
        T.StructField("parent_asin", T.StringType()),
        T.StructField("main_category", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("price", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("image", T.StringType()),
    ]
)
# Columns of the raw reviews that training does not use.
UNUSED_COLUMNS = ["asin", "helpful_vote", "images", "text", "title", "verified_purchase", "ts"]


@dataclass(frozen=True)
class FeatureView:
    """A table of feature rows: one per (key, time), valid for ``ttl``."""

    name: str
    key: str
    fields: tuple[str, ...]
    ttl: timedelta
    time: str = "timestamp"
    tags: dict = field(default_factory=dict, hash=False)

    def rows(self, table: DataFrame) -> DataFrame:
        return table.select(self.key, self.time, *self.fields)

    def live(self, table: DataFrame, as_of) -> DataFrame:
        """Rows not older than the time to live at ``as_of`` (a column or timestamp text)."""
        moment = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("timestamp")
        seconds = int(self.ttl.total_seconds())
        oldest = F.unix_micros(moment) - seconds * 1_000_000
        at = F.unix_micros(self.time)
        return self.rows(table).filter((at >= oldest) & (F.col(self.time) <= moment))


_ITEM_FIELDS = tuple(
    f"parent_asin_rating_{stat}_{days}d" for days in (365, 90, 30, 7) for stat in ("cnt", "avg_prev_rating")
)
_USER_FIELDS = (
    "user_rating_cnt_90d",
    "user_rating_avg_prev_rating_90d",
    "user_rating_list_10_recent_asin",
    "user_rating_list_10_recent_asin_timestamp",
)
LONG, FRESH = timedelta(days=10000), timedelta(days=1)
ITEM_VIEW = FeatureView("parent_asin_rating_stats", "parent_asin", _ITEM_FIELDS, LONG)
ITEM_FRESH_VIEW = FeatureView("parent_asin_rating_stats_fresh", "parent_asin", _ITEM_FIELDS, FRESH)
USER_VIEW = FeatureView("user_rating_stats", "user_id", _USER_FIELDS, LONG)
USER_FRESH_VIEW = FeatureView("user_rating_stats_fresh", "user_id", _USER_FIELDS, FRESH)


def require_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` cast to ``schema``; a missing column or another type family fails here."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
