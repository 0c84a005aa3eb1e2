"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``comp``, the smallest id it reaches, of every id in ``links`` (``a``, ``b``, both BIGINT).

    Large and small stars in turn: every id's larger neighbours move to its smallest neighbour, then all smaller ones
    do. Links shrink to one star per component in a number of rounds that grows with the logarithm of the longest path.
    Least neighbours are combined before the shuffle and written out, so the join back to the links of a hub has a
    table on either side and its skewed partition can be split. Links of an id with itself are ignored, null ends too.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialize(ordered.distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select("b", "a"))
        least = materialize(both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m")))
        # (v, m(u)) for each larger neighbour v of u; now holds exactly the pairs larger, smaller.
        large = now.join(least, now["b"] == least["u"]).select("a", F.col("m").alias("b")).distinct()
        large = materialize(large)
        least = materialize(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")))
        small = large.join(least, large["a"] == least["u"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.union(least.select("u", "m")).distinct())
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct())
