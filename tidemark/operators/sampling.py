"""Activity sampling and chronological splits."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordering import row_numbers
from tidemark.session import materialize, release


@dataclass(frozen=True)
class CoreSample:
    """Rows that survived, the rounds it took, and whether nothing more would go."""

    rows: DataFrame
    rounds: int
    converged: bool


def k_core(
    df: DataFrame,
    user="user_id",
    item="parent_asin",
    min_user: int = 5,
    min_item: int = 10,
    max_rounds: int | None = None,
) -> CoreSample:
    """Drop users, then items, below their interaction counts until none is.

    Runs until nothing more goes, or at most ``max_rounds`` rounds where given;
    ``converged`` then tells whether that was enough.

    The rounds run over distinct (user, item) pairs with a count. Totals per user and per item are made once; a
    round reads the pairs of the keys that go, takes them off the other side's totals, and writes the pairs that stay.
    The keys that go are a table of known size, so few of them are broadcast and the pairs are not shuffled. The full
    rows are read once at the end. Counts are interactions. Rows with a NULL key never match and stay.
    """
    pairs = materialize(df.groupBy(user, item).agg(F.count(F.lit(1)).alias("_n")))
    users, items = (materialize(pairs.groupBy(key).agg(F.sum("_n").alias("_t"))) for key in (user, item))
    rounds, converged = 0, pairs.isEmpty()
    while not converged and (max_rounds is None or rounds < max_rounds):
        few_users = _below(users, user, min_user)
        gone_users = materialize(pairs.join(few_users, user, "left_semi"))
        items = _less(items, gone_users, item)
        few_items = _below(items, item, min_item)
        after_users = pairs.join(few_users, user, "left_anti")
        gone_items = materialize(after_users.join(few_items, item, "left_semi"))
        converged, rounds = gone_users.isEmpty() and gone_items.isEmpty(), rounds + 1
        if not converged:
            users = _less(users.join(few_users, user, "left_anti"), gone_items, user)
            items = materialize(items.join(few_items, item, "left_anti"))
            earlier, pairs = pairs, materialize(after_users.join(few_items, item, "left_anti"))
            release(earlier)
    # What is left is exactly the pairs between surviving users and items.
    rows = df
    for key, kept in ((user, users), (item, items)):
        rows = rows.join(kept.select(F.col(key).alias("_kept")), df[key].eqNullSafe(F.col("_kept")), "left_semi")
    return CoreSample(rows, rounds, converged)


def _below(totals: DataFrame, key: str, least: int) -> DataFrame:
    return materialize(totals.filter((F.col("_t") < least) & F.col(key).isNotNull()).select(key))


def _less(totals: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``totals`` less the pairs that are gone, without the keys that have none left."""
    lost = gone.groupBy(F.col(key).alias("_key")).agg(F.sum("_n").alias("_lost"))
    left = totals.join(lost, F.col(key).eqNullSafe(F.col("_key")), "left")
    left = left.select(key, (F.col("_t") - F.coalesce("_lost", F.lit(0))).alias("_t"))
    return materialize(left.filter("_t > 0"))


def chronological_split(
    df: DataFrame, time: str, tie_break: list[str], train_ratio: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """First ``floor(ratio * rows)`` rows by time, and the rest. Rows without time come first.

    Finds the day, then the second, where the running count crosses the target, and
    orders only the rows of that one second. The two windows without partition run
    over at most one row per calendar day and 86,400 seconds.
    """
    total = df.count()
    target = int(total * train_ratio)
    if target <= 0 or target >= total:
        nothing = df.limit(0)
        return (df, nothing) if target > 0 else (nothing, df)
    second = F.unix_seconds(time)

    def crossing(rows: DataFrame, unit, already: int):
        running = Window.orderBy("_unit").rowsBetween(Window.unboundedPreceding, 0)
        counts = rows.groupBy(unit.alias("_unit")).agg(F.count(F.lit(1)).alias("_n"))
        summed = counts.withColumn("_cum", F.sum("_n").over(running) + already)
        hit = summed.filter(F.col("_cum") >= target).orderBy("_unit").first()
        return hit["_unit"], hit["_cum"] - hit["_n"]

    day, before_day = crossing(df, F.to_date(time), 0)
    if day is None:  # rows without time fill the first part
        placed = row_numbers(df.filter(F.col(time).isNull()), [F.col(c) for c in tie_break], "_row_id")
        train = placed.filter(F.col("_row_id") <= target).drop("_row_id")
        rest = placed.filter(F.col("_row_id") > target).drop("_row_id")
        return train, df.filter(F.col(time).isNotNull()).unionByName(rest)
    cut, before = crossing(df.filter(F.to_date(time) == F.lit(day)), second, before_day)
    at = F.timestamp_seconds(F.lit(cut))
    after = F.timestamp_seconds(F.lit(cut + 1))
    edge = df.filter((F.col(time) >= at) & (F.col(time) < after))
    placed = row_numbers(edge, [F.col(c) for c in [time, *tie_break]], "_row_id")
    need = target - before
    train = df.filter((F.col(time) < at) | F.col(time).isNull()).unionByName(placed.filter(F.col("_row_id") <= need).drop("_row_id"))
    val = df.filter(F.col(time) >= after).unionByName(placed.filter(F.col("_row_id") > need).drop("_row_id"))
    return train, val


def warm_rows(val: DataFrame, train: DataFrame, user="user_id", item="parent_asin") -> DataFrame:
    """Validation rows whose user and item both occur in training."""
    # Distinct keys combine before the shuffle: a hot key is one row on the right.
    for key in (user, item):
        val = val.join(train.select(key).distinct(), key, "left_semi")
    return val


def cold_start(everything: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Distinct keys that training never saw."""
    return everything.select(key).subtract(train.select(key).distinct())


def cutoff_split(df: DataFrame, train: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """Split before / from one second after the newest training row."""
    newest = train.agg((F.max(time) + F.expr("interval 1 second")).alias("cut"))
    return df.filter(F.col(time) < newest.scalar()), df.filter(F.col(time) >= newest.scalar())


def hashed_holdout(df: DataFrame, keys: list[str], holdout: float = 0.1, seed: int = 42) -> DataFrame:
    """Add ``is_holdout``: a fixed share of rows by key hash, the same on every run."""
    return df.withColumn("is_holdout", hash_share(keys, seed) < F.lit(holdout))


def hash_share(keys: list[str], seed: int):
    """A number in [0, 1) from the first 60 bits of an MD5 over the keys and seed."""
    return hash_bits(keys, seed) / F.lit(float(1 << 60))


def hash_bits(keys: list, seed: int):
    """60 hash bits as BIGINT. MD5, so any engine can repeat the draw."""
    text = F.concat_ws("|", *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def shuffled(df: DataFrame, keys: list[str], seed: int) -> DataFrame:
    """Seeded global order that does not depend on partitioning."""
    return df.orderBy(hash_bits(keys, seed), *keys)


def overview(df: DataFrame, user="user_id", item="parent_asin", time="timestamp") -> DataFrame:
    """Rows, newest time and approximate numbers of users and items, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(time).alias("newest"),
        F.approx_count_distinct(user, 0.02).alias("users"),
        F.approx_count_distinct(item, 0.02).alias("items"),
    )


def approximate_rows(df: DataFrame, share: float = 0.01, seed: int = 42) -> DataFrame:
    """Row count estimated from a sample, for a quick look between long steps."""
    return df.sample(share, seed).agg((F.count(F.lit(1)) / share).cast("bigint").alias("n_rows"))
