"""Leakage-free rolling statistics, recent-item lists and history sequences."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.slices import HOT_ROWS, SLICE, hot_key_grid, key_rows, tasks_for, with_carry, with_slices

DAY = 86_400


@dataclass(frozen=True)
class Rolling:
    """One output column over the last ``seconds``.

    ``count`` and ``mean`` leave out the current second; ``count_now`` counts the
    current second and all its peers.
    """

    name: str
    seconds: int
    kind: str


ITEM_MEASURES = [
    measure
    for days in (365, 90, 30, 7)
    for measure in (
        Rolling(f"parent_asin_rating_cnt_{days}d", days * DAY, "count"),
        Rolling(f"parent_asin_rating_avg_prev_rating_{days}d", days * DAY, "mean"),
    )
]
USER_MEASURES = [
    Rolling("user_rating_cnt_90d", 90 * DAY, "count_now"),
    Rolling("user_rating_avg_prev_rating_90d", 90 * DAY, "mean"),
]


#: Bits of a value that one running sum holds: sums stay whole numbers for 2 ** 39 rows of a key.
BIN_BITS = 24


def _lowest_bit(number: Column) -> Column:
    """The power of two of the last bit of a finite double other than 0."""
    unit = F.greatest(F.round(F.log2(F.abs(number))) - 54, F.lit(-1074.0))
    whole = (number / F.pow(F.lit(2.0), unit)).cast("bigint")
    return unit + F.round(F.log2(whole.bitwiseAND(-whole).cast("double")))


def _bins(number: Column, low: int, high: int) -> tuple[list[Column], list[float]]:
    """Whole numbers and their units, which add up to the value without rounding.

    All values are multiples of 2 ** low and below 2 ** high. What a unit takes is the value rounded to it, less
    what the next larger unit took; a value far above a unit has nothing left for it.
    """
    units = [2.0**p for p in range(low, high, BIN_BITS)]
    taken = [F.rint(number / u) for u in units]
    parts = []
    for i, u in enumerate(units):
        part = taken[i] if i + 1 == len(units) else taken[i] - taken[i + 1] * 2.0**BIN_BITS
        most = u * 2.0**100 if u < 2.0**900 else float("inf")
        parts.append(F.when(F.abs(number) < most, part).otherwise(F.when(number.isNotNull(), 0.0)).cast("bigint"))
    return parts, units


def rolling_stats(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    measures: list[Rolling],
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rolling counts and means per distinct (key, time), copies of a row counted once.

    Each event enters the totals at its own second and leaves them once a span has
    passed, so every row costs one step of a running sum. A sliding frame would
    add up the whole span again at every row.

    What leaves must cancel exactly, so a value is added up as whole numbers of 24 bits each, one for every range of
    powers of two that the values have; small whole ratings need one. Sums are exact at any size of the values, and a
    mean is rounded as its largest parts are added. NaN and infinities are counted and decide a mean only while they
    are inside its span.
    """
    spans = sorted({m.seconds for m in measures})
    second = F.unix_seconds(F.col(time))
    marks = [F.struct(second.alias("at"), F.lit(0).cast("bigint").alias("span"))] + [
        F.struct((second + span).alias("at"), F.lit(span).cast("bigint").alias("span"))
        for span in spans
    ]
    number = F.col(value).cast("double")
    finite = F.abs(number) < F.lit(float("inf"))
    bits = F.when(finite & (number != 0), number)
    # One job: rows of the largest key, and the powers of two between which all values lie.
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.min(_lowest_bit(bits)).alias("low"), F.max(F.abs(bits)).alias("high")
    )
    found = per_key.agg(
        F.max("rows").alias("rows"), F.sum("rows").alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    ).first()
    tasks = tasks_for(df, found["total"] or 0)
    grid = None
    if (found["rows"] or 0) > max_rows:
        grid = hot_key_grid(df.select(key, second.alias("_at")), key, "_at", max_rows, (0, *spans))
    # Move each row once, before copies go and before it is multiplied into marks: without
    # hot keys all that follows stays within the tasks of their key, of bounded size.
    rows = df.repartition(tasks, key).distinct() if grid is None else df.distinct()
    parts, units = [], []
    if found["low"] is not None:
        parts, units = _bins(F.when(finite, number), int(found["low"]), math.frexp(found["high"])[1])
    bins = [f"_b{i}" for i in range(len(units))]
    stats = {
        "_c": F.count(F.lit(1)), "_n": F.count(value), **{n: F.sum(p) for n, p in zip(bins, parts)},
        "_nan": F.count(F.when(F.isnan(number), 1)),
        "_up": F.count(F.when(number == float("inf"), 1)), "_down": F.count(F.when(number == float("-inf"), 1)),
    }
    seen = rows.groupBy(key, time).agg(*[F.coalesce(s, F.lit(0)).alias(n) for n, s in stats.items()])
    moves = seen.select(key, time, F.explode(F.array(*marks)).alias("_m"), *stats)
    moves = moves.select(key, time, F.col("_m.at").alias("_at"), F.col("_m.span").alias("_span"), *stats)
    group = [key]
    if grid is not None:
        moves = with_slices(moves, grid, key, "_at").repartition(tasks, key, SLICE)
        group = [key, SLICE]

    entered = F.col("_span") == 0

    def change(stat: str, span: int) -> Column:
        left = F.when(F.col("_span") == span, -F.col(stat))
        return F.when(entered, F.col(stat)).otherwise(F.coalesce(left, F.lit(0)))

    needed: dict[str, Column] = {}
    for m in measures:
        for stat in ["_n", *bins, "_nan", "_up", "_down"] if m.kind == "mean" else ["_c"]:
            needed[f"{stat}_{m.seconds}"] = change(stat, m.seconds)
    order = Window.partitionBy(*group).orderBy("_at")
    earlier = order.rangeBetween(Window.unboundedPreceding, -1)
    same_second = order.rangeBetween(0, 0)
    totals = {f"_t{n}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for n, c in needed.items()}
    if any(m.kind == "count_now" for m in measures):
        totals["_now"] = F.sum(F.when(entered, F.col("_c"))).over(same_second)
    rolled = moves.withColumns(totals).filter(entered)

    if grid is not None:
        sums = moves.filter("_hot").groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in needed.items()])
        before = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carry = sums.select(*group, *[F.sum(n).over(before).alias(f"_was{n}") for n in needed])
        rolled = with_carry(rolled, carry, key).withColumns(
            {f"_t{n}": F.col(f"_t{n}") + F.coalesce(f"_was{n}", F.lit(0)) for n in needed}
        )

    def result(m: Rolling) -> Column:
        if m.kind == "count":
            out = F.col(f"_t_c_{m.seconds}")
        elif m.kind == "count_now":
            out = F.col(f"_t_c_{m.seconds}") + F.col("_now")
        else:
            known, nan, up, down = (F.col(f"_t{s}_{m.seconds}") for s in ("_n", "_nan", "_up", "_down"))
            total = F.lit(0.0)
            for name, unit in reversed(list(zip(bins, units))):
                total = total + F.col(f"_t{name}_{m.seconds}").cast("double") * unit
            finite = total / known
            odd = F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan")).when(up > 0, float("inf")).when(down > 0, float("-inf"))
            out = F.when(known > 0, F.coalesce(odd, finite))
        return out.alias(m.name)

    return rolled.select(key, time, *[result(m) for m in measures])


def item_window_stats(
    df: DataFrame, item="parent_asin", time="timestamp", rating="rating", max_rows=HOT_ROWS
) -> DataFrame:
    """Item rating count and mean over the previous 365, 90, 30 and 7 days."""
    return rolling_stats(df, item, time, rating, ITEM_MEASURES, max_rows)


def user_window_stats(
    df: DataFrame, user="user_id", time="timestamp", rating="rating", max_rows=HOT_ROWS
) -> DataFrame:
    """User 90-day count (current second included) and mean of earlier ratings."""
    return rolling_stats(df, user, time, rating, USER_MEASURES, max_rows)


def hot_users(df: DataFrame, user: str, time: str, order: list[str], max_rows: int) -> DataFrame | None:
    """The grid of hot users over (time, *order); without ``order`` rows of one time stay together."""
    return hot_key_grid(df.select(user, _place(time, order).alias("_at")), user, "_at", max_rows)


def _place(time: str, order: list[str]) -> Column:
    return F.struct(F.unix_micros(F.col(time)).alias("at"), *[F.col(c).alias(f"by{i}") for i, c in enumerate(order)])


def previous_entries(
    rows: DataFrame,
    user: str,
    time: str,
    order: list[str],
    entry: Column,
    n: int,
    grid: DataFrame | None,
    ties: list[str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Add ``_previous``: the last ``n`` entries before each row in (time, *order).

    ``grid`` slices the hot users by (time, *ties), with ``ties`` a beginning of ``order``, all of it by default.
    """
    rows = rows.withColumn("_entry", entry)
    group = [user]
    if grid is not None:
        place = _place(time, order if ties is None else ties)
        rows = with_slices(rows.withColumn("_at", place), grid, user, "_at").drop("_at")
        group = [user, SLICE]
    window = Window.partitionBy(*group).orderBy(time, *order)
    out = rows.withColumn("_previous", F.collect_list("_entry").over(window.rowsBetween(-n, -1)))
    if grid is not None:
        # Every slice holds at least one row, so the n slices before it reach back n rows.
        backwards = Window.partitionBy(*group).orderBy(F.col(time).desc(), *[F.col(c).desc() for c in order])
        tails = (
            rows.filter("_hot")
            .withColumn("_rank", F.row_number().over(backwards))
            .filter(F.col("_rank") <= n)
            .groupBy(*group)
            .agg(F.sort_array(F.collect_list(F.struct((-F.col("_rank")).alias("r"), "_entry"))).alias("_tail"))
        )
        earlier = Window.partitionBy(user).orderBy(SLICE).rowsBetween(-n, -1)
        carry = tails.select(
            *group,
            F.transform(F.flatten(F.collect_list("_tail").over(earlier)), lambda x: x["_entry"]).alias("_carry"),
        )
        both = F.concat(F.col("_carry"), F.col("_previous"))
        out = (
            with_carry(out, carry, user)
            .withColumn("_previous", F.when(F.col("_carry").isNull(), F.col("_previous")).otherwise(last_n(both, n)))
            .drop("_carry", "_hot")
        )
    return out.drop("_entry"), group


def last_n(array: Column, n: int) -> Column:
    """The last ``n`` entries of an array (all of them when it is shorter)."""
    return F.slice(array, F.greatest(F.size(array) - (n - 1), F.lit(1)), n)


def recent_items(
    df: DataFrame,
    user="user_id",
    item="parent_asin",
    time="timestamp",
    rating="rating",
    n: int = 10,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Last ``n`` items before each (user, time), as arrays and as joined strings.

    Rows of the same time see each other in (item, rating) order; of the rows that
    share (user, time) the one with the longest list stays. The strings are NULL,
    not empty, when there is no earlier item.
    """
    largest, total = key_rows(df, user)
    grid = hot_users(df, user, time, [item, rating], max_rows) if largest > max_rows else None
    # Without hot users rows move to their user once, in tasks of bounded size; copies go there, and the window stays there.
    rows = df.select(user, time, item, rating)
    rows = rows.repartition(tasks_for(df, total), user).distinct() if grid is None else rows.distinct()
    entry = F.struct(F.col(item).alias("item"), F.unix_seconds(time).alias("at"))
    listed, group = previous_entries(rows, user, time, [item, rating], entry, n, grid)
    kept = listed
    # A time that is cut has a longest list in each of its slices; the second pass sees only those.
    for by in (group, [user]) if grid is not None else (group,):
        longest = Window.partitionBy(*by, time).orderBy(F.size("_previous").desc(), item, rating)
        kept = kept.withColumn("dedup_rn", F.row_number().over(longest)).filter("dedup_rn = 1")
    items = F.transform("_previous", lambda x: x["item"])
    times = F.transform("_previous", lambda x: x["at"])
    text = lambda a: F.nullif(F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit(""))
    return kept.select(
        user,
        time,
        items.alias("recent_items"),
        times.alias("recent_times"),
        text(items).alias("user_rating_list_10_recent_asin"),
        text(times).alias("user_rating_list_10_recent_asin_timestamp"),
        "dedup_rn",
    )


def user_features(df: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """The user feature view: rolling statistics next to the recent-item lists."""
    stats = user_window_stats(df, max_rows=max_rows)
    lists = recent_items(df, max_rows=max_rows)
    keys = ["user_id", "timestamp"]
    # Both have one row for each (user, time), and both stand with their user in the same tasks: put one below the other
    # they meet there, and the wide lists are not shuffled again as a join would do.
    values = [c for x in (stats, lists) for c in x.columns if c not in keys]
    both = stats.unionByName(lists, allowMissingColumns=True).filter("user_id IS NOT NULL AND timestamp IS NOT NULL")
    return both.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def history_sequences(
    df: DataFrame,
    user="user_id",
    item="item_indice",
    time="timestamp",
    n: int = 10,
    pad: int | None = -1,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Items strictly before each row, last ``n``, left-padded with ``pad``.

    Rows of one time all take the list of the first of them, which is exactly what
    came strictly earlier.
    """
    grid = hot_users(df, user, time, [], max_rows)  # rows of one time share a list, so they stay together
    listed, group = previous_entries(df, user, time, [item], F.col(item), n, grid, ties=[])
    tied = Window.partitionBy(*group, time).orderBy(item)
    sequence = F.first("_previous").over(tied)
    out = listed.withColumn("item_sequence", sequence).drop("_previous", SLICE)
    if pad is None:
        return out
    return out.withColumn("item_sequence", left_pad(F.col("item_sequence"), n, pad))


def left_pad(array: Column, n: int, pad: int) -> Column:
    """Exactly ``n`` entries: the last ``n``, or ``pad`` on the left. NULL is all ``pad``."""
    known = F.coalesce(array, F.array().cast("array<bigint>")).cast("array<bigint>")
    kept = last_n(known, n)
    return F.concat(F.array_repeat(F.lit(pad).cast("bigint"), n - F.size(kept)), kept)


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """Newest row per key; combines before the shuffle, so hot keys cost nothing extra."""
    rest = [c for c in df.columns if c != key]
    newest = df.groupBy(key).agg(F.max_by(F.struct(*rest), time).alias("_row"))
    return newest.select(key, "_row.*")
