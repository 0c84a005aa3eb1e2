"""Mix overlapping sources to target weights: min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD
from tidemark.session import materialize, release

#: What the driver may hold: distinct sets of sources. Beyond it the operator stops with an error.
MAX_PATTERNS = 200_000
SEED = "mix-1"
HASH_BITS, STEP_BITS = 60, 12
#: Documents of at most this part of the missing words go first: what the next one leaves open is then smaller still.
PART = 8
#: Repeated ids that are broadcast; more of them are shuffled.
SMALL = 200_000


def weighted_targets(sizes: dict, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> dict:
    """Share the sum of all sizes by weight; no target exceeds ``most`` times its source's size.

    Sources are in the order given and weigh 1, 2, 3, repeating. What a source cannot take is shared
    among the others by weight. One pass in order of size over weight does that: a source is full if
    its share of what is left would exceed its limit.
    """
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    left, shares, targets = sum(sizes.values()), sum(weight.values()), {}
    for source in sorted(sizes, key=lambda s: sizes[s] * most / weight[s]):
        if most * sizes[source] * shares <= left * weight[source]:
            targets[source] = float(most * sizes[source])
            left, shares = left - most * sizes[source], shares - weight[source]
        else:
            targets[source] = weight[source] * left / shares
    return {s: targets[s] for s in sizes}


def route(capacity: dict, members: dict, quota: dict, most: int) -> dict:
    """Words each pattern gives, at the least cost of repetition.

    Network: start -> pattern, one arc per copy, the n-th copy at cost n - 1; pattern -> each of its
    sources; source -> end with its quota. The cost of a path lies in its first arc alone, so shortest
    paths come level by level: open the next copy of every pattern, then augment until no path is left.
    """
    flow = {p: dict.fromkeys(members[p], 0) for p in capacity}
    users = {s: [p for p in members if s in members[p]] for s in quota}
    given, open_quota = dict.fromkeys(capacity, 0), dict(quota)
    for level in range(1, most + 1):
        while True:
            origin, queue, end = {}, deque(), None
            for p in capacity:
                if given[p] < level * capacity[p]:
                    origin["p", p] = None
                    queue.append(("p", p))
            while queue and end is None:
                kind, node = at = queue.popleft()
                if kind == "p":
                    step = [("s", s) for s in members[node]]
                elif open_quota[node] > 0:
                    end = at
                    break
                else:
                    step = [("p", p) for p in users[node] if flow[p][node] > 0]
                for to in step:
                    if to not in origin:
                        origin[to] = at
                        queue.append(to)
            if end is None:
                break
            path = [end]
            while origin[path[-1]] is not None:
                path.append(origin[path[-1]])
            path.reverse()
            first = path[0][1]
            room = min(level * capacity[first] - given[first], open_quota[end[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "s":
                    room = min(room, flow[b[1]][a[1]])
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1]][b[1]] += room
                else:
                    flow[b[1]][a[1]] -= room
            given[first] += room
            open_quota[end[1]] -= room
    return given


def _prefix(rows: DataFrame, rest: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Per pattern the last hash and the words of the longest run of ``rows``, in order of hash, within ``rest`` words.

    Sums over 4,096 ranges of the hash find the range where the total passes ``rest``; a second step divides that
    range again. Only the rows of the last range, one in 16 million, are ordered by hash. Rows of equal hash (one
    document repeated) go together.
    """
    spark, found = rows.sparkSession, {}
    schema = "_pattern bigint, _range bigint, _before bigint, _rest bigint"
    state = {p: (0, 0) for p in rest}  # the range, the words before it
    for step in (1, 2):
        shift = HASH_BITS - step * STEP_BITS
        # One row per pattern, at most MAX_PATTERNS.
        known = spark.createDataFrame([(p, at, before, rest[p]) for p, (at, before) in state.items()], schema)
        inside = rows.join(F.broadcast(known), "_pattern").where(F.shiftright("_hash", shift + STEP_BITS) == F.col("_range"))
        sums = inside.groupBy("_pattern", "_before", "_rest", F.shiftright("_hash", shift).alias("_bin")).agg(F.sum("_size").alias("_words"))
        order = Window.partitionBy("_pattern").orderBy("_bin")  # at most 4,096 rows
        sums = sums.withColumn("_total", F.col("_before") + F.sum("_words").over(order))
        passed = F.when(F.col("_total") > F.col("_rest"), F.col("_bin"))
        at = sums.groupBy("_pattern").agg(F.min(passed).alias("bin"), F.min_by(F.col("_total") - F.col("_words"), passed).alias("before"), F.max("_total").alias("all"))
        state = {}
        for r in at.collect():
            if r["bin"] is None:
                found[r["_pattern"]] = (1 << HASH_BITS, r["all"])
            else:
                state[r["_pattern"]] = (r["bin"], r["before"])
        if not state:
            return found
    shift = HASH_BITS - 2 * STEP_BITS
    known = spark.createDataFrame([(p, at, before, rest[p]) for p, (at, before) in state.items()], schema)
    inside = rows.join(F.broadcast(known), "_pattern").where(F.shiftright("_hash", shift) == F.col("_range"))
    sums = inside.groupBy("_pattern", "_before", "_rest", "_hash").agg(F.sum("_size").alias("_words"))
    upto = F.col("_before") + F.sum("_words").over(Window.partitionBy("_pattern").orderBy("_hash"))
    taken = sums.withColumn("_upto", upto).where(F.col("_upto") <= F.col("_rest"))
    last = {r["_pattern"]: (r["last"], r["words"]) for r in taken.groupBy("_pattern").agg(F.max("_hash").alias("last"), F.max("_upto").alias("words")).collect()}
    return found | {p: last.get(p, ((at << shift) - 1, before)) for p, (at, before) in state.items()}


PICKS = "array<struct<level:int,upto:bigint,cap:bigint>>"


def _copies(unit: Column, number: Column, full: Column, picks: Column) -> Column:
    """Copies of a document: the full ones, and one more for each pick that meets it with ``level`` copies so far."""
    return F.aggregate(picks, full, lambda n, p: n + ((n == p["level"]) & (unit <= p["cap"]) & (number <= p["upto"])).cast("int"))


def _levels(units: DataFrame, known: list[tuple]) -> DataFrame:
    """Units of the patterns in ``known`` (pattern, full copies, picks, largest size, level asked for) with the copies they have."""
    schema = f"_pattern bigint, _full int, _picks {PICKS}, _most bigint, _at int"
    few = units.sparkSession.createDataFrame(known, schema)  # one row per pattern
    same = (units["_pattern"] == few["_pattern"]) & (units["_size"] <= few["_most"])
    copies = _copies(F.col("_size"), F.col("_hash"), F.col("_full"), F.col("_picks"))
    return units.join(F.broadcast(few), same).select(units["_pattern"], "_hash", "_size", "_at", copies.alias("_level"))


def _picks(units: DataFrame, rest: dict[int, int], full: dict[int, int], most: int) -> dict[int, list[tuple[int, int, int]]]:
    """The picks that give ``rest`` more words of each pattern: (level, last hash, largest size).

    A pick takes one more copy of the documents that have ``level`` copies and no more words than its cap, in order of
    hash, until one does not fit. While there are documents of an eighth of the missing words or less, these are the ones,
    so few rounds are left. Where no document of a level fits any more, the next copy of all begins; it ends when no
    document with fewer than ``most`` copies fits.
    """
    picks: dict[int, list[tuple[int, int, int]]] = {p: [] for p in rest}
    left = {p: r for p, r in rest.items() if r > 0 and full[p] < most}
    while left:
        # What is larger than the missing words cannot be picked any more: few documents are left after the first rounds.
        known = [(p, full[p], picks[p], words, None) for p, words in left.items()]
        state = _levels(units, known)
        least: dict[int, dict[int, int]] = {}
        for r in state.where(F.col("_level") < most).groupBy("_pattern", "_level").agg(F.min("_size").alias("least")).collect():
            least.setdefault(r["_pattern"], {})[r["_level"]] = r["least"]
        caps = {}
        for p, words in list(left.items()):
            level = min((n for n, size in least.get(p, {}).items() if size <= words), default=None)
            if level is None:
                del left[p]
            else:
                caps[p] = (level, words // PART if least[p][level] <= words // PART else words)
        if not left:
            break
        fitting = materialize(_levels(units, [(p, full[p], picks[p], cap, level) for p, (level, cap) in caps.items()]).where("_level = _at").select("_pattern", "_hash", "_size"))
        for p, (last, words) in _prefix(fitting, left).items():
            picks[p].append((caps[p][0], last, caps[p][1]))
            left[p] -= words
        release(fitting)
        left = {p: r for p, r in left.items() if r > 0}
    return picks


def mix(docs: DataFrame, sources: Column, most: int = 3, seed: str = SEED) -> DataFrame:
    """All columns of ``docs`` in one struct ``row``, with ``size``, ``target`` and ``copies`` of every row.

    ``sources`` is an array: the sources a document belongs to; a null inside stands for the unnamed source,
    which comes last. Documents are counted by the set of their sources; a flow decides how many words each set
    gives; copies are whole documents, at most ``most`` of each, picked by a seeded hash of the id (of the text,
    where the id is null), so reruns agree and rows of one id share their fate. What a set of sources still lacks is
    less than the words of any document that could be taken once more. A document without words or without sources has
    0 copies, an empty table gives none. ``target`` is the sum of its sources' targets.
    """
    spark = docs.sparkSession
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    size = F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("bigint")
    key = F.coalesce(docs["doc_id"].cast("string"), F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")
    named = F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.struct(s.isNull().alias("none"), s.alias("name")))))
    counted = materialize(docs.select(size.alias("_size"), number.alias("_hash"), named.alias("_members")))
    # Rows of one id are one unit; where ids repeat, its words are those of all of them.
    units = materialize(counted.where("_size > 0").groupBy("_members", "_hash").agg(F.sum("_size").alias("_unit"), F.count(F.lit(1)).alias("_rows")))
    repeated = units.where("_rows > 1").select(F.col("_members").alias("_of"), F.col("_hash").alias("_same"), "_unit")
    sums = counted.groupBy("_members").agg(F.sum("_size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources")
    members = {i: [(m["none"], m["name"]) for m in r["_members"] or []] for i, r in enumerate(sums)}
    words = {i: int(r["words"]) for i, r in enumerate(sums)}
    sizes = {s: 0 for s in sorted({s for m in members.values() for s in m}, key=lambda s: (s[0], (s[1] or "").encode()))}
    for i, found in members.items():
        for s in found:
            sizes[s] += words[i]
    # A document of several sources counts once in the sum that is shared.
    targets = weighted_targets(sizes, most) if len(sizes) == len(members) else _overlapping(sizes, words, members, most)
    given = route(words, members, {s: int(t) for s, t in targets.items()}, most)
    full = {i: min(most, given[i] // words[i]) if words[i] else 0 for i in words}
    kinds = "_members array<struct<none:boolean,name:string>>, _pattern bigint, _full int, _target double, _source_size bigint"
    plain = [([dict(none=n, name=s) for n, s in members[i]] if r["_members"] is not None else None, i, full[i], sum((targets[s] for s in members[i]), 0.0), sum(sizes[s] for s in members[i])) for i, r in enumerate(sums)]
    # One row per set of sources, at most MAX_PATTERNS.
    patterns = spark.createDataFrame(plain, kinds)
    same = lambda a, b: a["_members"].eqNullSafe(b["_members"])
    small = units.join(F.broadcast(patterns), same(units, patterns)).select("_pattern", "_hash", F.col("_unit").alias("_size"))
    picks = _picks(small, {i: given[i] - full[i] * words[i] for i in words}, full, most)
    chosen = spark.createDataFrame([(i, picks[i]) for i in words], f"_pattern bigint, _picks {PICKS}")
    plan = patterns.join(F.broadcast(chosen), "_pattern")
    rows = docs.select(row.alias("row"), size.alias("size"), number.alias("_hash"), named.alias("_members"))
    rows = rows.join(F.broadcast(plan), same(rows, plan)).select("row", "size", "_hash", plan["_members"].alias("_members"), "_full", "_picks", "_source_size", "_target")
    found = repeated.count()
    if found:
        repeated = F.broadcast(repeated) if found <= SMALL else repeated
        rows = rows.join(repeated, (rows["_hash"] == repeated["_same"]) & rows["_members"].eqNullSafe(repeated["_of"]), "left")
    unit = F.coalesce("_unit", "size") if found else F.col("size")
    copies = F.when(F.col("size") > 0, _copies(unit, F.col("_hash"), F.col("_full"), F.col("_picks"))).otherwise(0)
    return rows.select("row", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies"))


def _overlapping(sizes: dict, words: dict, members: dict, most: int) -> dict:
    """Targets where documents may have several sources: their words are shared out once."""
    total, all_sizes = sum(w for i, w in words.items() if members[i]), sum(sizes.values())
    return {s: t * total / all_sizes if all_sizes else 0.0 for s, t in weighted_targets(sizes, most).items()}


def mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``size``, its source's ``source_size`` and ``target``, and the words ``taken``.

    Every row has the one source in ``source``; null is a source of its own.
    """
    mixed = mix(docs, F.array(docs["source"]))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def sources_mixed(docs: DataFrame) -> DataFrame:
    """Per source: its ``source_size``, ``target``, ``taken`` words, and ``room``, the words of the smallest document
    that could be taken once more."""
    mixed = mix(docs, F.array(docs["source"])).select("row.source", "size", "source_size", "target", "copies")
    open_size = F.when((F.col("copies") < 3) & (F.col("size") > 0), F.col("size"))
    return mixed.groupBy("source").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken"),
        F.min(open_size).alias("room"), F.max("copies").alias("most"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it has copies, with its own columns only."""
    mixed = mix(docs, F.array(docs["source"])).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select(*[F.col(f"row.`{c}`") for c in docs.columns])
