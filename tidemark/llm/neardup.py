"""Near-duplicate documents: MinHash with tensored banding, confirmed on full shingle sets.

Two collections of ``BANDS`` bands of ``ROWS`` minhashes each give ``BANDS`` squared tables: the key of table (i, j) is
band i of the first collection with band j of the second. So 2 * BANDS * ROWS minhashes do what BANDS**2 * 2 * ROWS would
do otherwise. A pair of similarity s meets in some table with probability (1 - (1 - s**ROWS)**BANDS)**2: it is missed
with a chance of 5e-5 at 0.75 and 1e-6 at 0.8. The tables are formed only where they can matter: documents are dealt by
their first bands, and the second bands are looked at inside buckets that still hold more than one class.

Pairs of a bucket are never listed. First every diagonal table (i, i) links its members to one of them. Classes follow
from the confirmed links, and only buckets of several classes are looked at again, across classes, in blocks of bounded size.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, runs, small_batches
from tidemark.llm.graph import components
from tidemark.session import materialize

#: Words of a shingle; the least similarity in hundredths; the shape of both collections.
SHINGLE, LEAST, BANDS, ROWS = 5, 75, 28, 4
#: Minhashes of all 224 that a candidate pair must share, by their lowest 8 bits. A pair of similarity 0.75
#: shares 168 on average, and fewer than 135 with a chance below 1e-6; at 0.5 one in 500 shares as many.
SHARED = 135
#: Members of a block that are compared with another block in one step.
BLOCK = 128
#: Ids up to which a list of documents is broadcast instead of shuffling the texts.
BROADCAST_IDS = 2_000_000



def _mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of each number over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _constants():
    """Random numbers of the byte and band hashes, from one seed."""
    rng = np.random.default_rng(20240229)
    byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    byte[ord("A") : ord("Z") + 1] = byte[ord("a") : ord("z") + 1]
    gap = np.zeros(256, dtype=bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    factors = rng.integers(0, 1 << 32, 2 * BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    offsets = rng.integers(0, 1 << 32, 2 * BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
    return byte, gap, factors[:, None], offsets[:, None]


STEP = np.uint64(0x9E3779B97F4A7C15 | 1)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of UTF-8 text with A-Z as a-z, and the byte where it begins."""
    byte, gap, _, _ = _constants()
    raw = np.frombuffer(data, np.uint8)
    inside = ~gap[raw]
    edges = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    power = np.full(int(lengths.max()), STEP)
    power[0] = 1
    power = np.multiply.accumulate(power)
    at = np.flatnonzero(inside)
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    sums = np.add.reduceat(byte[raw[at]] * power[place], np.cumsum(lengths) - lengths)
    return _mix(sums ^ (lengths.astype(np.uint64) * STEP)), starts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    found: list[np.ndarray] = []
    joined = b"\n".join(texts)
    words, starts = word_hashes(joined)
    bounds = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE if len(rolled) else 0):
        rolled = _mix(rolled * STEP + words[k : k + len(rolled)])
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= SHINGLE:
            found.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            short = np.uint64(b - a)
            for w in words[a:b]:
                short = _mix(np.array([short * STEP + w]))[0]
            found.append(np.array([short]))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def band_keys(shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The 2 * BANDS band keys of a set that is not empty, and the lowest 8 bits of each minhash."""
    _, _, factors, offsets = _constants()
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(short), 4096):
        np.minimum(least, (short[None, a : a + 4096] * factors + offsets).min(axis=1), out=least)
    low = _mix(least.astype(np.uint64)).astype(np.uint8).tobytes()
    bands = least.reshape(2 * BANDS, ROWS).astype(np.uint64)
    key = np.zeros(2 * BANDS, np.uint64)
    for r in range(ROWS):
        key = _mix(key * STEP + bands[:, r])
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32), low


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b or b"" for b in batch.column("_bytes").to_pylist()]


def _chunks(batches, most: int = 1 << 20):
    """Batches in runs of about a megabyte of text; one text alone may be longer."""
    for batch in small_batches(batches, "_bytes", 16 << 20):
        texts = _texts(batch)
        for a, b in runs([len(t) + 1 for t in texts], most):
            yield batch.slice(a, b - a), texts[a:b]


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, number of shingles ``n``, two checks ``s1`` and ``s2`` of the whole set, the bands ``u`` and ``v``, and a byte of each minhash."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("u", pa.list_(pa.int32())), ("v", pa.list_(pa.int32())), ("low", pa.binary())])

    def sign(batches):
        with np.errstate(over="ignore"):
            for batch, texts in _chunks(batches):
                sets = shingle_sets(texts)
                bands = [band_keys(s) if len(s) else (np.zeros(0, np.int32), b"") for s in sets]
                yield batch_of(
                    {
                        "id": batch.column("_id"),
                        "n": [len(s) for s in sets],
                        "s1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                        "s2": np.array([_mix(s ^ STEP).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
                        "u": [b[:BANDS] for b, _ in bands],
                        "v": [b[BANDS:] for b, _ in bands],
                        "low": [low for _, low in bands],
                    },
                    schema,
                )

    named = docs.select(docs[key].cast("bigint").alias("_id"), docs[text].cast("binary").alias("_bytes"))
    return named.mapInArrow(sign, "id bigint, n bigint, s1 bigint, s2 bigint, u array<int>, v array<int>, low binary")


def sets_of(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """``id`` and the sorted 64-bit shingles of the wanted ids, as bytes. ``wanted`` has distinct ids in ``id``.

    A list of up to BROADCAST_IDS ids is broadcast (16 MB); beyond that the texts are shuffled to the ids.
    """
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def build(batches):
        with np.errstate(over="ignore"):
            for batch, texts in _chunks(batches):
                yield batch_of({"id": batch.column("_id"), "shingles": [s.tobytes() for s in shingle_sets(texts)]}, schema)

    wanted = wanted.select(F.col("id").alias("_id"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    named = docs.select(docs[key].cast("bigint").alias("_id"), docs[text].cast("binary").alias("_bytes"))
    return named.join(wanted, "_id", "left_semi").mapInArrow(build, "id bigint, shingles binary")


def similar(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Pairs of positions whose sets have 100 * intersection >= LEAST * union.

    Only shingles on both sides count; 8,192 of them at a time become columns of two 0/1 matrices.
    """
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    both = np.intersect1d(np.unique(np.concatenate(left)), np.unique(np.concatenate(right)), assume_unique=True)
    shared = np.zeros((len(left), len(right)), np.float64)
    kept = [[s[np.isin(s, both, assume_unique=True)] for s in side] for side in (left, right)]
    for a in range(0, len(both), 8192):
        part = both[a : a + 8192]
        marks = []
        for side in kept:
            mark = np.zeros((len(side), len(part)), np.float32)
            for i, s in enumerate(side):
                lo, hi = np.searchsorted(s, part[0]), np.searchsorted(s, part[-1], "right")
                mark[i, np.searchsorted(part, s[lo:hi])] = 1
            marks.append(mark)
        shared += marks[0] @ marks[1].T
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return np.argwhere(100 * shared >= LEAST * union)


def confirmed(tests: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` among rows of one ``task``: side 0 against side 1, side 2 among itself, on full sets.

    ``tests`` has ``task``, ``side``, ``id`` and the class ``comp``; links inside a class are known and not repeated.
    The tasks are bounded blocks. Each is read in one piece after a sort, side 0 first, and side 1 streams past it.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches):
        task, left, right, alone = None, [], [], False
        links: list[tuple[int, int]] = []

        def test():
            nonlocal right
            others = left if alone else right
            if left and others:
                for i, j in similar([s for *_, s in left], [s for *_, s in others]):
                    if left[i][1] != others[j][1] and not (alone and i >= j):
                        links.append((left[i][0], others[j][0]))
            right = []

        for batch in batches:
            for at, side, doc, comp, shingles in zip(*(batch.column(c).to_pylist() for c in ("task", "side", "id", "comp")), batch.column("shingles")):
                if at != task:
                    test()
                    task, left, alone = at, [], side == 2
                (right if side == 1 else left).append((doc, comp, np.frombuffer(shingles.as_buffer(), np.uint64)))
                if len(right) >= BLOCK:
                    test()
            if links:
                yield batch_of({"a": [x for x, _ in links], "b": [y for _, y in links]}, schema)
                links.clear()
        test()
        if links:
            yield batch_of({"a": [x for x, _ in links], "b": [y for _, y in links]}, schema)

    rows = tests.join(sets, "id").select("task", "side", "id", "comp", "shingles")
    return rows.repartition("task").sortWithinPartitions("task", "side").mapInArrow(compare, "a bigint, b bigint")


def _blocks(n) -> F.Column:
    return F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")


def _block_of(name: str, n) -> F.Column:
    return F.pmod(F.xxhash64(F.col(name), F.lit(5)), n).cast("int")


def _diagonal_tests(shared: DataFrame) -> DataFrame:
    """Tests of every diagonal table's members against the one of lowest priority, in blocks.

    Priorities are a hash, the same in all tables, so few documents serve as centres.
    """
    keys = ["i", "uk", "vk"]
    tables = shared.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("id"), "id")).alias("first"))
    tables = tables.where("n > 1").select(*keys, F.col("first.id").alias("center"))
    pairs = shared.join(tables, keys).where("id <> center").select("center", "id").distinct()
    pairs = materialize(pairs)
    counts = pairs.groupBy("center").agg(F.count(F.lit(1)).alias("n"))
    placed = pairs.join(counts, "center").withColumn("block", _block_of("id", _blocks(F.col("n"))))
    members = placed.select(F.concat_ws(":", "center", "block").alias("task"), F.lit(1).alias("side"), "id")
    centers = counts.select(F.explode(F.sequence(F.lit(0), _blocks(F.col("n")) - 1)).alias("block"), F.col("center").alias("id"))
    tests = members.unionByName(centers.select(F.concat_ws(":", "id", "block").alias("task"), F.lit(0).alias("side"), "id"))
    return tests.withColumn("comp", F.col("id"))


def _crossing_tests(shared: DataFrame, reps: DataFrame, classes: DataFrame) -> DataFrame:
    """Tests of documents that share a table with a document of another class.

    Buckets of the first bands that hold several classes are looked at again: small ones as they are. In the others
    the largest class is one side, all other members are the other; blocks of both are compared, and blocks of the
    others among themselves, never the largest class with itself. Members of two blocks meet in a table if they also
    share a second band; they are a candidate if they share SHARED minhashes and neither set is too small for the
    other. Each pair counts in its first bucket. Only members with a candidate go on to be compared on full sets.
    """
    classed = materialize(shared.join(classes, "id", "left").select("i", "uk", "id", F.coalesce("comp", "id").alias("comp")))
    per_class = classed.groupBy("i", "uk", "comp").agg(F.count(F.lit(1)).alias("c"))
    buckets = per_class.groupBy("i", "uk").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("k"), F.max(F.struct("c", "comp")).alias("top")
    ).where("k > 1").select("i", "uk", (F.col("n") <= BLOCK).alias("small"), F.col("top.comp").alias("top"), _blocks(F.col("top.c")).alias("nm"), _blocks(F.col("n") - F.col("top.c")).alias("nr"))
    placed = classed.join(buckets, ["i", "uk"]).withColumn("major", F.col("comp") == F.col("top"))
    placed = placed.withColumn("block", F.when(F.col("major"), _block_of("id", F.col("nm"))).otherwise(_block_of("id", F.col("nr"))))
    # Blocks of the others: against blocks of the largest class ("m"), against each other ("r"); side 2 is compared with itself.
    task = lambda kind, a, b, side: F.struct(F.lit(kind).alias("kind"), a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(side).alias("side"))
    block, zero = F.col("block"), F.lit(0)
    numbers = lambda n: F.sequence(zero, F.col(n) - 1)
    whole = F.array(task("s", zero, zero, 2))
    as_major = F.transform(numbers("nr"), lambda b: task("m", b, block, 1))
    against_major = F.transform(numbers("nm"), lambda m: task("m", block, m, 0))
    against_rest = F.transform(numbers("nr"), lambda b: F.when(b == block, task("r", block, block, 2)).when(b > block, task("r", block, b, 0)).otherwise(task("r", b, block, 1)))
    roles = F.when(F.col("small"), whole).when(F.col("major"), as_major).otherwise(F.concat(against_major, against_rest))
    own = ["id", "i", "comp", "n", "u", "v", "low"]
    members = placed.join(reps.select("id", "n", "u", "v", "low"), "id").select("uk", *own, F.explode(roles).alias("role"))
    columns = ["task", "side", *own]
    rows = members.select(F.concat_ws(":", "i", "uk", "role.kind", "role.a", "role.b").alias("task"), "role.side", *own)
    schema = pa.schema([("task", pa.string()), ("side", pa.int32()), ("id", pa.int64()), ("comp", pa.int64())])

    def meet(batches):
        task, left, right, alone, kept = None, [], [], False, {}
        found: list[tuple[str, int, int, int]] = []

        def side(rows):
            ids, bucket, comps, sizes, u, v, low = zip(*rows)
            return np.array(ids), bucket[0], np.array(comps), np.array(sizes), np.stack(u), np.stack(v), np.frombuffer(b"".join(low), np.uint8).reshape(len(low), -1)

        def test():
            nonlocal right
            if left and (right or alone):
                a = side(left)
                b = a if alone else side(right)
                same = a[4][:, None, :] == b[4][None, :, :]
                good = (same.argmax(axis=2) == a[1]) & (a[2][:, None] != b[2][None, :])
                good &= (a[5][:, None, :] == b[5][None, :, :]).any(axis=2)
                good &= (a[6][:, None, :] == b[6][None, :, :]).sum(axis=2) >= SHARED
                small, large = np.minimum(a[3][:, None], b[3]), np.maximum(a[3][:, None], b[3])
                good &= 100 * small >= LEAST * large
                chosen = good.any(axis=1)
                kept.update(zip(a[0][chosen].tolist(), a[2][chosen].tolist()))
                if not alone:
                    chosen = good.any(axis=0)
                    found.extend((task, 1, i, c) for i, c in zip(b[0][chosen].tolist(), b[2][chosen].tolist()))
            right = []

        def close():
            test()
            found.extend((task, 2 if alone else 0, i, c) for i, c in kept.items())
            kept.clear()

        for batch in batches:
            # Bands as one matrix each: lists of numbers would be many times as large.
            bands = {c: batch.column(c).flatten().to_numpy().reshape(-1, BANDS) for c in ("u", "v")}
            for at, number, *row in zip(*(bands[c] if c in bands else batch.column(c).to_pylist() for c in columns)):
                if at != task:
                    close()
                    task, left, alone = at, [], number == 2
                (right if number == 1 else left).append(row)
                if len(right) >= BLOCK:
                    test()
            if len(found) >= 10_000:
                yield batch_of(dict(zip(schema.names, map(list, zip(*found)))), schema)
                found.clear()
        close()
        if found:
            yield batch_of(dict(zip(schema.names, map(list, zip(*found)))), schema)

    dealt = rows.repartition("task").sortWithinPartitions("task", "side")
    return dealt.mapInArrow(meet, "task string, side int, id bigint, comp bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Two documents are linked if their sets of word shingles are at least 75 % alike; a component is what links reach.
    Documents of fewer than five words have their whole sequence as one shingle; null, empty and blank texts have no
    shingle and no links, whatever their id. Other rows of one id are one document: they share a component, even with
    different texts. Rows without id are linked with nothing; their component is null and they are kept. Other columns
    are not read. An empty table gives no rows. Shingles are compared by 64-bit hashes of whole words.
    """
    signed = materialize(signatures(docs, key, text))
    linkable = signed.where("id IS NOT NULL AND n > 0")
    # Equal sets are one: what follows works on the smallest id of each. Combined before the shuffle.
    same = ["n", "s1", "s2"]
    reps = materialize(linkable.groupBy(*same).agg(F.min("id").alias("id"), F.first("u").alias("u"), F.first("v").alias("v"), F.first("low").alias("low")))
    bands = reps.select("id", F.posexplode(F.arrays_zip("u", "v")).alias("i", "k")).select("id", "i", F.col("k.u").alias("uk"), F.col("k.v").alias("vk"))
    buckets = bands.groupBy("i", "uk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = materialize(bands.join(buckets, ["i", "uk"]))

    tests = materialize(_diagonal_tests(shared))
    sets = materialize(sets_of(docs, key, text, tests.select("id").distinct()))
    # An id with several texts belongs to several sets: its first sets' documents are linked through it.
    whole = linkable.join(reps.select(*same, F.col("id").alias("rep")), same).select("id", "rep")
    twice = whole.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b")
    by_id = whole.join(twice, "id", "left_semi").where("id <> rep").select("id", "rep")
    links = materialize(confirmed(tests, sets).union(by_id))
    classes = components(links)

    asked = materialize(_crossing_tests(shared, reps, classes))
    more_sets = sets_of(docs, key, text, asked.select("id").distinct())
    more = materialize(confirmed(asked, more_sets))
    label = classes.select("id", "comp")
    of = lambda name: label.select(F.col("id").alias(name), F.col("comp").alias(f"c_{name}"))
    joined = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    merged = components(joined.where("a <> b").distinct()).select(F.col("id").alias("comp"), F.col("comp").alias("final"))
    # Classes of documents with links, then what those classes became.
    touched = label.join(merged, "comp", "left").select("id", F.coalesce("final", "comp").alias("comp"))
    others = merged.join(label.select("comp").distinct(), "comp", "left_anti").select(F.col("comp").alias("id"), F.col("final").alias("comp"))
    final = touched.unionByName(others).select(F.col("id").alias("rep"), "comp")

    firsts = reps.select(*same, F.col("id").alias("rep")).join(final, "rep", "left").select(*same, F.coalesce("comp", "rep").alias("comp"))
    found = linkable.join(firsts, same).select("id", "n", "comp")
    alone = signed.where("id IS NULL OR n = 0").select("id", "n", F.col("id").alias("comp"))
    return found.unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"), F.coalesce(F.col("id") == F.col("comp"), F.lit(True)).alias("kept")
    )


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns only: one document of each component.

    Of repeated rows of an id that stays, the one of the largest text stays. Rows without id stay.
    """
    found = materialize(near_duplicates(docs, key, text).select(F.col(key).alias("_id"), "kept").where("_id IS NOT NULL"))
    gone = found.where("NOT kept").select("_id").distinct()
    twice = found.groupBy("_id").agg(F.count(F.lit(1)).alias("_n"), F.min("kept").alias("kept")).where("_n > 1").select("_id", "kept")
    gone = gone.union(twice.select("_id")).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    stay = docs.join(gone, docs[key].cast("bigint") == gone["_id"], "left_anti")
    again = twice.where("kept").select("_id")
    if again.isEmpty():
        return stay
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[key].cast("bigint").alias("_id"), docs[text].alias("_text"))
    order = Window.partitionBy("_id").orderBy(F.desc_nulls_last("_text"), F.xxhash64(F.to_json("row")))
    first = rows.join(again, "_id", "left_semi").withColumn("_n", F.row_number().over(order)).where("_n = 1")
    return stay.union(first.select(*[F.col(f"row.`{c}`") for c in docs.columns]))
