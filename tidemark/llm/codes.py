"""Vector codes: every part of a vector becomes the number of its nearest codebook entry, exactly and in integers.

Parts and entries are filled up with zeros to a power of two and go through the Walsh-Hadamard transform, which is all
additions and multiplies every squared distance by its width. Its coefficients come in sequency order (by sign changes),
slowly varying ones first. Scaled squared differences are added coefficient by coefficient; an entry whose sum so far
exceeds the whole distance of a good guess cannot be nearest and is dropped. Sums are 64-bit integers throughout.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of
from tidemark.session import materialize, ship

#: Parts of a vector, entries of a codebook, rounds of fitting, and what a component is multiplied by before its floor.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows compared with all entries at a time: the sums stay in the processor's cache.
CHUNK = 256
#: Shares of the coefficients after which entries are dropped; while more than DENSE of all pairs are left, none is moved.
STOPS, DENSE = (0.25, 0.5, 0.75, 1.0), 0.2


def sequency_order(width: int) -> np.ndarray:
    """The rows of the Walsh-Hadamard matrix by their number of sign changes; ``width`` is a power of two."""
    rows = np.arange(width)
    bits = rows[:, None] & rows[None, :]
    signs = np.zeros_like(bits)
    while bits.any():
        signs ^= bits & 1
        bits >>= 1
    return np.argsort((np.diff(signs, axis=1) != 0).sum(axis=1), kind="stable")


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """The transform of each row, filled up with zeros to a power of two, in sequency order."""
    width = 1 << max(0, rows.shape[1] - 1).bit_length()
    out = np.zeros((len(rows), width), dtype=np.int64)
    out[:, : rows.shape[1]] = rows
    step = 1
    while step < width:
        pairs = out.reshape(len(rows), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), width)
        step *= 2
    return out[:, sequency_order(width)]


def largest_component(length: int) -> int:
    """The largest magnitude of a component of parts of ``length`` for which no scaled distance leaves 64 bits."""
    width = 1 << max(0, length - 1).bit_length()
    return isqrt((2**63 - 1) // (4 * width * max(1, length)))


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest entry, ties to the lower number. Both sides are transformed."""
    found, distance = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
    for at in range(0, len(rows), CHUNK):
        found[at : at + CHUNK], distance[at : at + CHUNK] = _nearest(rows[at : at + CHUNK], entries)
    return found, distance // rows.shape[1]


def _nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = rows.shape[1]
    sums = np.zeros((len(rows), len(entries)), dtype=np.int64)
    bound, done, pairs = None, 0, None
    for stop in sorted({max(1, int(width * s)) for s in STOPS}):
        for s in range(done, stop):
            if pairs is None:
                gap = rows[:, s, None] - entries[None, :, s]
                gap *= gap
                sums += gap
            else:
                sums += (rows[pairs[0], s] - entries[pairs[1], s]) ** 2
        done = stop
        if bound is None:
            bound = ((rows - entries[sums.argmin(axis=1)]) ** 2).sum(axis=1)
        if pairs is None:
            left = sums <= bound[:, None]
            if stop == width or np.count_nonzero(left) < DENSE * left.size:
                pairs = np.nonzero(left)
                sums = sums[pairs]
        else:
            left = sums <= bound[pairs[0]]
            pairs, sums = (pairs[0][left], pairs[1][left]), sums[left]
    # Pairs are in order of row, then entry; every row still has the entry of its guess.
    starts = np.flatnonzero(np.diff(pairs[0], prepend=-1))
    best = np.minimum.reduceat(sums, starts)
    first = np.flatnonzero(sums == np.repeat(best, np.diff([*starts, len(sums)])))
    return pairs[1][first[np.searchsorted(first, starts)]], best


def whole(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, ok), F.lit(False))


def _integers(vectors: pa.Array, length: int) -> np.ndarray:
    """Components as floors of ``SCALE`` times their value, shorter vectors filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(SCALE * vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py() : vectors.offsets[-1].as_py()]).astype(np.int64)
    if len(sizes) and (sizes == length).all():
        return values.reshape(len(sizes), length)
    out = np.zeros((len(sizes), length), dtype=np.int64)
    out[np.arange(length) < sizes[:, None]] = values
    return out


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` is an array of that position's entries, in their own components."""

    entries: list[np.ndarray]

    @property
    def length(self) -> int:
        return sum(e.shape[1] for e in self.entries)

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry number and squared distance of every part of every row."""
        found = [nearest(walsh_hadamard(x), walsh_hadamard(e)) for x, e in zip(np.split(vectors, len(self.entries), axis=1), self.entries)]
        return np.stack([f for f, _ in found], axis=1), np.stack([d for _, d in found], axis=1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The integer vectors that the codes stand for."""
        return np.concatenate([e[codes[:, p]] for p, e in enumerate(self.entries)], axis=1)

    def digest(self) -> str:
        """Hex digest of all components as decimals, by part, entry and position."""
        return sha256(",".join(str(int(x)) for e in self.entries for x in e.ravel()).encode()).hexdigest()


def _kept(vectors: DataFrame, vector: str) -> DataFrame:
    return vectors.where(whole(vectors[vector]))


def fit(vectors: DataFrame, key: str, vector: str) -> Codebooks | None:
    """Codebooks over all whole vectors; None if there are none.

    Entries start as the parts of the vectors of the ``ENTRIES`` smallest ids; of repeated ids the smallest vector counts,
    null ids are none. Every round is one pass in which tasks add up their parts per entry, and one small table of sums
    that the driver divides: its size is that of the codebooks. Vectors are as long as the longest, filled up with zeros,
    then to a multiple of ``PARTS``. Components for which a distance could leave 64 bits stop the job with an error.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = _kept(vectors, vector).select(vectors[key].alias("key"), vectors[vector].cast("array<double>").alias("vector"))
    top = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    seen = rows.agg(F.max(F.size("vector")).alias("size"), F.max(top).alias("top")).first()
    if seen["size"] is None:
        return None
    width = max(1, -(-seen["size"] // PARTS))
    if SCALE * (seen["top"] or 0) >= largest_component(width):
        raise ValueError(f"a component of {seen['top']} times {SCALE} is too large: distances would leave 64 bits")
    # At most ENTRIES ids and their vectors.
    ids = [r["key"] for r in rows.where("key IS NOT NULL").select("key").distinct().orderBy("key").limit(ENTRIES).collect()]
    if not ids:
        raise ValueError("no vector has an id")
    first = rows.where(F.col("key").between(ids[0], ids[-1])).groupBy("key").agg(F.min("vector").alias("vector")).orderBy("key")
    begin = _integers(pa.array([r["vector"] for r in first.collect()], pa.list_(pa.float64())), PARTS * width)
    books = Codebooks([x.copy() for x in np.split(begin, PARTS, axis=1)])
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(books)
        parts = rows.select("vector").mapInArrow(_adder(shared), "part int, entry int, n bigint, sums array<bigint>")
        for r in parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
            books.entries[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
        shared.unpersist()
    return books


def _adder(shared):
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def add(batches):
        books = shared.value
        numbers = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
        sums = [np.zeros(e.shape, dtype=np.int64) for e in books.entries]
        for batch in batches:
            if batch.num_rows:
                x = _integers(batch.column("vector"), books.length)
                codes, _ = books.encode(x)
                for p, part in enumerate(np.split(x, len(sums), axis=1)):
                    np.add.at(sums[p], codes[:, p], part)
                    numbers[p] += np.bincount(codes[:, p], minlength=len(numbers[p]))
        for p, n in enumerate(numbers):
            used = np.flatnonzero(n)
            if len(used):
                yield batch_of({"part": [p] * len(used), "entry": used, "n": n[used], "sums": list(sums[p][used])}, schema)

    return add


def encode(vectors: DataFrame, books: Codebooks, key: str, vector: str, label: str) -> DataFrame:
    """Per whole vector: its ``key`` and ``label``, ``code`` (two hex digits a part) and ``error``, the squared distance to what it stands for."""
    spark = vectors.sparkSession
    ship(spark)
    rows = _kept(vectors, vector).select(vectors[key].alias("key"), vectors[label].alias("label"), vectors[vector].cast("array<double>").alias("vector"))
    shared = spark.sparkContext.broadcast(books)

    def code(batches):
        for batch in batches:
            if batch.num_rows:
                codes, errors = shared.value.encode(_integers(batch.column("vector"), shared.value.length))
                texts = [c.tobytes().hex() for c in codes.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(texts, pa.string()), pa.array(errors.sum(axis=1))], ["key", "label", "code", "error"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(code, f"key {kinds['key']}, label {kinds['label']}, code string, error bigint")


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per whole vector: ``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    Rows whose vector is null or holds a null or non-finite component are left out. Repeated rows each have a row. An
    empty table gives none. ``label_error`` adds up the errors of all rows with the same label, null being one.
    """
    books = fit(vectors, key, vector)
    if books is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {dict(vectors.dtypes)[key]}, code string, error bigint, label_error bigint, codebooks_sha256 string")
    coded = materialize(encode(vectors, books, key, vector, label))
    # One row per label: AQE sends it along where it is small and splits a frequent label's rows where it is not.
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(totals, coded["label"].eqNullSafe(totals["_label"]))
    return joined.select(F.col("key").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
