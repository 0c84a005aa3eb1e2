"""Toxicity: subword vectors, averaged over windows of words, into a linear softmax."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import runs

#: Words of a window, lengths of the character n-grams, buckets they are hashed to, size of their vectors.
WINDOW, GRAMS, BITS, SIZE = 8, (3, 4, 5), 18, 8
#: Subwords that an average counts at least; missing ones are zero vectors. So one harmless word alone decides nothing.
FEWEST = 64
#: Bounds of the training sample: labelled texts of each class, and characters of all texts of a class.
MAX_TOXIC, MAX_CLEAN, MAX_TEXT = 1000, 2500, 8_000_000
WHOLE_ROUNDS, WINDOW_ROUNDS, RATE = 10, 35, 0.2
#: Pull of the vectors to zero. Chosen on a quarter of the training rows: n-grams of one text alone stay small.
DECAY = 1e-5


@cache
def letters() -> np.ndarray:
    """Which code points are letters, by the definition of ``LETTERS``."""
    found = np.zeros(0x110000, dtype=bool)
    found[[ord(m[0]) for m in re.finditer(r"[^\W\d_]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))]] = True
    return found


LETTERS = re.compile(r"[^\W\d_]+")


def subwords(codes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets of the n-grams that start at each position, and which of them are real.

    ``codes`` holds words between single zeros. An n-gram may begin or end with a zero, so
    beginnings and ends of words have n-grams of their own; it never crosses one.
    """
    zeros = np.cumsum(codes == 0)
    size, codes = len(codes), codes.astype(np.uint32)
    step = np.uint32(0x01000193)
    rolled, length, buckets, real = codes, 1, [], []
    for n in GRAMS:
        while length < n:
            rolled = rolled[: max(0, size - length)] * step + codes[length:]
            length += 1
        inner = zeros[n - 2 : n - 2 + len(rolled)] == zeros[: len(rolled)]
        buckets.append(((rolled * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
        real.append(inner)
    return buckets, real


def _between_zeros(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words of all texts with one zero before each word and one at the end, and each position's text."""
    texts = [t.lower() for t in texts]
    raw = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where(letters()[raw], raw, np.uint32(0))
    text = np.repeat(np.arange(len(texts) + 1), [1, *(len(t) + 1 for t in texts)]) - 1
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    # A zero belongs to the word behind it.
    codes = codes[keep]
    text = text[keep]
    text[:-1] = np.where(codes[:-1] == 0, text[1:], text[:-1])
    return codes, text


@dataclass(frozen=True)
class SubwordBag:
    """Vectors of all buckets, the softmax's two columns, and its bias."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def slopes(self) -> np.ndarray:
        """What each bucket adds to the difference of the two logits: both layers are linear."""
        return (self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float32)


def window_ends(owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of a full window for each word, inside the words of its text."""
    n = len(owner)
    first = np.searchsorted(owner, owner, "left")
    last = np.searchsorted(owner, owner, "right") - 1
    at = np.arange(n)
    return np.maximum(at - width + 1, first), np.minimum(np.maximum(at, first + width - 1), last) + 1


def best_windows(sums: np.ndarray, counts: np.ndarray, owner: np.ndarray, ends=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The owners, highest mean, first word and end of the best window of each."""
    lo, hi = ends or window_ends(owner, WINDOW)
    total, number = np.concatenate([[0], np.cumsum(sums)]), np.concatenate([[0], np.cumsum(counts)])
    means = (total[hi] - total[lo]) / np.maximum(FEWEST, number[hi] - number[lo])
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    top = np.maximum.reduceat(means, starts)
    found = np.flatnonzero(means == np.repeat(top, np.diff([*starts, len(owner)])))
    pick = found[np.searchsorted(found, starts)]
    return owner[starts], top, lo[pick], hi[pick]


def fresh_words(codes: np.ndarray, starts: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words differ from the word before them in their text: a word in a row counts once."""
    place = np.arange(len(codes)) - np.repeat(starts, np.diff([*starts, len(codes)]))
    mixed = (codes[: len(codes)].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))) * np.uint64(0x9E3779B97F4A7C15)
    words = np.add.reduceat(mixed ^ (mixed >> np.uint64(29)), starts)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (words[1:] != words[:-1]) | (text[starts][1:] != text[starts][:-1])
    return fresh


def score_texts(texts: list[str], slopes: np.ndarray, bias: float) -> np.ndarray:
    """The softmax of each text's best window; a text without words gets the bias alone."""
    logits = np.full(len(texts), bias)
    codes, text = _between_zeros(texts)
    starts = np.flatnonzero(codes == 0)[:-1]
    if len(starts):
        sums, counts = np.zeros(len(codes)), np.zeros(len(codes))
        for bucket, real in zip(*subwords(codes)):
            sums[: len(bucket)] += np.where(real, slopes[bucket], 0)
            counts[: len(bucket)] += real
        fresh = fresh_words(codes[:-1], starts, text)
        who, top, _, _ = best_windows(np.add.reduceat(sums, starts)[fresh], np.add.reduceat(counts, starts)[fresh], text[starts][fresh])
        logits[who] += top
    return 1 / (1 + np.exp(-np.clip(logits, -500, 500)))


def fit(texts: list[str], toxic: list[int], seed: int = 7) -> SubwordBag:
    """Train vectors and softmax together.

    The first rounds average whole texts. Then each text is stood for by its best window, so a few
    words in a long text count as much as in a short one, and the likeliest windows of clean texts
    are what the model learns to reject. Without both classes the model says 0 for every text.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.05, (1 << BITS, SIZE)).astype(np.float32)
    softmax, bias = rng.normal(0, 0.5, (SIZE, 2)).astype(np.float32), np.zeros(2, dtype=np.float32)
    known: dict[str, int] = {}
    lists = [np.array([known.setdefault(w, len(known)) for w, _ in groupby(LETTERS.findall(t.lower()))], dtype=np.int32) for t in texts]
    kept = [i for i, words in enumerate(lists) if len(words)]
    wanted = np.array([toxic[i] for i in kept], dtype=np.float32)
    if not kept or wanted.min() == wanted.max():
        return SubwordBag(np.zeros_like(vectors), softmax, np.array([50, 0], dtype=np.float32))
    token = np.concatenate([lists[i] for i in kept])
    owner = np.repeat(np.arange(len(kept), dtype=np.int32), [len(lists[i]) for i in kept])
    codes = np.frombuffer("\0".join(["", *known, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    word_at = (np.cumsum(codes == 0) - 1).astype(np.int32)
    pairs = [(word_at[: len(bucket)][real], bucket[real].astype(np.int32)) for bucket, real in zip(*subwords(codes))]
    word_of, gram = (np.concatenate(p) for p in zip(*pairs))
    del lists, codes, word_at, pairs
    grams_in = np.bincount(word_of, minlength=len(known))
    # Only buckets with an n-gram of the sample are trained; the rest stay zero.
    seen = np.flatnonzero(np.bincount(gram, minlength=1 << BITS))
    place = np.zeros(1 << BITS, dtype=np.int32)
    place[seen] = np.arange(len(seen))
    gram = place[gram]
    everywhere, vectors = np.zeros_like(vectors), vectors[seen]
    in_token, ends = grams_in[token], window_ends(owner, WINDOW)
    edges = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
    whole = np.bincount(owner, weights=in_token)
    share = np.where(wanted == 1, 0.5 / wanted.sum(), 0.5 / (len(wanted) - wanted.sum()))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (vectors, softmax, bias)]
    for turn in range(1, WHOLE_ROUNDS + WINDOW_ROUNDS + 1):
        slope = softmax[:, 1] - softmax[:, 0]
        by_word = np.bincount(word_of, weights=(vectors @ slope)[gram], minlength=len(known))
        if turn <= WHOLE_ROUNDS:
            size, total = np.maximum(FEWEST, whole), np.add.reduceat(by_word[token], edges[:-1])
            picked, of = token, owner
        else:
            _, _, lo, hi = best_windows(by_word[token], in_token, owner, ends)
            of = np.repeat(np.arange(len(lo)), hi - lo)
            picked = token[np.arange(len(of)) + np.repeat(lo - np.append(0, np.cumsum(hi - lo)[:-1]), hi - lo)]
            size, total = np.maximum(FEWEST, np.bincount(of, weights=grams_in[picked])), np.bincount(of, weights=by_word[picked])
        logit = total / size + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - wanted) * share
        # Every n-gram of a picked word gets its window's error over the window's size.
        on_word = np.bincount(picked, weights=(error / size)[of], minlength=len(known))
        on_gram = np.bincount(gram, weights=on_word[word_of], minlength=len(seen)).astype(np.float32)
        on_slope = on_gram @ vectors
        gradients = [
            np.outer(on_gram, slope) + DECAY * vectors,
            np.stack([-on_slope, on_slope], axis=1) + 1e-5 * softmax,
            np.array([-error.sum(), error.sum()], dtype=np.float32),
        ]
        for x, g, (m, v) in zip((vectors, softmax, bias), gradients, state):
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.98**turn)) + 1e-9)
    everywhere[seen] = vectors
    return SubwordBag(everywhere, softmax, bias)


def training_sample(docs: DataFrame, labels: DataFrame, trains: Column) -> DataFrame:
    """A bounded, repeatable sample of labelled texts: ``_text`` and ``_toxic`` of at most MAX_TOXIC + MAX_CLEAN whole texts.

    Ids are chosen by a hash, each class by itself, before texts are read; of a repeated id one text counts, and an id
    labelled both ways teaches nothing. A text that would take its class beyond MAX_TEXT characters is passed over.
    Rows without id, label or text take no part.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")).where(F.col("_toxic").isin(0, 1) & F.col("_id").isNotNull()).where(trains)
    one = known.groupBy("_id").agg(F.min("_toxic").alias("_toxic"), F.max("_toxic").alias("_max")).where("_toxic = _max").drop("_max")
    texts = docs.select(docs["doc_id"].alias("_id"), docs["text"].alias("_text")).where(F.length("_text") > 0)
    # Only ids that have a text; one row each, however often they repeat.
    there = one.join(texts.select("_id"), "_id", "left_semi")
    order = [F.md5(F.col("_id").cast("string")), "_id"]
    picked = there.where("_toxic = 1").orderBy(*order).limit(MAX_TOXIC).union(there.where("_toxic = 0").orderBy(*order).limit(MAX_CLEAN))
    # At most MAX_TOXIC + MAX_CLEAN ids: that bounds the broadcasts and what comes back.
    rows = [r.asDict() for r in picked.collect()]
    schema = "_id bigint, _toxic int"
    chosen = docs.sparkSession.createDataFrame([(r["_id"], int(r["_toxic"])) for r in rows], schema)
    mine = texts.join(F.broadcast(chosen), "_id")
    first = F.min_by(F.struct(F.length("_text").alias("n"), F.md5(F.col("_text").cast("binary")).alias("h")), F.md5(F.col("_text").cast("binary")))
    sizes = {r["_id"]: r["of"] for r in mine.groupBy("_id").agg(first.alias("of")).collect()}
    room, kept = {0: MAX_TEXT, 1: MAX_TEXT}, []
    for r in rows:
        of = sizes.get(r["_id"])
        if of is not None and of["n"] <= room[r["_toxic"]]:
            room[r["_toxic"]] -= of["n"]
            kept.append((r["_id"], int(r["_toxic"]), of["h"]))
    chosen = docs.sparkSession.createDataFrame(kept, schema + ", _h string")
    same = texts.withColumn("_h", F.md5(F.col("_text").cast("binary"))).join(F.broadcast(chosen), ["_id", "_h"])
    return same.groupBy("_id", "_toxic").agg(F.first("_text").alias("_text")).orderBy(F.md5(F.col("_id").cast("string")), "_id")


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, text: Column) -> Column:
    """A score from 0 to 1 for the whole of each ``text``, by a model fitted on ``labels`` outside the held-out rows.

    Null and empty texts, and texts without letters, get the score of the bias alone; long ones are scored whole, by
    their best window. Neither ids nor any other column are inputs, so equal texts score the same however often they
    repeat, and columns of any name may be there. Without labels of both classes every score is next to 0; an empty
    table gives no rows.
    """
    rows = training_sample(docs, labels, ~held_out(F.col("_id"))).select("_text", "_toxic").toPandas()
    model = fit(rows["_text"].tolist(), rows["_toxic"].tolist())
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.slopes(), float(model.bias[1] - model.bias[0])))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        values = [t or "" for t in texts.to_pylist()]
        slopes, bias = shared.value
        parts = [score_texts(values[a:b], slopes, bias) for a, b in runs([len(v) + 1 for v in values], 400_000)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    scored = docs.select("doc_id", toxicity(docs, labels, docs["text"]).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns only."""
    return docs.where(toxicity(docs, labels, docs["text"]) < threshold)
