"""Quality: a regularised quadratic discriminant over transformed statistics of whole documents.

Each class is a normal distribution. Its covariance is shrunk towards that of both classes together and towards a
multiple of the identity; by how much is what makes held-back folds of the training rows likeliest. A text scores by
the difference of the two log densities: Mahalanobis distances through the Cholesky factors, computed once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, ship

#: Words whose repetition is counted together, and characters that are looked at in one go.
SPAN, PIECE = 512, 1 << 20
#: Values are whole multiples of 1 / GRID, so that sums over them are exact in any order.
GRID = 4096
#: Rows are dealt to so many shards; shards make up the folds of the choice of shrinkage.
SHARDS, FOLDS = 500, 5
#: Shares of the common covariance and of the identity in a class's own.
POOLED, ROUND = (0.02, 0.1, 0.3, 0.6), (0.001, 0.01, 0.05, 0.2)
#: A share counts this many usual units beside its own, so that short texts say little, and has a least value.
NEUTRAL, LEAST = 20, 0.01
#: Steps of a share in the search of its median, and the highest that is told from higher ones.
STEPS, HIGHEST = 1000, 20

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = ".,;:?!'\"-()"
LETTER, UPPER, DIGIT, MARK, SPACE, OTHER = range(6)
KINDS = np.full(0x110000, OTHER, dtype=np.uint8)
for _c in range(0x3000):
    _t = chr(_c)
    KINDS[_c] = UPPER if _t.isupper() else LETTER if _t.isalpha() else DIGIT if _t.isdigit() else SPACE if _t.isspace() else MARK if _t in MARKS else OTHER
#: Scripts without capitals beyond the first 12,288 code points count as letters.
KINDS[0x3000:0xE000] = LETTER
KINDS[0xF900:0xFB00] = LETTER
KINDS[0x20000:0x32000] = LETTER

#: What is counted in a text, and the statistics made of it: each a part of something, both among the counts.
COUNTS = ("signs", "letters", "capitals", "digits", "marks", "others", "words", "lone", "ragged", "repeated", "again", "ends", "lines", "size")
SHARES = {
    "letters": "signs", "capitals": "letters", "digits": "signs", "marks": "signs", "others": "signs", "lone": "words",
    "ragged": "words", "repeated": "words", "again": "words", "ends": "words", "lines": "words", "size": "words",
}
#: Beside the shares, the number of words.
SIZE = len(SHARES) + 1


def counts(text: str) -> list[int]:
    """``COUNTS`` of a text. All of it is read, in pieces, so memory does not grow with it.

    Signs are characters but white space; a word without letter or digit is lone, one that ends in two other signs is
    ragged; repeated words are in the same ``SPAN`` words before, again is a word right behind itself.
    """
    kinds = np.zeros(6, dtype=np.int64)
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer(text[at : at + PIECE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds += np.bincount(KINDS[codes], minlength=6)
    words = lone = ragged = repeated = again = ends = size = 0
    found, before = (m[0] for m in WORD.finditer(text)), ""
    while span := list(islice(found, SPAN)):
        words += len(span)
        repeated += len(span) - len(set(span))
        again += (span[0] == before) + sum(map(str.__eq__, span, span[1:]))
        before = span[-1]
        size += sum(map(len, span))
        for w in span:
            if w[-1].isalnum():
                continue
            ends += w[-1] in ".?!"
            if not any(map(str.isalnum, w)):
                lone += 1
            elif len(w) > 1 and not w[-2].isalnum():
                ragged += 1
    letter, upper, digit, mark, space, other = kinds.tolist()
    return [letter + upper + digit + mark + other, letter + upper, upper, digit, mark, other, words, lone, ragged, repeated, again, ends, text.count("\n"), size]


def statistics(found: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """The transformed statistics of each row of counts, as whole multiples of 1 / GRID.

    Logarithms of shares, each with ``NEUTRAL`` units of the ``usual`` share added: an empty text has the usual values.
    """
    column = {name: found[:, i].astype(float) for i, name in enumerate(COUNTS)}
    shares = [np.log(LEAST + (column[p] + NEUTRAL * u) / (column[of] + NEUTRAL)) for (p, of), u in zip(SHARES.items(), usual)]
    return np.rint(np.stack([*shares, np.log1p(column["words"]) / 4], axis=1) * GRID).astype(np.int64)


def with_counts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_counts`` of each whole text; null reads as empty. Texts go to the workers once."""

    @F.arrow_udf("array<bigint>")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array([counts(t.as_py() or "") for t in texts], pa.list_(pa.int64()))

    ship(docs.sparkSession)
    return docs.withColumn("_counts", counted(text))


def usual_shares(counted: DataFrame) -> np.ndarray:
    """The median of each share over all texts that have words, to a step, from a table of at most STEPS * HIGHEST + 1 rows a share."""
    count = {name: F.col("_counts")[i] for i, name in enumerate(COUNTS)}
    step = lambda p, of: F.least(F.rint(STEPS * count[p] / F.greatest(count[of], F.lit(1))), F.lit(STEPS * HIGHEST)).cast("int")
    steps = counted.where(count["words"] > 0).select(F.posexplode(F.array(*[step(p, of) for p, of in SHARES.items()])).alias("share", "step"))
    found: dict[int, list[tuple[int, int]]] = {}
    for r in steps.groupBy("share", "step").count().collect():
        found.setdefault(r["share"], []).append((r["step"], r["count"]))
    usual = np.zeros(len(SHARES))
    for share, seen in found.items():
        at, n = np.array(sorted(seen)).T
        usual[share] = at[np.searchsorted(np.cumsum(n), n.sum() / 2)] / STEPS
    return usual


def with_statistics(counted: DataFrame, usual: np.ndarray) -> DataFrame:
    """``_stats`` in place of ``_counts``."""

    @F.arrow_udf("array<bigint>")
    def stats(found: pa.Array) -> pa.Array:
        values = statistics(found.flatten().to_numpy().reshape(len(found), len(COUNTS)), usual)
        return pa.array(list(values), pa.list_(pa.int64()))

    return counted.withColumn("_stats", stats("_counts")).drop("_counts")


@dataclass(frozen=True)
class Moments:
    """Number, sums and sums of products of a class's rows."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products)

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / self.n).astype(float) / GRID

    def scatter(self, around: np.ndarray) -> np.ndarray:
        """Sum of the products of the differences from ``around``."""
        sums = self.sums.astype(float) / GRID
        return self.products.astype(float) / GRID**2 - np.outer(sums, around) - np.outer(around, sums) + self.n * np.outer(around, around)


def moments(rows: DataFrame) -> dict[int, dict[int, Moments]]:
    """Per class (``label`` 0 or 1) and shard, exact moments of ``_stats`` over all rows; at most 2 * SHARDS rows come back."""
    size = SIZE
    value = [F.col("_stats")[i] for i in range(size)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    shard = F.pmod(F.xxhash64("_id"), F.lit(SHARDS)).cast("int").alias("shard")
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(value)] + [F.sum(value[i] * value[j]).alias(f"p{i}_{j}") for i, j in pairs]
    found: dict[int, dict[int, Moments]] = {0: {}, 1: {}}
    for r in rows.groupBy("label", shard).agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        products = np.zeros((size, size), dtype=object)
        for i, j in pairs:
            products[i, j] = products[j, i] = r[f"p{i}_{j}"]
        found[r["label"]][r["shard"]] = Moments(r["n"], np.array([r[f"s{i}"] for i in range(size)], dtype=object), products)
    return found


def _total(parts) -> Moments | None:
    parts = list(parts)
    out = parts[0] if parts else None
    for p in parts[1:]:
        out = out + p
    return out


@dataclass(frozen=True)
class Discriminant:
    """Per class: mean, lower Cholesky factor of the shrunk covariance, and the logarithm of its density's constant."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 for each row."""
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.prior)))
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            gap = np.linalg.solve(factor, (x - mean).T)
            logs.append(constant - 0.5 * (gap**2).sum(axis=0))
        return 1 / (1 + np.exp(-np.clip(self.prior + logs[1] - logs[0], -500, 500)))


def _shrunk(own: np.ndarray, both: np.ndarray, pooled: float, rounded: float) -> np.ndarray:
    out = (1 - pooled) * own + pooled * both
    return (1 - rounded) * out + rounded * np.diag(np.diag(both) + 1e-4)


def _loss(train: list[Moments], held: list[Moments | None], pooled: float, rounded: float) -> float:
    """How unlikely the held-back rows are, by their moments alone."""
    own = [m.scatter(m.mean) / m.n for m in train]
    both = sum(m.scatter(m.mean) for m in train) / sum(m.n for m in train)
    loss = 0.0
    for m, cov, rest in zip(train, own, held):
        if rest is None:
            continue
        factor = np.linalg.cholesky(_shrunk(cov, both, pooled, rounded))
        half = np.linalg.solve(factor, rest.scatter(m.mean))
        # Each class counts the same, however many rows it has.
        loss += (np.trace(np.linalg.solve(factor, half.T)) / rest.n + 2 * np.log(np.diag(factor)).sum()) / 2
    return loss


def fit(by_shard: dict[int, dict[int, Moments]]) -> Discriminant:
    """The discriminant from the moments of both classes. With one class only, or none, every text scores the same."""
    whole = [_total(by_shard[c].values()) for c in (0, 1)]
    counts = [m.n if m else 0 for m in whole]
    prior = float(np.log((counts[1] + 1) / (counts[0] + 1)))
    if not all(counts):
        return Discriminant([], [], [], prior)
    folds = [[_total(m for s, m in by_shard[c].items() if s % FOLDS == f) for c in (0, 1)] for f in range(FOLDS)]
    best, choice = None, (POOLED[-1], ROUND[-1])
    for pooled, rounded in product(POOLED, ROUND):
        loss = 0.0
        for held in folds:
            train = [w - h if h else w for w, h in zip(whole, held)]
            if all(t.n for t in train):
                loss += _loss(train, held, pooled, rounded)
        if best is None or loss < best:
            best, choice = loss, (pooled, rounded)
    means = [m.mean for m in whole]
    both = sum(m.scatter(m.mean) for m in whole) / sum(counts)
    factors = [np.linalg.cholesky(_shrunk(m.scatter(m.mean) / m.n, both, *choice)) for m in whole]
    return Discriminant(means, factors, [-float(np.log(np.diag(f)).sum()) for f in factors], prior)


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """``_id``, ``_stats`` and ``label`` of every labelled document that is not held out.

    A document repeated with the same text, and a label repeated, count once; an id labelled both ways teaches nothing.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).where(F.col("label").isin(0, 1)).where(~held_out(F.col("_id")))
    one = known.groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("_max")).where("label = _max").drop("_max")
    return scored.select(F.col("doc_id").alias("_id"), "_stats").join(one, "_id").distinct()


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (chance that the quality label is 1) and ``predicted`` (1 from ``threshold`` on).

    Learns from all labelled rows outside the held-out ones. Nothing but the whole text goes into a score: empty and null
    texts have the values of a text that says nothing. Rows repeat as in ``docs``. Without labels of both classes every
    text scores the share of the labels.
    """
    spark = docs.sparkSession
    counted = materialize(with_counts(docs.select("doc_id", docs["text"].alias("_text")), F.col("_text")).drop("_text"))
    scored = with_statistics(counted, usual_shares(counted))
    shared = spark.sparkContext.broadcast(fit(moments(training_rows(scored, labels))))

    @F.arrow_udf("double")
    def score(stats: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(stats.flatten().to_numpy().reshape(len(stats), SIZE) / GRID))

    out = scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("_stats").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
