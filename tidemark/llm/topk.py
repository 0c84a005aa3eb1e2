"""Exact top-k inner products through a pivot-distance index.

With M the largest norm, a vector x becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0). Then
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the best scores are the nearest points, and the triangle inequality holds.
Every vector is keyed by its nearest pivot and the ring of its distance to it; an annulus is one pivot's ring. A query
at distance d from a pivot has no point of an annulus [lo, hi] nearer than max(d - hi, lo - d).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of
from tidemark.session import materialize

#: Pivots and rings of a pivot: their product bounds the table of annuli.
PIVOTS, RINGS = 16, 16
#: Rows of a block of vectors and of a group of queries.
BLOCK, GROUP = 1024, 256
#: Share of the annuli, nearest first, that each round adds.
ROUNDS = (0.1, 0.4, 1.0)
#: Integers below this are exact in a double.
EXACT = 2.0**53


def scaled(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``x`` (floor of 256 times each component, as doubles in bytes), ``dim``, ``norm2`` and ``top`` (largest magnitude).

    Vectors that are null or hold a null, infinite or NaN component are left out.
    """
    named = vectors.select(vectors[key].cast("bigint").alias("_id"), vectors[vector].cast("array<double>").alias("_vector"))
    schema = pa.schema([("id", pa.int64()), ("x", pa.binary()), ("dim", pa.int32()), ("norm2", pa.float64()), ("top", pa.float64())])

    def scale(batches):
        for batch in batches:
            ids, found = [], []
            for at, values in zip(batch.column("_id").to_pylist(), batch.column("_vector")):
                if not values.is_valid or values.values.null_count:
                    continue
                x = np.floor(256 * values.values.to_numpy(zero_copy_only=False))
                if np.isfinite(x).all():
                    ids.append(at)
                    found.append(x)
            yield batch_of(
                {"id": ids, "x": [x.tobytes() for x in found], "dim": [len(x) for x in found], "norm2": [float(x @ x) for x in found], "top": [float(np.abs(x).max(initial=0)) for x in found]},
                schema,
            )

    return named.mapInArrow(scale, "id bigint, x binary, dim int, norm2 double, top double")


def matrix(rows: list[bytes], dim: int) -> np.ndarray:
    """Rows as one matrix; shorter vectors are filled up with zeros, which changes no inner product."""
    if all(len(r) == 8 * dim for r in rows):
        return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), dim)
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r) // 8] = np.frombuffer(r, np.float64)
    return out


def products(queries: np.ndarray, vectors: np.ndarray, top: float) -> np.ndarray:
    """Exact inner products: in doubles where no sum can leave their exact range, else in Python integers."""
    if queries.shape[1] * top * top < EXACT:
        return queries @ vectors.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries) @ whole(vectors).T


def best(scores: np.ndarray, ids: list, k: int) -> list[int]:
    """Positions of the k best scores; ties go to the smaller id, null ids last."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores >= floor)
    else:
        found = range(len(scores))
    return sorted(found, key=lambda i: (-scores[i], ids[i] is None, ids[i] or 0))[:k]


class Space:
    """Pivots and the lifted distances to them."""

    def __init__(self, pivots: list[bytes], dim: int, norm2: float, top: float):
        self.dim, self.norm2, self.top = dim, norm2, top
        self.pivots = matrix(pivots, dim)
        self.lift = np.sqrt(np.maximum(0, norm2 - (self.pivots**2).sum(axis=1)))

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        own = (vectors**2).sum(axis=1)
        lift = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, self.norm2 - own))
        square = (own + lift**2)[:, None] + self.norm2 - 2 * (vectors @ self.pivots.T + lift[:, None] * self.lift)
        return np.sqrt(np.maximum(0, square))


def placed(rows: DataFrame, space: Space, query: bool) -> DataFrame:
    """``id``, ``x``, nearest ``pivot`` and distance ``d``."""
    schema = pa.schema([("id", pa.int64()), ("x", pa.binary()), ("pivot", pa.int32()), ("d", pa.float64())])

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                far = space.distances(matrix(batch.column("x").to_pylist(), space.dim), query)
                near = far.argmin(axis=1)
                yield batch_of({"id": batch.column("id"), "x": batch.column("x"), "pivot": near.astype(np.int32), "d": far[np.arange(len(near)), near]}, schema)

    return rows.select("id", "x").mapInArrow(place, "id bigint, x binary, pivot int, d double")


def blocks(rows: DataFrame, names: list[str], most: int) -> DataFrame:
    """Rows packed into blocks of about ``most`` rows of equal ``names``: a large group is dealt out by a hash of the row."""
    counts = rows.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("_parts"))
    dealt = rows.join(F.broadcast(counts), names).withColumn("part", F.pmod(F.xxhash64("id", "x"), F.col("_parts")).cast("int"))
    return dealt.groupBy(*names, "part").agg(F.collect_list(F.struct("id", "x")).alias("rows"))


def top_inner_products(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's ``k`` best other vectors; all, if there are fewer.

    ``is_query`` tells queries by their ``id``; a null id is never a query. Every vector but those of the query's own id
    is a candidate. Scores are inner products of the floored components, in whole numbers; ties go to the smaller id,
    null ids last, and rows repeated are candidates each. A query id with several different vectors is asked with each
    of them and keeps the k best of all. Vectors of different lengths count missing components as zeros. Without
    queries or candidates the result is empty.

    The index covers every vector: blocks of bounded size for each annulus. Groups of queries near one pivot visit the
    annuli in order of their least distance, a tenth first; the k-th score found then bounds what the next round may
    skip, so no answer is lost. Annuli are at most PIVOTS * RINGS rows.
    """
    spark = vectors.sparkSession
    rows = materialize(scaled(vectors, key, vector))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"), F.max("norm2").alias("norm2"), F.max("top").alias("top")).first()
    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not size["n"]:
        return spark.createDataFrame([], out)
    pivots = [r["x"] for r in rows.select("x").distinct().orderBy(F.md5("x"), "x").limit(PIVOTS).collect()]
    space = Space([bytes(p) for p in pivots], size["dim"] or 0, size["norm2"], size["top"])

    index = placed(rows, space, query=False)
    index = materialize(index)
    # Rings of about equal numbers: at most RINGS edges for each pivot.
    cuts = {r["pivot"]: r["cuts"] for r in index.groupBy("pivot").agg(F.percentile_approx("d", [i / RINGS for i in range(1, RINGS)], 2000).alias("cuts")).collect()}
    edges = spark.createDataFrame([(p, [float(c) for c in sorted(set(found))]) for p, found in cuts.items()], "pivot int, cuts array<double>")
    ringed = index.join(F.broadcast(edges), "pivot").withColumn("ring", F.size(F.filter("cuts", lambda c: c <= F.col("d"))))
    annuli = [(r["pivot"], r["ring"], r["lo"], r["hi"]) for r in ringed.groupBy("pivot", "ring").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).orderBy("pivot", "ring").collect()]
    stored = materialize(blocks(ringed.select("id", "x", "pivot", "ring"), ["pivot", "ring"], BLOCK).withColumnRenamed("rows", "vectors"))
    # Queries are the stated set; each is asked once.
    asked = placed(rows.where(is_query(F.col("id"))).select("id", "x").distinct(), space, query=True)
    groups = materialize(blocks(materialize(asked).select("id", "x", F.col("pivot").alias("home")), ["home"], GROUP).withColumnRenamed("rows", "queries").withColumn("group", F.xxhash64("home", "part")))

    slack = 1e-6 * (1 + np.sqrt(space.norm2))
    known = None
    for step, share in enumerate(ROUNDS):
        first, last = (0.0 if step == 0 else ROUNDS[step - 1]), share
        named = groups.select("group", "queries")
        if known is not None:
            floors = known.groupBy("group").agg(F.collect_list(F.struct("query", "score")).alias("floors"))
            named = named.join(floors, "group", "left")
        else:
            named = named.withColumn("floors", F.lit(None).cast("array<struct<query:binary,score:bigint>>"))
        visits = materialize(_visits(named, space, annuli, first, last, slack, k))
        hits = materialize(_search(visits, groups, stored, space, k))
        known_rows = hits if known is None else known.unionByName(hits)
        known = materialize(_ranked(known_rows, ["query"], k))
    final = _ranked(known.select("query_id", "vec_id", "score", "group", "query"), ["query_id"], k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return final.select("query_id", F.row_number().over(order).cast("int").alias("rank"), "vec_id", "score")


def _ranked(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best rows of each ``by``. Spark keeps k of each in every task before it shuffles them."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def _visits(groups: DataFrame, space: Space, annuli: list[tuple], first: float, last: float, slack: float, k: int) -> DataFrame:
    """``group``, ``pivot``, ``ring``: annuli whose turn it is and that may hold a better point for some query of the group."""
    schema = pa.schema([("group", pa.int64()), ("pivot", pa.int32()), ("ring", pa.int32())])
    pivot = np.array([a[0] for a in annuli])
    lo, hi = np.array([a[2] for a in annuli]), np.array([a[3] for a in annuli])
    begin, end = int(np.ceil(first * len(annuli))), int(np.ceil(last * len(annuli)))

    def choose(batches):
        for batch in batches:
            for group, queries, floors in zip(batch.column("group").to_pylist(), batch.column("queries").to_pylist(), batch.column("floors").to_pylist()):
                x = matrix([q["x"] for q in queries], space.dim)
                far = space.distances(x, True)[:, pivot]
                least = np.maximum(0, np.maximum(far - hi, lo - far))
                turn = np.argsort(least.min(axis=0), kind="stable")[begin:end]
                scores: dict[tuple, list[int]] = {}
                for f in floors or []:
                    scores.setdefault(f["query"], []).append(f["score"])
                reach = np.full(len(x), np.inf)
                for i, q in enumerate(queries):
                    found = scores.get(_name(q), [])
                    if len(found) >= k:
                        reach[i] = np.sqrt(max(0.0, float(x[i] @ x[i]) + space.norm2 - 2 * min(found))) + slack
                chosen = [a for a in turn if (least[:, a] <= reach).any()]
                if chosen:
                    yield batch_of({"group": [group] * len(chosen), "pivot": [annuli[a][0] for a in chosen], "ring": [annuli[a][1] for a in chosen]}, schema)

    return groups.mapInArrow(choose, "group bigint, pivot int, ring int")


def _name(query: dict) -> bytes:
    """A query is its id and its vector."""
    return query["id"].to_bytes(8, "little", signed=True) + query["x"]


def _search(visits: DataFrame, groups: DataFrame, stored: DataFrame, space: Space, k: int) -> DataFrame:
    """The k best of each visited block for each query of the group."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("group", pa.int64()), ("query", pa.binary())])
    joined = visits.join(stored, ["pivot", "ring"]).join(groups.select("group", "queries"), "group").select("group", "queries", "vectors")

    def search(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                group, queries, vectors = (batch.column(c)[r].as_py() for c in ("group", "queries", "vectors"))
                ids = [v["id"] for v in vectors]
                own: dict[int, list[int]] = {}
                for i, at in enumerate(ids):
                    own.setdefault(at, []).append(i)
                scores = products(matrix([q["x"] for q in queries], space.dim), matrix([v["x"] for v in vectors], space.dim), space.top)
                rows = []
                for q, line in zip(queries, scores):
                    out = own.get(q["id"], [])
                    names = ids
                    if out:
                        line, names = np.delete(line, out), [v for i, v in enumerate(ids) if i not in set(out)]
                    rows += [(q["id"], names[i], int(line[i]), group, _name(q)) for i in best(line, names, k)]
                if rows:
                    yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    return joined.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint, group bigint, query binary")
