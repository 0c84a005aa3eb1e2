"""Merkle manifest of a dataset: a tree per source, a tree of their roots, and proofs out of an append log.

Every tree joins runs of three neighbours level by level until one node is left; the last run of a level may be
shorter, even a single node. Its nodes are written in completion order (postorder). That order needs no index: node
``at`` of level ``l`` ends with leaf ``e = min((at + 1) * 3^l, n)``; of a level ``i <= l`` the nodes up to
``ceil(e / 3^i)`` are complete by then, of a higher level those that end before it begins, ``floor(at / 3^(i - l))``.
The sum, less one, is its position, so a builder knows where its aligned block goes and a reader where siblings are.

Builders take blocks of ``3^LEVELS`` leaves, so no tree is one task. The nodes they end with are the leaves of the next
tier, until a tree is one block. A segment of the log is one block's nodes, contiguous in its tier's postorder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import new_folder
from tidemark.operators.ordering import row_numbers
from tidemark.session import materialize, ship

#: Nodes that are joined to one, and levels that one builder closes.
RUN, LEVELS = 3, 6
BLOCK = RUN**LEVELS
#: Trees whose starts are broadcast; with more of them the join is shuffled.
SMALL = 1_000_000
BYTES = 32
STEP = "struct<before:string,after:string>"


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def position(level: int, at, n: int):
    """Postorder position of node ``at`` (a number or an array) of ``level`` in a tree of ``n`` leaves."""
    end = np.minimum((at + 1) * RUN**level, n)
    below = sum(-(-end // RUN**i) for i in range(level + 1))
    return below + sum(at // RUN ** (i - level) for i in range(level + 1, height(n) + 1)) - 1


def joined(nodes: Iterable[bytes]) -> bytes:
    """Digest of the nodes' hex digests, concatenated."""
    return sha256("".join(n.hex() for n in nodes).encode()).digest()


def postorder(leaves: Iterable[bytes], levels: int) -> Iterator[bytes]:
    """The leaves and the nodes up to ``levels`` above them, each as soon as it is complete."""
    waiting: list[list[bytes]] = [[] for _ in range(levels)]
    for leaf in leaves:
        yield leaf
        node = leaf
        for run in waiting:
            run.append(node)
            if len(run) < RUN:
                break
            node = joined(run)
            run.clear()
            yield node
    for level, run in enumerate(waiting):
        if run:
            node = joined(run)
            yield node
            if level + 1 < levels:
                waiting[level + 1].append(node)


def levels_of(n: int) -> int:
    """Levels that the builders of a tier with ``n`` leaves close: all, if one block holds them."""
    return LEVELS if n > BLOCK else height(n)


def segments(nodes: DataFrame) -> DataFrame:
    """The log of one tier from ``tree``, ``at``, ``n`` (leaves of the tree), ``digest`` (binary) and ``entry``.

    One row per aligned block: ``tree``, ``n``, ``block``, ``start`` (position of its first node), ``nodes`` (32 bytes
    each, in order of completion) and ``entries`` of its leaves.
    """
    kind = nodes.schema["entry"].dataType
    out = f"tree bigint, n bigint, block bigint, start bigint, nodes binary, entries array<{kind.simpleString()}>"

    def append(batches):
        key, digests, entries = None, [], []

        def segment():
            tree, n, block = key
            held = pa.chunked_array(entries).combine_chunks()
            held = pa.concat_arrays(held.chunks) if isinstance(held, pa.ChunkedArray) else held
            body = b"".join(postorder(digests, levels_of(n)))
            start = int(position(0, block * BLOCK, n))
            columns = [pa.array([v], pa.int64()) for v in (tree, n, block, start)]
            lists = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held)
            return pa.RecordBatch.from_arrays([*columns, pa.array([body], pa.binary()), lists], ["tree", "n", "block", "start", "nodes", "entries"])

        for batch in batches:
            if not batch.num_rows:
                continue
            trees, blocks = batch.column("tree").to_numpy(), batch.column("at").to_numpy() // BLOCK
            edges = np.flatnonzero((np.diff(trees) != 0) | (np.diff(blocks) != 0)) + 1
            for first, stop in zip([0, *edges], [*edges, batch.num_rows]):
                found = (int(trees[first]), batch.column("n")[int(first)].as_py(), int(blocks[first]))
                if key is not None and found != key:
                    yield segment()
                    digests, entries = [], []
                key = found
                digests += batch.column("digest").slice(first, stop - first).to_pylist()
                entries.append(batch.column("entry").slice(first, stop - first))
        if key is not None:
            yield segment()

    block = F.floor(F.col("at") / BLOCK).cast("bigint")
    dealt = nodes.withColumn("_block", block).repartition("tree", "_block").sortWithinPartitions("tree", "at")
    return dealt.select("tree", "at", "n", "digest", "entry").mapInArrow(append, out)


def _ends(log: DataFrame) -> Column:
    """The last node of a segment."""
    return F.substring(F.col("nodes"), -BYTES, BYTES)


def write_log(nodes: DataFrame, folder: str) -> list[DataFrame]:
    """The tiers of the log of all trees in ``nodes``, written to ``folder`` and read back, lowest first."""
    spark, tiers = nodes.sparkSession, []
    while True:
        path = f"{folder}/tier-{len(tiers)}"
        segments(nodes).write.parquet(path)
        tiers.append(spark.read.parquet(path))
        open_trees = tiers[-1].where(F.col("n") > BLOCK)
        if open_trees.isEmpty():
            return tiers
        up = F.ceil(F.col("n") / BLOCK).cast("bigint")
        nodes = open_trees.select("tree", F.col("block").alias("at"), up.alias("n"), _ends(open_trees).alias("digest"), F.struct(F.lit(0).alias("none")).alias("entry"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """``tree`` and the ``digest`` of its root."""
    done = [t.where(F.col("n") <= BLOCK).select("tree", _ends(t).alias("digest")) for t in tiers]
    for more in done[1:]:
        done[0] = done[0].unionAll(more)
    return done[0]


def _siblings(body: bytes, n: int, block: int, start: int) -> list[list[tuple[str, str]]]:
    """For each leaf of a segment, level by level, the siblings on its left and on its right."""
    digest = lambda place: body[BYTES * place : BYTES * (place + 1)].hex()
    leaves = min(BLOCK, n - block * BLOCK)
    steps: list[list[tuple[str, str]]] = []
    for level in range(levels_of(n)):
        first, stop = block * BLOCK // RUN**level, -(-(block * BLOCK + leaves) // RUN**level)
        places = position(level, np.arange(first, stop), n) - start
        here = [digest(int(p)) for p in places]
        of_run = lambda i: (i - (first + i) % RUN, min(i - (first + i) % RUN + RUN, len(here)))  # noqa: B023, E731
        steps.append([("".join(here[a:i]), "".join(here[i + 1 : b])) for i, (a, b) in ((i, of_run(i)) for i in range(len(here)))])
    offset = [block * BLOCK // RUN**level for level in range(len(steps))]
    return [[steps[level][(block * BLOCK + i) // RUN**level - offset[level]] for level in range(len(steps))] for i in range(leaves)]


def _paths(tier: DataFrame, above: DataFrame) -> DataFrame:
    """``tree``, ``at``, ``digest`` (hex), ``entry``, ``subroot`` and ``steps`` of each leaf of a tier.

    ``above`` has one row per segment (``tree``, ``block``): the ``subroot`` and the ``more`` steps from the segment's
    last node up.
    """
    kind = tier.schema["entries"].dataType.simpleString()
    out = f"tree bigint, block bigint, subroot string, more array<{STEP}>, entries {kind}, leaves array<struct<at:bigint,digest:string,steps:array<{STEP}>>>"

    def extract(batches):
        step = pa.struct([("before", pa.string()), ("after", pa.string())])
        leaf = pa.struct([("at", pa.int64()), ("digest", pa.string()), ("steps", pa.list_(step))])
        for batch in batches:
            for i in range(batch.num_rows):
                n, block, start, body = (batch.column(c)[i].as_py() for c in ("n", "block", "start", "nodes"))
                first = block * BLOCK
                leaves = []
                for j, steps in enumerate(_siblings(body, n, block, start)):
                    place = int(position(0, first + j, n)) - start
                    leaves.append({"at": first + j, "digest": body[BYTES * place : BYTES * (place + 1)].hex(), "steps": [{"before": a, "after": b} for a, b in steps]})
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*(row.column(c) for c in ("tree", "block", "subroot", "more", "entries")), pa.array([leaves], pa.list_(leaf))], ["tree", "block", "subroot", "more", "entries", "leaves"])

    rows = tier.join(above, ["tree", "block"]).select("tree", "n", "block", "start", "nodes", "subroot", "more", "entries")
    each = rows.mapInArrow(extract, out).select("tree", "subroot", "more", F.explode(F.arrays_zip("entries", "leaves")).alias("_of"))
    steps = F.concat("_of.leaves.steps", "more")
    return each.select("tree", "_of.leaves.at", "_of.leaves.digest", F.col("_of.entries").alias("entry"), "subroot", steps.alias("steps"))


def paths(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of all leaves. ``above`` has ``tree``, ``subroot`` and the ``more`` steps from each tree's root up.

    Tiers are read from the top: what a segment's last node needs is one row of the tier above it, so whole paths meet
    segments, not leaves, and a large tree's key is spread over its blocks.
    """
    found = None
    for tier in reversed(tiers):
        ends = tier.where(F.col("n") <= BLOCK).select("tree", "block").join(above, "tree").select("tree", "block", "subroot", "more")
        if found is not None:
            ends = ends.unionAll(found.select("tree", F.col("at").alias("block"), "subroot", F.col("steps").alias("more")))
        found = _paths(tier, ends)
    return found


def leaf_digest(fields: list[Column]) -> Column:
    """Hex digest of a row: ``-`` for a null field, else its UTF-8 byte count, a colon and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text]).cast("binary"), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256))


def proof_digest(steps: Column) -> Column:
    """Hex digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "").cast("binary"), 256)


def manifest(leaves: DataFrame, folder: str | None = None) -> DataFrame:
    """Proofs of all rows of ``leaves``: ``entry``, ``leaf``, ``subroot``, ``root`` and ``steps``, read from the log.

    ``leaves`` has ``source`` (null is a source of its own, the first), ``id`` (leaves ascend by it, null first), ``leaf``
    (hex digest) and ``entry`` (a struct that goes along). Rows equal in source and id are ordered by their digest; equal
    digests are interchangeable. The log goes to ``folder``, below it the sources' trees and the tree of their roots.
    Without rows the result is empty.
    """
    spark = leaves.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "manifest")
    # The row's number tells copies of one row apart, so they need not share a partition.
    stored = materialize(leaves.withColumn("_copy", F.monotonically_increasing_id()))
    numbered = row_numbers(stored, [F.col("source"), F.col("id"), F.col("leaf"), F.col("_copy")], "_row")
    per_source = materialize(numbered.groupBy("source").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("n")))
    trees = materialize(row_numbers(per_source, [F.col("source")], "tree").withColumn("tree", F.col("tree") - 1).withColumnRenamed("source", "_source"))
    sources = trees.count()
    known = F.broadcast(trees) if sources <= SMALL else trees
    placed = numbered.join(known, numbered["source"].eqNullSafe(known["_source"]))
    nodes = placed.select("tree", (F.col("_row") - F.col("_first")).alias("at"), "n", F.unhex("leaf").alias("digest"), "entry")
    tiers = write_log(nodes, f"{folder}/sources")
    tops = roots(tiers)
    one = tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(sources).cast("bigint").alias("n"), "digest", F.struct(F.lit(0).alias("none")).alias("entry"))
    top = write_log(one, f"{folder}/roots")
    # One row, or none.
    root = next((bytes(r["digest"]).hex() for r in roots(top).collect()), None)
    nothing = spark.createDataFrame([(0, root, [])], f"tree bigint, subroot string, more array<{STEP}>")
    of_roots = materialize(paths(top, nothing).select(F.col("at").alias("tree"), F.col("digest").alias("subroot"), F.col("steps").alias("more")))
    return paths(tiers, of_roots).select("entry", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "steps")


#: What a document's leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def verified_documents(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and what it says of rows that were tampered with since.

    Per row: ``doc_id``, its ``leaf``, ``subroot``, ``root``, ``proof_sha256``, the ``folded_root`` of the row as it is
    now, and whether that is the root (``verified``). Where crc32 of the id as text is even, the line feeds of the text
    are gone now. A null id is never tampered with; null texts stay null. Repeated rows have a leaf each. Extra columns
    are no part of a leaf.
    """
    fields = {f: docs[f"`{f}`"] for f in FIELDS}
    now = fields | {"text": F.replace(fields["text"], F.lit("\n"), F.lit(""))}
    touched = F.coalesce(F.crc32(fields["doc_id"].cast("string").cast("binary")) % 2 == 0, F.lit(False))
    entry = F.struct(fields["doc_id"].alias("doc_id"), F.when(touched, leaf_digest(list(now.values()))).alias("now"))
    leaves = docs.select(fields["source"].alias("source"), fields["doc_id"].alias("id"), leaf_digest(list(fields.values())).alias("leaf"), entry.alias("entry"))
    found = manifest(leaves)
    again = found.select("entry.doc_id", "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"), folded(F.coalesce("entry.now", "leaf"), F.col("steps")).alias("folded_root"))
    return again.withColumn("verified", F.col("folded_root") == F.col("root"))
