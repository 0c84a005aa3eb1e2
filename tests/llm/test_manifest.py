"""Manifest and vector codes against plain versions."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from tidemark.llm import codes, merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, at string, n string, entry string, leaf string, _row string"


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return hashed(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes):
    return [hashed(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]


def proof(nodes, at):
    """Siblings before and after, level by level, and the root."""
    steps = []
    while len(nodes) > 1:
        run = at - at % 3
        steps.append((nodes[run:at], nodes[at + 1 : run + 3]))
        nodes, at = up(nodes), at // 3
    return steps, nodes[0]


def plain(rows):
    """The contract over (doc_id, source, lang, n_chars, text), by recursion over whole lists."""
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf_of(r))) for s in sources}
    tops = [proof([leaf_of(r) for r in trees[s]], 0)[1] for s in sources]
    out = []
    for number, s in enumerate(sources):
        for at, r in enumerate(trees[s]):
            inner, subroot = proof([leaf_of(x) for x in trees[s]], at)
            outer, root = proof(tops, number)
            now = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = (*r[:4], r[4].replace("\n", ""))
            node = leaf_of(now)
            for before, after in inner + outer:
                node = hashed(*before, node, *after)
            out.append((r[0], leaf_of(r), subroot, root, hashed(*[h for a, b in inner + outer for h in a + b]), node, node == root))
    return sorted(out, key=repr)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def results(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_positions_are_those_of_the_postorder():
    for n in [*range(1, 60), 81, 82, 243, 244]:
        levels = merkle.height(n)
        names = [bytes([0]) * 28 + i.to_bytes(4, "big") for i in range(n)]
        log = list(merkle.postorder(iter(names), levels))
        nodes = names
        for level in range(levels + 1):
            for at, node in enumerate(nodes):
                assert log[int(merkle.position(level, at, n))] == node
            nodes = [merkle.joined(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        assert len(log) == merkle.position(levels, 0, n) + 1


def test_small_tables(spark):
    rows = [
        (1, "b", "en", 3, "a\nb"), (2, "b", None, None, None), (3, "b", "en", 1, ""), (3, "b", "en", 1, ""), (None, "b", "en", 2, "x\n"), (None, None, None, None, None),
        (4, "ä", "en", 2, "é\n"), (5, "", "en", 1, "q"), (6, None, "en", 4, "l\nl\nm" * 50_000), (7, "b", "de", 5, "zz\n"), (2**62, "c", "de", 5, "\n\n"), (-3, "c", "de", 5, "\n\n"),
    ]
    assert results(merkle.verified_documents(table_of(spark, rows))) == plain(rows)
    assert results(merkle.verified_documents(table_of(spark, rows[:1]))) == plain(rows[:1])
    assert merkle.verified_documents(table_of(spark, [])).collect() == []


def test_several_tiers(spark, monkeypatch):
    """With blocks of nine leaves a hot source needs four tiers, the tree of sources two."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, "hot" if i % 3 else f"s{i % 31}", "en", i, f"text {i}\n") for i in range(1500)]
    rows += [(5, "hot", "en", 5, "text 5\n")] * 20
    assert results(merkle.verified_documents(table_of(spark, rows))) == plain(rows)


def test_one_block_of_whole_size(spark):
    rows = [(i, "s", "en", i, f"t{i}\n") for i in range(merkle.BLOCK + 1)]
    assert results(merkle.verified_documents(table_of(spark, rows))) == plain(rows)


def plain_codes(vectors):
    """``vectors``: (id, list, label), all whole and of one length."""
    x = {i: [int(np.floor(1024 * v)) for v in vec] for i, (_, vec, _) in enumerate(vectors)}
    width = len(x[0]) // 4
    part = lambda i, p: x[i][p * width : (p + 1) * width]
    order = sorted((k, vec, i) for i, (k, vec, _) in enumerate(vectors) if k is not None)
    first = [i for n, (k, _, i) in enumerate(order) if n == 0 or order[n - 1][0] != k][:256]
    books = [[part(i, p) for i in first] for p in range(4)]
    gap = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b))
    nearest = lambda a, book: min((gap(a, e), n) for n, e in enumerate(book))
    for _ in range(4):
        for p in range(4):
            of = [nearest(part(i, p), books[p])[1] for i in x]
            for n in range(len(books[p])):
                mine = [part(i, p) for i in x if of[i] == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[nearest(part(i, p), books[p]) for p in range(4)] for i in x]
    errors = [sum(d for d, _ in f) for f in found]
    digest = sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(
        [(k, "".join(f"{n:02x}" for _, n in f), e, sum(o for o, (_, _, t) in zip(errors, vectors) if t == label), digest) for (k, _, label), f, e in zip(vectors, found, errors)], key=repr
    )


KINDS = "vec_id bigint, embedding array<float>, label int, key string, error string, vector string"


def coded(spark, vectors):
    df = codes.compressed(spark.createDataFrame([(*v, "x", "x", "x") for v in vectors], KINDS))
    return sorted((tuple(r[c] for c in ("vec_id", "code", "error", "label_error", "codebooks_sha256")) for r in df.collect()), key=repr)


def test_codes(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(v) for v in rng.normal(0, 0.2, 12).astype(np.float32)], i % 4 if i % 5 else None) for i in range(300)]
    vectors += [vectors[7]] * 3 + [(7, [0.5] * 12, 1), (None, [0.25] * 12, 2), (400, [-0.0] * 12, None)]
    bad = [(900, None, 1), (901, [None] + [0.0] * 11, 1), (902, [float("nan")] * 12, 1), (-903, [float("inf")] * 12, 1)]
    assert coded(spark, vectors + bad) == plain_codes(vectors)
    assert coded(spark, vectors[:3]) == plain_codes(vectors[:3])
    assert coded(spark, bad) == [] and coded(spark, []) == []


def test_shorter_vectors_are_filled_up(spark):
    full = [(1, [0.5, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (2, [0.0] * 8, 1), (3, [0.25] + [0.0] * 7, None)]
    short = [(1, [0.5, 1.0, 0.0, 0.0, 0.0], 1), (2, [], 1), (3, [0.25], None)]
    assert coded(spark, short) == plain_codes(full)


def test_too_large_components_are_named(spark):
    with pytest.raises(ValueError, match="64 bits"):
        coded(spark, [(1, [3e38] * 4, 1)])


def test_transform_keeps_distances():
    rng = np.random.default_rng(1)
    for length in (1, 2, 3, 5, 16, 21):
        top = codes.largest_component(length)
        for scale in (600, top - 1):
            rows, entries = rng.integers(-scale, scale, (70, length)), rng.integers(-scale, scale, (40, length))
            entries[20] = entries[3]
            found, distance = codes.nearest(codes.walsh_hadamard(rows), codes.walsh_hadamard(entries))
            for r, f, d in zip(rows.tolist(), found, distance):
                gaps = [sum((a - b) ** 2 for a, b in zip(r, e)) for e in entries.tolist()]
                assert (d, f) == (min(gaps), gaps.index(min(gaps)))
    order = codes.sequency_order(8)
    signs = np.array([[(-1) ** bin(i & j).count("1") for j in range(8)] for i in range(8)])
    assert [(np.diff(signs[i]) != 0).sum() for i in order] == list(range(8))
