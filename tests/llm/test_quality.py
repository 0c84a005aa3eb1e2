"""Quality scores: statistics and moments against plain versions, planted texts, awkward tables."""

import random
import re
import zlib

import numpy as np
from helpers import documents, prose
from tidemark.llm import quality

JUNK = [lambda w: w.upper() + "!!", lambda w: w + "###", lambda w: w + " |"]


def test_counts_are_those_of_a_plain_reading(monkeypatch):
    rng = random.Random(4)
    texts = ["", " \n ", "a", "a a a", "x" * 5000, "BUY!! now### | | 12 3.5 (ok) né?"] + ["".join(rng.choices("ab B.!#|\n\t12é", k=rng.randint(1, 400))) for _ in range(60)]
    for piece, span in ((1 << 20, 512), (7, 5)):
        monkeypatch.setattr(quality, "PIECE", piece)
        monkeypatch.setattr(quality, "SPAN", span)
        for text in texts:
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            signs = [c for c in text if not c.isspace()]
            marks = [c for c in signs if c in ".,;:?!'\"-()"]
            lone = [w for w in words if not any(c.isalnum() for c in w)]
            want = [
                len(signs), sum(c.isalpha() for c in signs), sum(c.isupper() for c in signs), sum(c.isdigit() for c in signs), len(marks),
                sum(not c.isalnum() and c not in marks for c in signs), len(words), len(lone),
                sum(len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum() and w not in lone for w in words),
                sum(len(words[i : i + span]) - len(set(words[i : i + span])) for i in range(0, len(words), span)),
                sum(a == b for a, b in zip(words, words[1:])), sum(w[-1] in ".?!" for w in words), text.count("\n"), sum(map(len, words)),
            ]
            assert quality.counts(text) == want, text


def plain_scores(rows, labels):
    """The whole operator in numpy, over all rows at once, but for the choice of shrinkage."""
    counts = np.array([quality.counts(t or "") for _, t in rows])
    column = {n: counts[:, i] for i, n in enumerate(quality.COUNTS)}
    some = column["words"] > 0
    usual = []
    for p, of in quality.SHARES.items():
        steps = np.sort(np.minimum(np.rint(1000 * column[p] / np.maximum(1, column[of])), 20_000)[some])
        usual.append(steps[(len(steps) + 1) // 2 - 1] / 1000)
    x = quality.statistics(counts, np.array(usual)) / quality.GRID
    held = np.array([i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in rows])
    label = np.array([labels.get(i, -1) for i, _ in rows])
    train = {c: x[(label == c) & ~held] for c in (0, 1)}
    both = sum((t - t.mean(axis=0)).T @ (t - t.mean(axis=0)) for t in train.values()) / sum(map(len, train.values()))

    def scores(pooled, rounded):
        logs = []
        for c in (0, 1):
            own = (train[c] - train[c].mean(axis=0)).T @ (train[c] - train[c].mean(axis=0)) / len(train[c])
            cov = (1 - rounded) * ((1 - pooled) * own + pooled * both) + rounded * np.diag(np.diag(both) + 1e-4)
            gap = x - train[c].mean(axis=0)
            logs.append(-0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap))
        return 1 / (1 + np.exp(-np.clip(np.log((len(train[1]) + 1) / (len(train[0]) + 1)) + logs[1] - logs[0], -500, 500)))

    return held, scores


def corpus(n=240):
    rng = random.Random(9)
    rows, labels = [], {}
    for i in range(n):
        text, bad = prose(rng, rng.randint(3, 200)), i % 6 == 0
        if bad:
            spoil = rng.choice(JUNK)
            text = " ".join(spoil(w) for w in text.split())
        rows.append((i, text))
        if i % 5:
            labels[i] = int(not bad)
    return rows, labels


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(quality, "POOLED", (0.1,))
    monkeypatch.setattr(quality, "ROUND", (0.01,))
    rows, labels = corpus()
    rows += [(900, None), (901, ""), (None, "Some plain words here."), (902, "kalo " * 60_000)]
    frame = spark.createDataFrame([*labels.items(), (900, None), (None, 1), (3, None)], "doc_id bigint, quality int")
    found = {(r["doc_id"], r["held_out"]): (r["score"], r["predicted"]) for r in quality.score_quality(documents(spark, rows), frame).collect()}
    held, scores = plain_scores(rows, labels)
    want = scores(0.1, 0.01)
    assert len(found) == len(rows)
    for (i, _), h, s in zip(rows, held, want):
        got = found[i, bool(h)]
        assert abs(got[0] - s) < 1e-6 and got[1] == int(got[0] >= 0.7)
    unseen = [(i, h) for (i, _), h in zip(rows, held) if h and i is not None and i < 240]
    assert sum((found[i, True][1] == 1) == (i % 6 != 0) for i, _ in unseen) >= 0.95 * len(unseen)


def test_repeated_rows_teach_once(spark):
    rows, labels = corpus(120)
    frame = spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")
    once = {r["doc_id"]: r["predicted"] for r in quality.score_quality(documents(spark, rows), frame).collect()}
    twice = frame.unionAll(frame).unionAll(spark.createDataFrame([(1, 0), (1, 1)], frame.schema))
    again = quality.score_quality(documents(spark, rows + [rows[7]] * 2000), twice).collect()
    assert len(again) == len(rows) + 2000
    assert sum(once[r["doc_id"]] == r["predicted"] for r in again) >= len(again) - 2


def test_tables_without_rows_or_classes(spark):
    rows, labels = corpus(30)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.score_quality(documents(spark, []), none).collect() == []
    assert {r["score"] for r in quality.score_quality(documents(spark, rows), none).collect()} == {0.5}
    good = spark.createDataFrame([(i, 1) for i in labels], "doc_id bigint, quality int")
    assert {r["predicted"] for r in quality.score_quality(documents(spark, rows), good).collect()} == {1}
