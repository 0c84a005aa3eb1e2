"""Near-duplicates, decontamination, mixing and toxicity against plain versions."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from helpers import CLASHING, WORDS, classes, documents, prose, shingles

from tidemark.llm import decontam, graph, mixing, neardup, toxicity


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups of copies that chain at about the threshold, a shared passage, short, empty and repeated rows."""
    rng = random.Random(5)
    texts, shared = [], prose(rng, 60)
    for _ in range(6):
        base = prose(rng, rng.randint(20, 160))
        texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(rng.randint(2, 12))]
    hub = prose(rng, 150)
    texts += [edited(rng, hub, rng.randint(1, 9)) for _ in range(160)]
    texts += [f"{prose(rng, 25)} {shared} {prose(rng, 25)}" for _ in range(40)]
    texts += [None, "", " \n\t", "One two", "one TWO", "one two three four five", "ONE two\nthree four  five", "one", prose(rng, 9_000)]
    texts += [texts[-1] + " more", "É a b c d", "é a b c d"]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_near_duplicates_equal_all_pairs(spark, copies):
    got = {r["doc_id"]: r for r in neardup.near_duplicates(documents(spark, copies)).collect()}
    want = classes(copies)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingles(dict(copies)[i])) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_near_duplicates_of_awkward_rows(spark):
    rng = random.Random(6)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(5, a), (5, b), (7, a), (3, b), (9, "alone here"), (9, "alone here"), (None, a), (None, None), (11, ""), (12, None)]
    got = sorted(str(tuple(r)) for r in neardup.near_duplicates(documents(spark, rows)).select("doc_id", "component_id", "kept").collect())
    assert got == sorted(map(str, [(5, 3, False), (5, 3, False), (7, 3, False), (3, 3, True), (9, 9, True), (9, 9, True),
                                   (None, None, True), (None, None, True), (11, 11, True), (12, 12, True)]))
    kept = neardup.without_duplicates(documents(spark, rows))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["11", "12", "3", "9", "None", "None"]
    assert kept.columns == documents(spark, []).columns
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


def test_blocks_of_large_classes(spark, monkeypatch, copies):
    """Small blocks: every bucket and class is split."""
    monkeypatch.setattr(neardup, "BLOCK", 3)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(documents(spark, copies)).collect()}
    assert got == classes(copies)


def test_similarity_is_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40_000, n, dtype=np.uint64)) for n in (1, 50, 20_000, 30_000)]
    left, right = sets + [sets[2][::2]], [sets[2], sets[3], sets[1][:40]]
    want = [[i, j] for i, a in enumerate(left) for j, b in enumerate(right) if 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b))]
    assert neardup.similar(left, right).tolist() == want


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 300)] + [(500, 501 + i) for i in range(50)]
    got = {r["id"]: r["comp"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100: 90, 95: 90, 90: 90, 200: 200, 300: 200} | {500 + i: 500 for i in range(51)}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


BENCH = "item_id bigint, text string, hash bigint, windows string"


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], BENCH)


QUESTION = "A train travels 120 km in 3 hours and then, says Anna Miller, another 60 km in 3 hours; how fast is the train of Anna Miller overall"


def test_templates(spark):
    rng = random.Random(7)
    same = QUESTION.replace("120", "250").replace("60", "75").replace(" 3 ", " 5 ").replace("Anna Miller", "Olga Brown")
    mixed = QUESTION.replace("in 3 hours and", "in 5 hours and").replace("Anna Miller, another", "Olga Brown, another")
    passage = prose(rng, 60)
    docs = [(1, f"{prose(rng, 30)} {QUESTION} {prose(rng, 30)}"), (2, f"{prose(rng, 30)}. {same} {prose(rng, 20)}"), (3, mixed), (4, prose(rng, 300)),
            (5, passage.upper()), (6, " ".join(w for i, w in enumerate(passage.split(" ")) if i % 12)), (None, passage), (None, prose(rng, 50)), (7, None), (8, ""),
            (9, "one two"), (10, "1 2 3 4 5 6 7 8 9 10 11 12"), (10, passage), (10, passage)]
    items = [(1, QUESTION), (2, passage), (3, "one two"), (4, None), (5, ""), (None, passage), (6, "1 2 3 4 5 6 7 8 9 10 11 12"), (2, passage)]
    table = documents(spark, docs)
    got = decontam.leaks(table, bench(spark, items)).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in got) == [("1", 1), ("10", 2), ("2", 1), ("5", 2), ("6", 2), ("None", 2)]
    left = decontam.without_leaks(table, bench(spark, items))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["3", "4", "7", "8", "9", "None"]
    assert left.columns == table.columns
    assert decontam.leaks(documents(spark, []), bench(spark, items)).count() == 0
    assert decontam.without_leaks(table, bench(spark, [])).count() == len(docs)


MARBLES = (
    "A bag on the shelf of the old shop holds 3 red marbles and 3 blue marbles while a second bag beside it holds only green "
    "ones so how many marbles must a child draw without looking to be sure"
)
WALK = (
    "Two friends walk along the river for 2 hours before lunch and for 3 hours after it while their dog runs ahead and comes "
    "back again so how long did the whole walk take them"
)


def test_templates_with_one_value_in_two_roles(spark):
    """Windows whose slots contradict do not count, the others of the run do."""
    rng = random.Random(11)
    asked = [
        (1, MARBLES.replace("3 red", "4 red").replace("3 blue", "5 blue")), (2, WALK.replace("2 hours", "1 hour")),
        (3, MARBLES.replace("3 red", "7 red")), (4, WALK.replace("2 hours", "40 minutes").replace("3 hours", "2 days")),
    ]
    docs = [(i, f"{prose(rng, 20)} {t} {prose(rng, 20)}") for i, t in asked] + [(5, prose(rng, 80))]
    got = decontam.leaks(documents(spark, docs), bench(spark, [(1, MARBLES), (2, WALK)])).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    assert all(r["shared"] <= r["windows"] for r in got)
    # The contradicting windows are no evidence.
    assert {r["doc_id"]: r["shared"] < r["windows"] for r in got}[1]


LONG = prose(random.Random(21), 400)
TITLE = (
    "The Old Keeper Of The Northern Light Walks Down To The Harbour Every Morning And Counts The Boats That Came In During "
    "The Night So Which Boat Is The One He Never Sees Again"
)
SUM = "Compute 12 + 7 * 3 - 4"


def test_excerpts_and_items_without_evidence(spark):
    """A long piece of a long item is a leak; an item without evidence windows must be there word by word."""
    rng = random.Random(12)
    words = LONG.split(" ")
    parts = [(1, " ".join(words[100:250])), (2, " ".join(words[100:109])), (3, TITLE), (4, TITLE.lower()), (5, SUM), (6, SUM.replace("7", "8")),
             (7, TITLE.replace("Harbour", "Market"))]
    docs = [(i, f"{prose(rng, 20)} {t} {prose(rng, 20)} 5 km") for i, t in parts] + [(8, prose(rng, 300)), (9, "Compute 12"), (10, SUM)]
    items = [(1, LONG), (2, TITLE), (3, SUM), (3, SUM.replace("12", "13"))]
    got = decontam.leaks(documents(spark, docs), bench(spark, items)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (3, 2), (4, 2), (5, 3), (10, 3)]
    assert all(0 < r["shared"] <= r["windows"] for r in got)


def test_large_benchmarks_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert [r["doc_id"] for r in decontam.leaks(documents(spark, [(1, QUESTION)]), bench(spark, [(1, QUESTION)])).collect()] == [1]


def test_targets_fill_to_the_limit():
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, None: 300}
    targets = mixing.weighted_targets(sizes)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert all(targets[s] <= 3 * sizes[s] for s in sizes)
    share = {s: targets[s] / w for s, w in zip(sizes, (1, 2, 3, 1, 2)) if targets[s] < 3 * sizes[s]}
    assert len({round(v, 9) for v in share.values()}) == 1
    assert mixing.weighted_targets({}) == {} and mixing.weighted_targets({"a": 0}) == {"a": 0.0}


def test_flow_repeats_as_little_as_it_can():
    capacity = {0: 100, 1: 50, 2: 30}
    members = {0: ["a"], 1: ["a", "b"], 2: ["b"]}
    assert mixing.route(capacity, members, {"a": 100, "b": 80}, 3) == {0: 100, 1: 50, 2: 30}
    assert mixing.route(capacity, members, {"a": 60, "b": 160}, 3)[0] in (10, 60)
    given = mixing.route(capacity, members, {"a": 1000, "b": 1000}, 3)
    assert given == {0: 300, 1: 150, 2: 90}
    assert sum(mixing.route(capacity, members, {"a": 10, "b": 200}, 3).values()) == 210


def test_mixing(spark):
    rng = random.Random(8)
    texts, sources = [], []
    for i in range(900):
        texts.append((i, prose(rng, rng.randint(0, 60))))
        sources.append(None if i % 3 == 0 else rng.choice(["b", "a", "ä", ""]))
    texts += [(4000, None), (None, "no id here"), (None, "no id here"), (7, "again the same id"), (4001, "x")]
    sources += ["a", "a", "a", "a", "tiny"]
    docs = documents(spark, texts, sources)
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(texts)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(docs.repartition(5)).collect()))
    sizes, taken, targets = Counter(), Counter(), {}
    by_id = {}
    for (i, t), s in zip(texts, sources):
        sizes[s] += len(WORDS.findall(t or ""))
        by_id.setdefault(i, s)
    for r in rows:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        if r["doc_id"] not in (7, None):
            targets[by_id[r["doc_id"]]] = r["target"]
    want = mixing.weighted_targets({s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))})
    assert targets == want
    sums = Counter()
    for r in rows:
        sums[(r["target"], r["source_size"])] += r["taken"]
    for (target, _), words in sums.items():
        assert abs(words - target) <= max(3, 0.02 * target)
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["taken"] // r["size"] for r in rows if r["size"])
    assert mixing.mix_sources(documents(spark, [])).count() == 0


def test_a_target_is_met_beside_a_long_document(spark):
    """Three copies of the short documents fill what the long one leaves open; ids may repeat."""
    rng = random.Random(3)
    texts = [(i, "a " * 100) for i in range(200)] + [(200, "b " * 100_000)] + [(1000 + i, "c " * rng.randint(1, 400)) for i in range(60)]
    texts += [(2000 + i // 3, "d " * rng.randint(0, 90)) for i in range(90)] + [(3000, "e " * 50_000)]
    sources = ["s"] * 201 + ["t"] * 60 + ["u"] * 90 + ["v"]
    rows = mixing.sources_mixed(documents(spark, texts, sources)).collect()
    for r in rows:
        missing = int(r["target"]) - r["taken"]
        assert missing >= 0 and r["most"] <= 3 and (r["source"] == "u" or r["room"] is None or r["room"] > missing)
    of = {r["source"]: r for r in rows}
    assert of["s"]["taken"] in (60_000, int(of["s"]["target"]) // 100 * 100) and int(of["u"]["target"]) - of["u"]["taken"] < 270


def test_overlapping_sources(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(i, prose(random.Random(i), 10)) for i in range(300)])
    both = F.when(docs["doc_id"] % 3 == 0, F.array(F.lit("a"), F.lit("b"))).when(docs["doc_id"] % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("b")))
    mixed = mixing.mix(docs, both)
    total = mixed.select(F.sum(F.col("size") * F.col("copies"))).first()[0]
    assert abs(total - 3000) <= 60


INSULTS = ["zoggart", "zoggish", "blimfut", "blimmer"]


def labelled(rng, n):
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(5, 400)).split(" ")
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(max(2, len(words) // 60)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(9)
    rows = labelled(rng, 900)
    docs = documents(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (5002, "... 12 !"), (None, "zoggart blimfut"), (5003, prose(rng, 20_000)), (5004, "you zoggerd, blimfutt")])
    labels = spark.createDataFrame([(i, 1, x, "x") for i, _, x in rows] + [(None, 1, 1, "x"), (3, 1, None, "x"), (99_999, 1, 1, "x")], "doc_id bigint, quality int, toxic int, text string")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    for i, r in got.items():
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
    held = [(got[i]["predicted"], x) for i, _, x in rows if got[i]["held_out"]]
    assert sum(p == x for p, x in held) / len(held) > 0.97
    assert got[5000]["score"] == got[5001]["score"] == got[5002]["score"] < 0.7
    assert got[5003]["predicted"] == 0 and got[None]["predicted"] == 1
    assert got[5004]["predicted"] == 1  # unseen forms of the words
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}
    none = toxicity.score_toxicity(docs, labels.limit(0))
    assert {r["predicted"] for r in none.collect()} == {0}
    assert toxicity.score_toxicity(documents(spark, []), labels).count() == 0
    assert CLASHING.startswith("doc_id")


def plain_score(text, slopes, bias):
    """The best window of eight words, every one of them added up anew."""
    words = [w for w, _ in itertools.groupby(toxicity.LETTERS.findall(text.lower()))]
    best = None
    for at in range(max(1, len(words) - 7)):
        total, number = 0.0, 0
        for w in words[at : at + 8]:
            codes = np.array([0, *map(ord, w), 0], dtype=np.uint32)
            for n in (3, 4, 5):
                for i in range(len(codes) - n + 1):
                    rolled = 0
                    for c in codes[i : i + n].tolist():
                        rolled = (rolled * 0x01000193 + c) % 2**32
                    total += slopes[((rolled * 0x9E3779B1 + n) % 2**32 * 0x85EBCA6B % 2**32) >> (32 - toxicity.BITS)]
                    number += 1
        mean = total / max(toxicity.FEWEST, number)
        best = mean if best is None or mean > best else best
    return 1 / (1 + np.exp(-(bias + (best if words else 0))))


def test_scores_are_those_of_a_plain_loop():
    rng = random.Random(8)
    slopes = np.random.default_rng(8).normal(0, 30, 1 << toxicity.BITS).astype(np.float32)
    texts = ["", "..", "a", "no no no", "É ß 12 x1y"] + [prose(rng, rng.randint(1, 30)) for _ in range(40)] + ["".join(rng.choices("abé .\n1", k=90)) for _ in range(40)]
    assert np.allclose(toxicity.score_texts(texts, slopes, -0.4), [plain_score(t, slopes, -0.4) for t in texts], atol=1e-5)


def test_repeated_rows_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 40)
    rng = random.Random(2)
    rows = [(i, prose(rng, 30) + (" vilescum rotter" if i % 5 == 0 else "")) for i in range(100)]
    docs = documents(spark, [(1, rows[1][1])] * 500 + rows + [(7, "another text of one id"), (900, "x " * 9_000)])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)] * 3 + [(1, 0)] * 90 + [(3, 1), (None, 1), (900, 0)], "doc_id bigint, toxic int")
    sample = toxicity.training_sample(docs, labels, F.lit(True)).collect()
    ids = [r["_id"] for r in sample]
    assert len(set(ids)) == len(ids) and 3 not in ids and sum(r["_toxic"] for r in sample) == 20 and len(ids) == 60
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 2500)
    assert 900 in [r["_id"] for r in toxicity.training_sample(docs, labels, F.lit(True)).collect()]  # long texts train too
