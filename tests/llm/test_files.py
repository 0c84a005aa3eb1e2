"""Round trips of archives and token files."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import documents, prose
from tidemark.llm import tokens, warc
from tidemark.llm.files import new_folder, store

PAGES = "page_id bigint, url string, html string, payload string, record_type string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x") for i, u, h in rows], PAGES)


def test_pages_come_back(spark):
    big, other = "ü" * 600, "b" * 1000
    rows = [(1, "http://a/\r\nX: y", big), (5, "http://b", big), (5, None, big), (3, "u", other), (None, "n", other), (None, "m", "c" * 2000),
            (7, "e", ""), (8, "z", None), (9, "s", "small"), (10, "t", "small"), (11, "l", prose(random.Random(2), 60_000))]
    got = warc.archived_pages(pages(spark, rows)).collect()
    kinds = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        best = max([p for p, _, h in rows if h == html and p is not None], default=None)
        again = len(data) >= 1000 and best is not None and i != best
        want.append((str(i), len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", str(best if again else None)))
    assert kinds == sorted(want)
    assert "http://a/%0D%0AX: y" in {r["url"] for r in got}
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_filters_and_columns_reach_the_reader(spark):
    folder = new_folder(spark, "warc")
    warc.write_warc(warc.with_revisits(pages(spark, [(1, "a", "x" * 1500), (2, "b", "x" * 1500), (3, "c", "y")])), folder)
    revisits = warc.read_warc(spark, folder, payload=False).where("record_type = 'revisit' AND page_id IN (1, 2)")
    assert [(r["page_id"], r["refers_to"]) for r in revisits.collect()] == [(1, 2)]
    reader = warc.WarcReader(folder, ["page_id", "payload"])
    from pyspark.sql.datasource import EqualTo, GreaterThan

    kept = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("page_id",), 2)]))
    assert kept == [GreaterThan(("page_id",), 2)]
    assert sorted(r["page_id"].as_py() for p in reader.partitions() for b in reader.read(p) for r in [{"page_id": x} for x in b.column("page_id")]) == [2, 3]


def test_headers_come_first(spark):
    """Records that a filter leaves out, and reads without payloads, inflate no payload."""
    from pyspark.sql.datasource import EqualTo

    folder, noise = new_folder(spark, "warc"), random.Random(4)
    bodies = ["".join(noise.choices("abcdefghij", k=200_000)) for _ in range(5)]
    rows = [(i, "u" * (3000 if i == 2 else 5), b) for i, b in enumerate(bodies)] + [(9, "v", bodies[0])]
    warc.write_warc(warc.with_revisits(pages(spark, rows)), folder)
    for wanted, tests, want in ((["page_id"], [], 6), (["page_id", "payload"], [EqualTo(("record_type",), "revisit")], 1)):
        reader = warc.WarcReader(folder, wanted)
        assert list(reader.pushFilters(tests)) == []
        assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == want
    inflated = [len(begin) for name, _ in warc.listed(folder) for begin, _ in warc.records(folder, name)]
    assert len(inflated) == 6 and max(inflated) <= 4096 + warc.HEAD_BYTES
    for name, _ in warc.listed(folder):
        for begin, whole in warc.records(folder, name):
            fields, at = warc.headers(begin)
            if fields["warc-type"] == "response":
                assert warc.payload_of(whole(), at, fields).decode() in bodies
    # A cut member raises, a file without an index is read all the same.
    system, path = store(folder)
    for name, size in warc.listed(folder):
        with system.open_input_file(f"{path}/{name}") as file:
            data = file.read()
        for cut, expected in ((size, None), (size - 20, ValueError)):
            other = new_folder(spark, "warc")
            with warc.create(other, name) as out:
                out.write(data[:cut])
            if expected is None:
                assert [whole() for _, whole in warc.records(other, name)] == [whole() for _, whole in warc.records(folder, name)]
            with system.open_input_file(f"{path}/{name}.idx") as index, warc.create(other, name + ".idx") as out:
                out.write(index.read())
            if expected:
                with pytest.raises(expected):
                    [whole() for _, whole in warc.records(other, name)]


def test_appends_keep_what_is_there(spark):
    folder = new_folder(spark, "warc")
    for page in (1, 2):
        warc.write_warc(warc.with_revisits(pages(spark, [(page, "a", "x")])), folder)
    assert sorted(r["page_id"] for r in warc.read_warc(spark, folder).collect()) == [1, 2]


def test_unfinished_folders_are_refused(spark):
    with pytest.raises(Exception, match="no finished archives"):
        warc.read_warc(spark, new_folder(spark, "warc")).collect()


def test_broken_member_is_refused():
    import io

    record = warc.record_bytes(1, "response", "u", "0" * 40, 1, None, b"x")
    packed = zlib.compressobj(5, zlib.DEFLATED, 31)
    data = packed.compress(record) + packed.flush()
    assert list(warc.members(io.BytesIO(data + data), 50)) == [record, record]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(data[:-20]), 50))


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


def test_pieces_encode_as_whole_texts(vocabulary):
    encoder = tokens.Encoder(vocabulary)
    rng = random.Random(3)
    texts = ["", " ", "  ", "a  b", "a   b", "a \n b", "a\n  b", "x. y, z.\nw", "..", " .", "it's  'll", "<|endoftext|> x", "ab　 c", None]
    texts += ["".join(rng.choice(" \n\t.,ab1é'’́ ×字!\0") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    got = [ids.tolist() for ids in encoder.encode(pa.array(texts))]
    want = [np.frombuffer(b, encoder.kind).tolist() for b in encoder.whole([t or "" for t in texts])]
    assert got == want


def test_token_files(spark, vocabulary):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    texts = [(i, prose(rng, rng.randint(0, 40))) for i in range(300, 0, -3)] + [(None, "no id"), (5, None), (7, ""), (9, "twice"), (9, "twice"), (9, "other"), (11, prose(rng, 40_000))]
    docs = documents(spark, texts)
    folder = new_folder(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, vocabulary)
    rows = tokens.read_tokens(manifest, folder).collect()
    plain = Tokenizer.from_file(vocabulary)
    ids = {r["start"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rows}
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += len(ids[at])
    ordered = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ordered == sorted([i for i, _ in texts], key=lambda i: (i is not None, i or 0))
    coded = sorted([(str(i), plain.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID]) for i, t in texts])
    assert sorted((str(r["doc_id"]), ids[r["start"]]) for r in rows) == coded
    shuffled = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in tokens.read_tokens(manifest, folder, seed=1).collect()]
    assert sorted(map(str, shuffled)) == sorted(str((r["doc_id"], r["start"], bytes(r["ids"]))) for r in rows)
    assert [s[1] for s in shuffled] != [r["start"] for r in rows]
    checks = tokens.token_records(docs, vocabulary).where("doc_id = 7").first()
    assert (checks["n_tokens"], checks["ids_crc32"]) == (1, zlib.crc32(np.array([2], "<u4").tobytes()))
    assert tokens.token_records(documents(spark, []), vocabulary).count() == 0


def test_damage_is_found(spark, vocabulary):
    folder = new_folder(spark, "tokens")
    manifest = tokens.write_tokens(documents(spark, [(1, "some words here")]), folder, vocabulary)
    name = manifest.first()["file"]
    system, path = store(folder)
    with system.open_input_file(f"{path}/{name}.rec") as file:
        data = bytearray(file.read())
    data[-6] ^= 1
    with system.open_output_stream(f"{path}/{name}.rec") as file:
        file.write(bytes(data))
    with pytest.raises(Exception, match="damaged record"):
        tokens.read_tokens(manifest, folder).collect()


def test_manifest_sums(spark, vocabulary):
    folder = new_folder(spark, "tokens")
    row = tokens.write_tokens(documents(spark, [(i, "a b c") for i in range(50)]), folder, vocabulary).agg(F.sum("documents"), F.sum("tokens")).first()
    assert row[0] == 50 and row[1] == 200
    assert tokens.read_tokens(tokens.read_manifest(spark, folder), folder).count() == 50
