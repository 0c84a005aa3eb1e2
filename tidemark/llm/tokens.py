"""Token-ID files: length-delimited binary records with masked checksums, and an offset index beside each file.

A record is: length of the payload (unsigned 64 bits), masked checksum of these eight bytes, payload, masked
checksum of the payload. The payload is one byte of flags (1: has an id, 2: wide), the document id (signed 64
bits) and the token ids, 16 bits each, or 32 if the vocabulary is larger than 65,536. All little-endian.
The checksum is CRC-32, rotated right by 15 bits, plus a constant. The index has, per record, its offset
(unsigned 64 bits) and its number of tokens (unsigned 32 bits).
"""

from __future__ import annotations

import gc
import os
import struct
import uuid
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of, small_batches
from tidemark.llm.files import create, new_folder, open_file

END_ID = 2
#: Added to a rotated checksum, so that checksums of data that hold checksums stay apart.
MASK = 0xA282EAD8
HAS_ID, WIDE = 1, 2
INDEX = np.dtype([("offset", "<u8"), ("tokens", "<u4")])
MANIFEST = "part int, file string, documents bigint, tokens bigint, bytes bigint"
CACHED_PIECES = 300_000
# White space as regular expressions write it, and letters and digits on which all Unicode versions agree.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
OTHER = r"[^A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{2AF}]"
#: A blank inside longer white space, or the cut mark itself: such texts are encoded whole.
INSEPARABLE = rf"{SPACE} ({SPACE}|$)|\x00"
#: A point or comma behind neither letter nor digit, a line feed beside white space or an end: cut at blanks only.
LOOSE = rf"(^|{OTHER})[.,]|(^|{SPACE})\n|\n({SPACE}|$)"


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


class Encoder:
    """Encodes texts as the tokenizer does, each distinct piece between blanks once.

    A byte-level tokenizer splits a text before it merges bytes: always before a blank that is not part of longer
    white space, before a point or comma behind a letter or digit, and around a single line feed. So pieces cut there
    can be encoded apart. Other texts, and all texts of other kinds of tokenizers, are encoded whole. Special tokens'
    strings in a text are ordinary text.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind, self.code = np.dtype("<u4" if self.wide else "<u2"), "I" if self.wide else "H"
        split = self.tokenizer.pre_tokenizer
        self.by_piece = isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space and split.use_regex and self.tokenizer.normalizer is None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, e.ids).tobytes() for e in found]

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Encoded pieces, most of them from the cache.

        The cache has a young and an old half. A piece found in the old half moves to the young one, and a full
        young half becomes the old one: frequent pieces stay, single ones go.
        """
        young, old = self.young, self.old
        found = list(map(young.get, texts))
        new = []
        for i, coded in enumerate(found):
            if coded is None:
                text = texts[i]
                coded = old.get(text)
                if coded is None:
                    new.append(i)
                else:
                    found[i] = young[text] = coded
        lost = [texts[i] for i in new]
        for i, text, coded in zip(new, lost, self.whole(lost)):
            found[i] = young[text] = coded
        if len(young) > CACHED_PIECES:
            self.young, self.old = {}, young
        return found

    def cut(self, texts: pa.Array) -> pa.Array:
        """Texts with a mark wherever the tokenizer surely splits them."""
        blanks = pc.replace_substring(texts, " ", "\0 ")
        marks = blanks
        for mark, put in ((".", "\0."), (",", "\0,"), ("\n", "\0\n\0")):
            marks = pc.replace_substring(marks, mark, put)
        return pc.if_else(pc.match_substring_regex(texts, LOOSE), blanks, marks)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Token ids of every text; null reads as empty.

        Python's collector rests meanwhile: it would look through the many small strings again and again.
        """
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not self.by_piece:
            return [np.frombuffer(b, self.kind) for b in self.whole(texts.to_pylist())]
        joined = pc.match_substring_regex(texts, INSEPARABLE)
        out: list[np.ndarray | None] = [None] * len(texts)
        rest = pc.indices_nonzero(joined).to_pylist()
        for i, ids in zip(rest, self.whole(texts.take(pa.array(rest, pa.int64())).to_pylist())):
            out[i] = np.frombuffer(ids, self.kind)
        plain = pc.invert(joined)
        split = pc.split_pattern(self.cut(texts.filter(plain)), "\0")
        starts = split.offsets.to_numpy()
        coded = pc.dictionary_encode(split.flatten())
        use = coded.indices.to_numpy()
        found = self.pieces(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int32, len(found)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(found), self.kind)
        taken = lengths[use]
        ends = np.cumsum(taken, dtype=np.int32)  # a batch has far fewer than 2 ** 31 tokens
        shift = (np.cumsum(lengths, dtype=np.int32) - lengths)[use] - (ends - taken)
        ids = flat[np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(shift, taken)]
        bounds = np.append(0, ends)[starts - starts[0]]
        for i, a, b in zip(pc.indices_nonzero(plain).to_pylist(), bounds, bounds[1:]):
            out[i] = ids[a:b]
        return out


@lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def read_frame(file, offset: int, name: str) -> bytes:
    """The payload of the record at ``offset``; damage raises."""
    file.seek(offset)
    head = file.read(12)
    if len(head) < 12 or masked_crc(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError(f"{name}: damaged length at byte {offset}")
    size = struct.unpack("<Q", head[:8])[0]
    data = file.read(size + 4)
    if len(data) < size + 4 or masked_crc(data[:size]) != struct.unpack("<I", data[size:])[0]:
        raise ValueError(f"{name}: damaged record at byte {offset}")
    return data[:size]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token ids of all ``docs`` to ``folder`` in ascending ``doc_id`` order, with a manifest beside them, which is returned.

    The manifest has one row per file, in order. A task that is run again writes a file of another name, and only
    the files of finished tasks get into the manifest, so lost executors leave no doubles. Null ids come first;
    rows of equal id are ordered by a hash of their text. Null and empty texts are documents of the end id alone.
    An empty table gives an empty manifest; other columns, whatever their names, are not read. ``tokenizer`` is a path that every executor can read.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(docs["doc_id"].cast("bigint").alias("_id"), docs["text"].alias("_text"))
    keys = ["_id", F.xxhash64("_text")]
    ordered = named.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)

    def write(batches):
        part, made = TaskContext.get().partitionId(), None
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        encode, index, at, tokens = encoder(tokenizer), [], 0, 0
        end = np.array([end_id], encode.kind).tobytes()
        for batch in small_batches(batches, "_text", 2 << 20):
            made = made or create(folder, name + ".rec")
            framed = []
            for doc, ids in zip(batch.column("_id").to_pylist(), encode.encode(batch.column("_text"))):
                flags = HAS_ID * (doc is not None) + WIDE * encode.wide
                record = frame(struct.pack("<Bq", flags, doc or 0) + ids.tobytes() + end)
                index.append((at, len(ids) + 1))
                at += len(record)
                tokens += len(ids) + 1
                framed.append(record)
            made.write(b"".join(framed))
        if made:
            made.close()
            with create(folder, name + ".idx") as out:
                out.write(np.array(index, INDEX).tobytes())
            schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])
            yield batch_of({"part": [part], "file": [name], "documents": [len(index)], "tokens": [tokens], "bytes": [at]}, schema)

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest that ``write_tokens`` left beside its files."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_tokens(manifest: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before it) and ``ids`` (unsigned 32 bits each) of every record.

    Records are found through the index. With a ``seed``, files are dealt anew and the records of a file come in a
    seeded order: a shuffled epoch without a shuffle. Checksums are tested on every read.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("part", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = files.repartition(parts, F.xxhash64(F.lit(seed or 0), "file") if seed is not None else F.col("part"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with open_file(folder, name + ".idx") as file:
                    index = np.frombuffer(file.read(), INDEX)
                starts = start + np.cumsum(index["tokens"].astype(np.int64)) - index["tokens"]
                order = np.arange(len(index)) if seed is None else np.random.default_rng([seed, zlib.crc32(name.encode())]).permutation(len(index))
                with open_file(folder, name + ".rec") as file:
                    rows, held = [], 0
                    for i in order:
                        payload = read_frame(file, int(index["offset"][i]), name)
                        flags, doc = struct.unpack_from("<Bq", payload)
                        ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=9).astype("<u4").tobytes()
                        rows.append((doc if flags & HAS_ID else None, int(starts[i]), ids))
                        held += len(ids)
                        if held > 8 << 20:
                            yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    return files.mapInArrow(read, "doc_id bigint, start bigint, ids binary")


def token_records(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a new folder of the shared folder and read the files back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    folder = new_folder(docs.sparkSession, "tokens")
    read = read_tokens(write_tokens(docs, folder, tokenizer), folder)
    return read.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
