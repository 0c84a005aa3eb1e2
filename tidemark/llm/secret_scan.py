"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import batch_of, small_batches, strings

SPANS = "array<struct<kind:string,start:int,end:int>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

# The base patterns. A run of a class begins where no such character stands before it.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

#: A candidate is a run of these characters that is at least a window long.
WINDOW = 20
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}")
#: Bits per character that a window must reach, by the narrowest class that holds the candidate.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
)
#: What looks random but is no secret. Whole candidates: numbers and UUIDs, and runs of nothing but plain segments.
ALLOWED = (
    re.compile(r"[0-9+/_=-]*"),
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
)
SEGMENT = re.compile(r"[A-Za-z0-9]+")
#: A plain segment: words of one case or capitalised, of bounded length, with a short number behind them, or a short number.
PLAIN = re.compile(r"(?:[A-Z]{1,40}|[A-Za-z]?[a-z]{0,40}|[A-Za-z][a-z]{1,40}(?:[A-Z][a-z]{1,40}){1,8})[0-9]{0,4}")
#: A segment that says that it is a sample.
SAMPLE = re.compile(r"(?i:example|sample|placeholder|xxxx)|0123456789|abcdefgh|ABCDEFGH")
#: Beside other segments, only a plain one of so many characters is taken as a word: shorter ones occur in random text.
LEAST_WORD = 4
_TERM = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def windows_above(text: str, bits: float, width: int = WINDOW) -> Iterator[tuple[int, int]]:
    """Merged ranges covered by windows of at least ``bits`` bits per character.

    The window moves by one: one count goes up, one goes down, and the sum of
    n log n changes by their terms only.
    """
    counts: dict[str, int] = {}
    total, start, end = 0.0, -1, -1
    term = _TERM if width == WINDOW else [0.0] + [n * math.log2(n) for n in range(1, width + 1)]
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= width:
            old = text[i - width]
            n = counts[old]
            counts[old] = n - 1
            total += term[n - 1] - term[n]
        if i >= width - 1 and math.log2(width) - total / width >= bits - 1e-9:
            if start >= 0 and i - width + 1 <= end:
                end = i + 1
            else:
                if start >= 0:
                    yield start, end
                start, end = i - width + 1, i + 1
    if start >= 0:
        yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def suspicious(word: str) -> Iterator[tuple[int, int]]:
    """The parts of a candidate that the allow-list leaves: what stands between its allowed segments.

    A segment is a run of letters and digits. Words and samples hide themselves only, not the key beside them; a
    candidate of plain segments alone has no such part.
    """
    if any(p.fullmatch(word) for p in ALLOWED):
        return
    segments = [(m.start(), m.end(), bool(PLAIN.fullmatch(m[0])), bool(SAMPLE.search(m[0]))) for m in SEGMENT.finditer(word)]
    if all(plain or sample for _, _, plain, sample in segments):
        return
    at = 0
    for start, end, plain, sample in [*segments, (len(word), len(word), True, True)]:
        if sample or (plain and end - start >= LEAST_WORD):
            if start - at >= WINDOW:
                yield at, start
            at = end


def entropy_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in CANDIDATE.finditer(text):
        for left, right in suspicious(m[0]):
            part = m[0][left:right]
            bits = next(bits for _, letters, bits in CLASSES if letters.fullmatch(part))
            for start, end in windows_above(part, bits):
                yield "entropy", m.start() + left + start, m.start() + left + end


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind. An entropy span that touches a base span is left out."""
    base = base_spans(text)
    extra = [s for s in entropy_spans(text) if not any(a < s[2] and s[1] < b for _, a, b in base)]
    return sorted(base + extra, key=lambda s: (s[1], KINDS.index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans are one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans_of(docs: DataFrame, find, key: str, text: str) -> DataFrame:
    """``key``, ``spans`` and ``masked`` text of every row, with ``find`` run inside Arrow batches.

    ``masked`` is null where nothing was found: the text itself stands.
    """
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches):
        for batch in small_batches(batches, "_text", 8 << 20):
            texts = strings(batch, "_text")
            spans = [find(t) for t in texts]
            schema = pa.schema([("key", batch.schema.field("_key").type), ("spans", SPAN_TYPE), ("masked", pa.string())])
            yield batch_of(
                {
                    "key": batch.column("_key"),
                    "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans],
                    "masked": [masked(t, s) if s else None for t, s in zip(texts, spans)],
                },
                schema,
            )

    named = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    return named.mapInArrow(scan, f"key {kind}, spans {SPANS}, masked string").withColumnRenamed("key", key)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its key, the secret spans (code points, end exclusive) and the masked text.

    Null and empty texts have no spans. Keys may be null or repeated; rows are never joined.
    Other columns are not read, whatever they are called. Whole texts are scanned, of any length; an empty table gives
    no rows.
    """
    return spans_of(docs, secret_spans, key, text)
