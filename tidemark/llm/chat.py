"""Chat formatting: the fingerprint of a record's fields picks the mapping to canonical turns; turns become marked text."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batch_of

# The marks of a turn, and the control strings that texts must not hold.
BEGIN, END = "<|im_start|>", "<|im_end|>"
CONTROL = (BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_BACK = re.compile(r"\\(.)", re.DOTALL)

#: A piece of formatted text ends at the first turn beyond so many characters.
PIECE = 1 << 20
PIECES = "piece bigint, formatted string, loss array<struct<start:int,end:int>>"
TURNS = "turn bigint, role string, text string"
_MASK = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first character of every control string."""
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def escape_role(role: str) -> str:
    """Roles end at a line feed, so theirs are written as a backslash and an n."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _BACK.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


@dataclass(frozen=True)
class Layout:
    """How records of one set of field paths become turns.

    ``each`` names the list of turns, if there is one; ``role`` and ``text`` the fields of a turn in it.
    ``fixed`` lists (role, field) for layouts with one field per turn; ``joined`` adds a second field to the
    text of a turn; empty system and joined fields are left out.
    """

    name: str
    each: str | None = None
    role: str = "role"
    text: str = "content"
    fixed: tuple[tuple[str, str], ...] = ()
    joined: dict[str, str] = field(default_factory=dict)
    roles: dict[str, str] = field(default_factory=dict)
    turn: str | None = None


def paths(value: object, prefix: str = "") -> set[str]:
    """Paths of all leaf fields; list positions are written ``[]``."""
    if isinstance(value, dict):
        found = set().union(*[paths(v, f"{prefix}.{k}" if prefix else k) for k, v in value.items()])
        return found or {prefix + "{}"}
    if isinstance(value, list):
        return set().union(*[paths(v, prefix + "[]") for v in value]) if value else {prefix + "[]"}
    return {prefix}


def fingerprint(fields: set[str]) -> str:
    return hashlib.sha1("\n".join(sorted(fields)).encode("utf-8", "surrogatepass")).hexdigest()


SHARE_ROLES = {"human": "user", "gpt": "assistant", "chatgpt": "assistant", "bot": "assistant"}
_MESSAGES = Layout("messages", each="messages")
_SHARED = Layout("conversations", each="conversations", role="from", text="value", roles=SHARE_ROLES)
_DECLARED: list[tuple[tuple[str, ...], Layout]] = [
    (("turn", "role", "text"), Layout("turn", turn="turn", role="role", text="text")),
    (("messages[].role", "messages[].content"), _MESSAGES),
    (("messages[]",), _MESSAGES),
    (("conversations[].from", "conversations[].value"), _SHARED),
    (("conversations[]",), _SHARED),
    (("prompt", "response"), Layout("prompt", fixed=(("user", "prompt"), ("assistant", "response")))),
    (("prompt", "completion"), Layout("prompt", fixed=(("user", "prompt"), ("assistant", "completion")))),
    (("question", "answer"), Layout("question", fixed=(("user", "question"), ("assistant", "answer")))),
    (("system", "prompt", "response"), Layout("prompt", fixed=(("system", "system"), ("user", "prompt"), ("assistant", "response")))),
    (("instruction", "output"), Layout("instruction", fixed=(("user", "instruction"), ("assistant", "output")))),
    (("instruction", "input", "output"), Layout("instruction", fixed=(("user", "instruction"), ("assistant", "output")), joined={"instruction": "input"})),
]
LAYOUTS = {fingerprint(set(fields)): layout for fields, layout in _DECLARED}


def turns_of(record: object, layout: Layout) -> list[tuple[int | None, str, str]]:
    if layout.turn:
        return [(record[layout.turn], record[layout.role] or "", record[layout.text] or "")]
    if layout.each:
        named = [(m[layout.role] or "", m[layout.text] or "") for m in record[layout.each]]
        return [(i, layout.roles.get(role, role), text) for i, (role, text) in enumerate(named)]
    found = []
    for role, name in layout.fixed:
        parts = [record[name] or "", record.get(layout.joined.get(name, ""), "") or ""]
        text = "\n".join([parts[0], *parts[1:]] if parts[1] else parts[:1])
        if text or role != "system":
            found.append((len(found), role, text))
    return found


def canonical_turns(records: DataFrame, key: str, record: str) -> DataFrame:
    """``key``, ``turn``, ``role``, ``text`` and ``layout`` of every turn of JSON records of mixed layouts.

    A record's field paths are hashed, and the hash picks the declared mapping. Null roles and texts are empty.
    A record that is null, no JSON, of unknown fields, or with other kinds of values than its layout has, gives one
    row with null ``turn``, ``role``, ``text`` and ``layout``: nothing is lost silently. An empty list of turns gives no row.
    """
    kind = records.schema[key].dataType.simpleString()

    def convert(batches):
        known: dict[frozenset, Layout | None] = {}
        for batch in batches:
            rows = []
            for at, text in zip(batch.column("_key"), batch.column("_record").to_pylist()):
                try:
                    value = json.loads(text) if text is not None else None
                    fields = frozenset(paths(value))
                    if fields not in known:
                        known[fields] = LAYOUTS.get(fingerprint(set(fields)))
                    layout = known[fields]
                    turns = turns_of(value, layout) if layout else None
                    if turns and not all(isinstance(r, str) and isinstance(t, str) and (n is None or isinstance(n, int)) for n, r, t in turns):
                        turns = None
                except (ValueError, TypeError, KeyError, RecursionError):
                    turns = None
                rows += [(at, None, None, None, None)] if turns is None else [(at, n, r, t, layout.name) for n, r, t in turns]
            schema = pa.schema([("key", batch.schema.field("_key").type), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string())])
            columns = list(zip(*rows)) or [[]] * 5
            yield batch_of({n: list(c) if i else pa.array([x.as_py() for x in c], schema[0].type) for i, (n, c) in enumerate(zip(schema.names, columns))}, schema)

    named = records.select(records[key].alias("_key"), records[record].alias("_record"))
    return named.mapInArrow(convert, f"key {kind}, {TURNS}, layout string").withColumnRenamed("key", key)


def format_turns(turns: DataFrame, key: str) -> DataFrame:
    """``key``, ``piece``, ``formatted`` and ``loss`` of every conversation.

    Rows are sorted by turn inside their conversation, nulls first, rows of one turn by role and text, and formatted
    as they come by: no conversation is held whole, however long. Its text comes in pieces that end at a turn. ``loss``
    lists the assistant texts as ranges of the piece (code points, end exclusive). Null keys are one conversation.
    """
    kind = turns.schema[key].dataType.simpleString()
    named = turns.select(turns[key].alias("_key"), "turn", "role", "text").fillna("", ["role", "text"])
    ordered = named.repartition("_key").sortWithinPartitions("_key", "turn", "role", "text")

    def write(batches):
        schema, rows = None, []
        now, piece, parts, size, loss = object(), 0, [], 0, []

        def close():
            nonlocal piece, parts, size, loss
            if parts:
                rows.append((now, piece, "".join(parts), loss))
                piece, parts, size, loss = piece + 1, [], 0, []

        for batch in batches:
            schema = schema or pa.schema([("key", batch.schema.field("_key").type), ("piece", pa.int64()), ("formatted", pa.string()), ("loss", _MASK)])
            for at, role, text in zip(batch.column("_key").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                if at != now:
                    close()
                    now, piece = at, 0
                head, body = f"{BEGIN}{escape_role(role)}\n", escape(text)
                if role == "assistant":
                    loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
                parts += [head, body, END, "\n"]
                size += len(head) + len(body) + len(END) + 1
                if size >= PIECE:
                    close()
            if sum(len(r[2]) for r in rows) >= 8 * PIECE or len(rows) >= 5_000:
                yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)
                rows = []
        close()
        if rows:
            yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    return ordered.mapInArrow(write, f"key {kind}, {PIECES}").withColumnRenamed("key", key)


def parse_piece(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted piece."""
    found, at = [], 0
    while at < len(text):
        line = text.index("\n", at)
        end = text.index(END, line)
        if not text.startswith(BEGIN, at) or text[end + len(END) : end + len(END) + 1] != "\n":
            raise ValueError(f"no turn at character {at}")
        found.append((unescape_role(text[at + len(BEGIN) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return found


def read_conversations(pieces: DataFrame, key: str) -> DataFrame:
    """What the formatted pieces hold, per conversation: counts and digests of turns and of the text under the loss mask.

    Pieces are read in order and only the running digests of one conversation are held.
    """
    kind = pieces.schema[key].dataType.simpleString()
    named = pieces.select(pieces[key].alias("_key"), "piece", "formatted", "loss")
    ordered = named.repartition("_key").sortWithinPartitions("_key", "piece")

    def read(batches):
        schema, rows, now, state = None, [], object(), None

        def close():
            if state:
                n, turns, chars, loss, total = state
                rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in batches:
            schema = schema or pa.schema([("key", batch.schema.field("_key").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for at, text, loss in zip(batch.column("_key").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                if at != now:
                    close()
                    now, state = at, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_piece(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
        close()
        if rows:
            yield batch_of(dict(zip(schema.names, map(list, zip(*rows)))), schema)

    columns = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return ordered.mapInArrow(read, f"key {kind}, {columns}").withColumnRenamed("key", key)


def turn_records(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as JSON records of the one-row-per-turn layout."""
    fields = F.struct("turn", "role", "text")
    return rows.select("conv_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("record"))
