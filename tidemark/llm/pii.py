"""Personal data: an Aho-Corasick automaton finds anchors, local parsers expand them to full spans."""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame

from tidemark.llm.secret_scan import spans_of

# Kinds in output order, and the base pattern of each.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Added by anchors: web addresses that carry a user name, and account numbers behind a cue word.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "ssh://")
STOP, HOST = re.compile(r"[\s/@]"), re.compile(r"@[A-Za-z0-9.-]")
URL = re.compile(r"[a-z]+:(?://)?[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]+[^\s]*")
CUES = ("account", "Account", "acct", "Acct", "IBAN", "iban", "SSN", "ssn", "passport", "Passport")
ACCOUNT = re.compile(r"[A-Za-z]+(?:[ ]?(?:no|nr|number|id|#))?\.?[ ]?[:#=]?[ ]?((?:[A-Z]{2}[0-9]{2}[ ]?)?[A-Z0-9](?:[ -]?[A-Z0-9]){5,33})(?![A-Za-z0-9])")

DIGITS = "0123456789"
SPACED = frozenset(DIGITS + " -")
RUN = {"ip": re.compile(r"[0-9.]*"), "card": re.compile(r"[0-9 -]*")}


@cache
def anchors():
    """The automaton; each word carries the kind of its parser and its own length."""
    import ahocorasick

    found = ahocorasick.Automaton()
    words = [("@", "email"), *((s, "url") for s in SCHEMES), *((c, "account") for c in CUES)]
    words += [("+" + d, "phone") for d in DIGITS] + [("." + d, "ip") for d in DIGITS]
    words += [(a + gap + b, "card") for a in DIGITS for b in DIGITS for gap in ("", " ", "-")]
    for word, kind in words:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


VALID = {
    "ip": lambda parts: all(int(p) <= 255 if len(p) < 5 else int(p.lstrip("0")[:4] or 0) <= 255 for p in parts),
    "card": lambda s: 13 <= len(n := _digits(s)) <= 19 and luhn(n),
    "phone": lambda s: 9 <= len(_digits(s)) <= 15,
}


def _addresses(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """Dotted numbers fall into fours from their left; what is left over is none."""
    found = []
    for m in NUMBERS.finditer(text, start, end):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[i : i + 4])) + 3
            if VALID["ip"](parts[i : i + 4]):
                found.append(("ip", at, at + size))
            at += size + 1
    return found


def pii_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans by kind as listed, then start, in time linear in the text.

    From its anchor a parser widens to what its kind may hold: to the left of an at-sign as far as a local part goes,
    to the right a domain; around digits the run of digits and separators. No match can cross the edge of such a run,
    so matching inside it gives what matching the whole text gives. No character is looked at for more than a few anchors.
    """
    found: dict[str, list[tuple[str, int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)
    stop = -1  # the next blank, slash or at-sign behind a scheme
    for last, (kind, length) in anchors().iter(text):
        at = last - length + 1
        if at < done[kind]:
            continue
        if kind == "email":
            start = at
            while start > done[kind] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                done[kind] = m.end()
                found[kind].append((kind, start, m.end()))
        elif kind in RUN:
            letters, start = SPACED if kind == "card" else frozenset(DIGITS + "."), at
            while start > done[kind] and text[start - 1] in letters:
                start -= 1
            end = RUN[kind].match(text, at).end()
            done[kind] = end
            if kind == "ip":
                found[kind] += _addresses(text, start, end)
            else:
                found[kind] += [(kind, m.start(), m.end()) for m in CARD.finditer(text, start, end) if VALID[kind](m[0])]
        elif kind == "phone":
            if m := PHONE.match(text, at):
                done[kind] = m.end()
                if VALID[kind](m[0]):
                    found[kind].append((kind, at, m.end()))
        elif kind == "url":
            body = last + 1 + 2 * text.startswith("//", last + 1)
            if body > stop:
                stop = m.start() if (m := STOP.search(text, body)) else len(text)
            if HOST.match(text, stop) and (m := URL.match(text, at)):
                done[kind] = m.end()
                found[kind].append((kind, at, m.end()))
        elif (m := ACCOUNT.match(text, at)) and len(_digits(m[1])) >= 4:
            done[kind] = m.end()
            found[kind].append((kind, m.start(1), m.end(1)))
    return [s for k in KINDS for s in found[k]]


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: its key, the spans (code points, end exclusive) and the masked text.

    Null and empty texts have no spans. Keys may be null or repeated; rows are never joined.
    Other columns are not read, whatever they are called. Whole texts are scanned.
    """
    return spans_of(docs, pii_spans, key, text)
