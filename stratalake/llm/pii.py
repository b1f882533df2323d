"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and cues of
identifiers. From each anchor a local parser expands to the boundaries of its kind and validates:

- ``email``: left and right of an at-sign; the domain has a dot.
- ``ip``: four numbers from the first digit of a run, each 255 at most.
- ``card``: a run of digits, single blanks or hyphens between, 13 to 19 digits with a right check digit (Luhn).
- ``phone``: from a plus sign, 9 to 15 digits.
- ``iban``: after its cue, with a right checksum (97).
- ``account``: after a cue such as "account no", 6 to 20 capitals, digits and hyphens, 6 digits at least.
- ``login``: an address with a scheme and a user's name and password before an at-sign.
- ``host``, if asked for: the host of an address with a scheme, a name with a dot.

Cues are found in any case; the lists are parameters (``cues``), given in lower case. A cue that goes on
as a longer word is none.

Of each kind, spans are the leftmost that don't overlap; what matched and was invalid isn't tried
again from a later start. Each character is looked at a bounded number of times for each kind, so
long runs cost no more than others. Positions are code points, ends exclusive. Null and empty texts
have no spans; equal texts get equal spans.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.llm.shared import lean

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "login", "host")
SPANS = "array<struct<kind: string, start: int, end: int>>"

Cues = tuple[tuple[str, str], ...]
#: (kind, cue) of identifiers.
CUES: Cues = (
    ("iban", "iban"),
    *(("account", f"{what} {number}") for what in ("account", "acct", "customer", "passport") for number in ("no", "number")),
    ("account", "kontonummer"),
)
_FOLD = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[\s:.#]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"[\s:.#]{0,4}([A-Z0-9](?:-?[A-Z0-9]){5,19})(?![A-Za-z0-9-])")
_LOGIN = re.compile(r"[^\s/@:]{1,64}:[^\s/@]{1,128}@[A-Za-z0-9.-]+")
_HOST = re.compile(r"(?:[^\s/@]{1,193}@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_SCHEME_LENGTH = 32


@cache
def _anchors(cues: Cues) -> ahocorasick.Automaton:
    """Each anchor with its kind and length."""
    found = ahocorasick.Automaton()
    signs = [("email", "@"), ("phone", "+"), ("scheme", "://"), *(("digit", d) for d in "0123456789")]
    for kind, word in (*signs, *cues):
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _left(text: str, at: int, least: int, allowed: frozenset[str]) -> int:
    """The start of the run of allowed characters that ends before ``at``."""
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def find(text: str, cues: Cues = CUES, hosts: bool = False) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind and then by start."""
    done = dict.fromkeys(KINDS, 0)
    spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    run_end = 0
    folded = text.lower()
    if len(folded) != len(text):  # a letter whose lower case is longer
        folded = text.translate(_FOLD)

    def keep(kind: str, start: int, end: int, valid: bool = True) -> None:
        done[kind] = end
        if valid:
            spans[kind].append((start, end))

    for last, (anchor, length) in _anchors(cues).iter(folded):
        at, end = last - length + 1, last + 1
        if anchor in ("iban", "account") and text[end : end + 1].islower():
            continue
        if anchor == "digit":
            if at < run_end:
                continue
            run_end = end
            while run_end < len(text) and "0" <= text[run_end] <= "9":
                run_end += 1
            if at >= done["ip"] and text[run_end : run_end + 1] == "." and (m := _IP.match(text, at)):
                parts = [part.lstrip("0") for part in m.group().split(".")]
                keep("ip", at, m.end(), all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts))
            if at >= done["card"] and (m := _CARD.match(text, at)):
                digits = m.group().replace(" ", "").replace("-", "")
                keep("card", at, m.end(), 13 <= len(digits) <= 19 and _luhn(digits))
        elif anchor == "email":
            start = _left(text, at, done["email"], _LOCAL)
            if start < at and (m := _DOMAIN.match(text, end)):
                keep("email", start, m.end())
        elif anchor == "phone":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                keep("phone", at, m.end(), 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15)
        elif anchor == "iban":
            if end >= done["iban"] and (m := _IBAN.match(text, end)):
                code = m[1].replace(" ", "")
                moved = "".join(str(int(c, 36)) for c in code[4:] + code[:4])
                keep("iban", m.start(1), m.end(1), int(moved) % 97 == 1)
        elif anchor == "account":
            if end >= done["account"] and (m := _ACCOUNT.match(text, end)):
                keep("account", m.start(1), m.end(1), sum("0" <= c <= "9" for c in m[1]) >= 6)
        else:
            start = _left(text, at, max(0, at - _SCHEME_LENGTH), _SCHEME)
            if m := _LOGIN.match(text, end):
                begin = max(start, done["login"])
                keep("login", begin, m.end(), begin < at)
            if hosts and start < at and end >= done["host"] and (m := _HOST.match(text, end)):
                keep("host", m.start(1), m.end(1))
    return [(kind, start, end) for kind in KINDS for start, end in spans[kind]]


def personal_data(text: Column, cues: Cues = CUES, hosts: bool = False) -> Column:
    """All spans of a text as an array of (kind, start, end), by kind as in ``KINDS``, then by start."""
    for kind, cue in cues:
        if kind not in ("iban", "account") or not cue or cue != cue.translate(_FOLD):
            raise ValueError(f"a cue is iban or account with a text in lower case, not {(kind, cue)!r}")

    def of(texts: pa.Array) -> pa.Array:
        kinds, starts, ends, offsets = [], [], [], [0]
        for text in texts:
            for kind, start, end in find(text.as_py() or "", cues, hosts):
                kinds.append(kind)
                starts.append(start)
                ends.append(end)
            offsets.append(len(kinds))
        spans = pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            ["kind", "start", "end"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)

    return F.arrow_udf(lean(of), SPANS)(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping ones the first."""

    def of(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py() or "", s.as_py() or []) for t, s in zip(texts, found, strict=True)], pa.string())

    return F.arrow_udf(lean(of), "string")(text, spans)


def redacted(text: str, spans: list[dict]) -> str:
    parts, done = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] >= done:
            parts += [text[done : span["start"]], f"[{span['kind']}]"]
            done = span["end"]
    return "".join([*parts, text[done:]])
