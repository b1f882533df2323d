import random
import re

import pytest
from pyspark.sql import functions as F
from llm_fixtures import ODD_TEXTS, documents, rows, table  # noqa: F401

from stratalake.llm.pii import BASE_KINDS, find, personal_data, redact, redacted

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def by_patterns(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]


@pytest.mark.parametrize("seed", range(4))
def test_base_spans_are_those_of_the_patterns(seed):
    r = random.Random(seed)
    pieces = [
        "1", "25", "256", "007", ".", "..", "@", "a", "b-", "+", "++", " ", "-", "(", ")", "é", "4111 1111 1111 1111",
        "4111111111111111", "192.168.0.1", "x@y.com", "+1 555 123 4567", "\n", "%", "٣", "://", "account no ", "IBAN ",
    ]
    for _ in range(5000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        assert [s for s in find(text) if s[0] in BASE_KINDS] == by_patterns(text), text


@pytest.mark.parametrize(
    "text, span",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00 ok", ("iban", 6, 33)),
        ("my account no. 12-345-678, and", ("account", 15, 25)),
        ("Passport number X1234567", ("account", 16, 24)),
        ("see ftp://bob:pw1@host.org/x", ("login", 4, 26)),
    ],
)
def test_added_spans(text, span):
    assert span in find(text)


@pytest.mark.parametrize(
    "text",
    ["IBAN DE89 3704 0044 0532 0130 01", "account no longer used", "account no 12", "http://host.org/a@b", "see https://example.org", "a @ b", "@"],
)
def test_no_added_spans(text):
    assert [s for s in find(text) if s[0] not in BASE_KINDS] == []


@pytest.mark.parametrize(
    "text, span",
    [
        ("Account No: 12-345-678", ("account", 12, 22)),
        ("ACCOUNT NUMBER 12345678", ("account", 15, 23)),
        ("Passport No. X1234567", ("account", 13, 21)),
        ("\u0130 Iban: DE89 3704 0044 0532 0130 00", ("iban", 8, 35)),
    ],
)
def test_cues_in_any_case(text, span):
    assert find(text) == [span] or span in find(text)


def test_cues_that_go_on_are_none():
    assert [s for s in find("account notes 12345678, Ibanez DE89 3704 0044 0532 0130 00") if s[0] not in BASE_KINDS] == []


def test_own_cues(documents):
    cues = (("account", "konto-nr"), ("iban", "bank code"))
    assert ("account", 9, 17) in find("Konto-Nr 12345678, account no 7654321", cues)
    assert len([s for s in find("Konto-Nr 12345678, account no 7654321", cues) if s[0] == "account"]) == 1
    found = documents(["KONTO-NR 12345678"]).select(F.col("text"), personal_data(F.col("text"), cues).alias("found"))
    assert [tuple(s) for s in found.first()["found"]] == [("account", 9, 17)]
    for bad in (("account", "Konto"), ("account", ""), ("email", "mail")):
        with pytest.raises(ValueError, match="a cue is"):
            personal_data(F.col("text"), (bad,))


@pytest.mark.parametrize(
    "text, hosts",
    [
        ("see https://example.org/a@b, HTTP://u:p@b.co:80 x", ["example.org", "b.co"]),
        ("http://localhost/ ://a.b http:// http://a..b é://c.d", []),
        ("http://x.y://z.w", ["x.y", "z.w"]),
        ("a" * 50 + "://h.i", ["h.i"]),
    ],
)
def test_hosts(text, hosts):
    spans = [s for s in find(text, hosts=True) if s[0] == "host"]
    assert [text[a:b] for _, a, b in spans] == hosts
    assert [s for s in find(text, hosts=True) if s[0] != "host"] == find(text)


def test_long_runs_of_schemes_are_linear():
    for run in ("://" * 100_000, "a://" * 100_000, "a://b" * 100_000, "a.b" * 100_000 + "://", "a://" + "b." * 150_000):
        find(run, hosts=True)


def test_long_runs_are_linear():
    for run in ("a" * 300_000, "1" * 300_000, "1.1" * 100_000, "+1" * 100_000, "@" * 300_000, "a@" * 100_000, "1 " * 150_000):
        find(run)


def test_column(documents):
    texts = [*ODD_TEXTS, "é😀 a@b.co +1 (555) 123-4567", "a@b.co", "a@b.co"]
    docs = documents(texts, extra="spans").withColumn("found", personal_data(F.col("text")))
    for doc_id, found in rows(docs.select("doc_id", "found")):
        assert [tuple(s) for s in found] == find(texts[doc_id] or "")
    cleaned = dict(rows(docs.select("doc_id", redact(F.col("text"), F.col("found")))))
    assert cleaned[len(ODD_TEXTS)] == "é😀 [email] [phone]" and cleaned[0] == ""
    assert documents([]).select(personal_data(F.col("text"))).count() == 0


def test_overlapping_spans_are_replaced_once():
    spans = [{"kind": "a", "start": 1, "end": 4}, {"kind": "b", "start": 2, "end": 6}, {"kind": "c", "start": 1, "end": 5}]
    assert redacted("0123456789", spans) == "0[c]56789"
