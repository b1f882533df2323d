import random

import pytest
from llm_fixtures import ODD_TEXTS, documents, rows, table  # noqa: F401
from pyspark.sql import functions as F

from stratalake.llm import language as m

SOUNDS = {"xa": "ka lo mi tu re", "yo": "grn stk blm vrt psh", "zu": "ñé öü çà íø œæ"}


def text(lang, words, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SOUNDS[lang].split()) for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture
def languages(spark, table):
    given = [(i, text(lang, 60, i), lang) for i in range(25) for lang in SOUNDS]
    given += [(100, None, "xa"), (101, "", "none"), (102, "12 34", "digits"), (103, "abc", None), (104, given[0][1], "xa")]
    return m.Languages(spark, table(given, "doc_id long, text string, lang string"))


def test_languages_are_told_apart(languages, documents):
    given = [(lang, text(lang, n, 500 + n)) for lang in SOUNDS for n in (4, 12, 40, 900)]
    given += [(lang, f"{t.upper()}!! 123") for lang, t in given]
    found = documents([t for _, t in given], extra="score").select("doc_id", languages.predict(F.col("text")).alias("p"))
    for doc_id, lang, score, rejected in rows(found.select("doc_id", "p.lang", "p.score", "p.rejected")):
        assert lang == given[doc_id][0]
        assert 0.5 < score <= 1
        assert not rejected


def test_odd_texts(languages, documents):
    texts = [*ODD_TEXTS, "12 34 !?", "٣٤", "Ⅷ ² ½", "日本", "ka", "ka"]
    found = documents(texts).select("doc_id", languages.predict(F.col("text")).alias("p"))
    got = {d: (lang, score) for d, lang, score in rows(found.select("doc_id", "p.lang", "p.score"))}
    for doc_id, given in enumerate(texts):
        letters = any(c.isalpha() for c in given or "")
        assert (got[doc_id][0] != "und") == letters
        assert 0 <= got[doc_id][1] <= 1
    assert got[len(texts) - 1] == got[len(texts) - 2]


def test_narrow_margins_are_rejected():
    same = [("a", m._coder(b" alpha beta gamma ")), ("b", m._coder(b" alpha beta gamma "))]
    found = m.classify("alpha beta", same)
    assert found["lang"] == "a" and found["rejected"] and found["score"] == pytest.approx(0.5)


def test_no_training_texts(spark, table, documents):
    made = m.Languages(spark, table([], "doc_id long, text string, lang string"))
    assert rows(documents(["abc"]).select(made.predict(F.col("text")).alias("p")).select("p.lang")) == [("und",)]


def test_languages_are_bounded(spark, table, documents):
    """Thousands of values of lang are one class beside the languages with the most texts."""
    given = [(i, text(lang, 60, i), lang) for i in range(25) for lang in SOUNDS]
    given += [(1000 + i, f"qwq wqw {i}", f"junk{i}") for i in range(5000)] + [(9000, "qwq", m.OTHER)]
    made = m.Languages(spark, table(given, "doc_id long, text string, lang string"), languages=3)
    assert sorted(made.names) == sorted([*SOUNDS, m.OTHER])
    assert sum(len(data) for _, data in made._shared.value) <= 4 * m.DICT_BYTES
    texts = [text(lang, 30, 700) for lang in SOUNDS] + ["wqw qwq wqw"]
    found = rows(documents(texts).select("doc_id", made.predict(F.col("text")).alias("p")).select("doc_id", "p.lang"))
    assert dict(found) == dict(enumerate([*SOUNDS, m.OTHER]))


def test_samples_come_from_any_place(table, monkeypatch):
    monkeypatch.setattr(m, "SAMPLE_CHARS", 10)
    given = [(i, f"{i:04d}" + "é" * 96 + "z", "a") for i in range(200)] + [(500, "short", "a"), (501, "x" * 10, "a"), (502, "x" * 10, "a")]
    parts = [p for _, p in rows(m.sample(table(given, "doc_id long, text string, lang string")), "lang", "part")]
    assert {len(p) for p in parts} == {5, 10} and parts.count("x" * 10) == 2
    assert len([p for p in parts if p == "é" * 10]) > 100  # most places are within
    copies = rows(m.sample(table([(i, given[3][1], "a") for i in range(9)], "doc_id long, text string, lang string")), "part")
    assert len(set(copies)) == 1


def test_marks_belong_to_letters():
    assert m.letters("हिन्दी 12 में") == " हिन्दी में "
    assert m.letters("\u0301 !") == "" and m.letters("_A1b_") == " a b "


def test_samples_are_bounded(table, monkeypatch):
    monkeypatch.setattr(m, "SAMPLE_TEXTS", 7)
    given = [(i, f"text {i}", "big") for i in range(300)] + [(1, "rare one", "rare")]
    found = rows(m.sample(table(given, "doc_id long, text string, lang string")), "lang", "part")
    assert sum(lang == "big" for lang, _ in found) == 7
    assert ("rare", "rare one") in found
