import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm_fixtures import ODD_TEXTS, documents, prose, rows, table  # noqa: F401

from stratalake.llm import quality as q
from stratalake.llm.words import blocks

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
    }


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_counts(size):
    r = random.Random(size)
    texts = [*ODD_TEXTS, *("".join(r.choice(["a ", "bé ", "# ", "\n", "x|", "😀 "]) for _ in range(r.randint(0, 90))) for _ in range(80))]
    for block in blocks(pa.array(texts, pa.string()), size):
        found = q.count_block(block)
        for i in range(block.rows):
            expected = brute(texts[block.first + i])
            assert {c: int(found[c][i]) for c in expected} == expected


def test_odd_documents(documents):
    found = q.quality(documents(ODD_TEXTS, extra="_lang").withColumnRenamed("n_chars", "kept"))
    assert found.columns.count("_lang") == found.columns.count("kept") == 1
    for doc_id, *counts, base_failed, kept in rows(found, "doc_id", "n_words", "n_repeat_words", "base_failed", "kept"):
        expected = brute(ODD_TEXTS[doc_id])
        assert counts == [expected["n_words"], expected["n_repeat_words"]]
        assert base_failed and not kept


def test_no_documents(documents):
    assert q.quality(documents([])).count() == 0


def test_fences_follow_the_group(table, prose, monkeypatch):
    """Digits for words are odd in prose and usual in a source of tables; small groups take their language's fences."""
    monkeypatch.setattr(q, "MIN_DOCS", 20)
    plain = [prose(60, i) for i in range(40)]
    tables = [re.sub(" ", " | ", prose(60, 100 + i)) for i in range(40)]
    given = [(t, "en", "news") for t in plain] + [(t, "en", "tables") for t in tables]
    given += [(tables[0], "en", "news"), (plain[0], "en", "small"), (tables[1], "en", "small"), (plain[1], None, None)]
    docs = table([(i, *g, 0) for i, g in enumerate(given)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(rows(q.quality(docs), "doc_id", "kept"))
    assert all(kept[i] for i in range(80)), "usual in its own group"
    assert not kept[80], "a table among news"
    assert kept[81] and kept[83]


def test_sketches_merge(documents, prose, spark):
    """The sketch of all rows is the sum of the sketches of parts."""
    docs = documents([prose(30 + i, i) for i in range(30)])
    whole = q.sketch(q.measure(docs))
    parts = [q.sketch(q.measure(docs.where(f"doc_id % 3 = {i}"))) for i in range(3)]
    merged = q.merge(parts[0].union(parts[1]).union(parts[2]), "lang", "source")
    columns = ("lang", "source", "share", "bucket", "rows")
    assert rows(merged, *columns) == rows(whole, *columns)


def test_quartiles_are_close(table):
    values = [int(1.07**i) for i in range(200)]
    sketches = table([("x", v) for v in values], "share string, value long")
    from pyspark.sql import functions as F

    power = "(length(bin(value)) - 5)"
    bucket = F.expr(f"if(value < 32, value, 16 * {power} + value div shiftleft(1L, {power}))").alias("bucket")
    found = q.fences(sketches.groupBy("share", bucket).agg(F.count("*").alias("rows")).withColumn("share", F.lit("symbols")))
    fence = found.first()["fence_symbols"]
    q1, q3 = sorted(values)[49], sorted(values)[149]
    assert abs(fence - (q3 + q.FENCE * (q3 - q1))) <= (1 + q.FENCE) * q3 / 8


def test_texts_are_counted_once_for_a_verdict(documents, prose):
    """One Python worker for each task, also where rows are filtered by what it returns."""
    docs = documents([prose(30, 1)])
    for made in (q.quality(docs).where("kept"), q.sketch(q.measure(docs))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
