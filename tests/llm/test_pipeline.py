"""Each stage against brute force on its own input, and the whole."""

import os
import re

import pyarrow.parquet as pq
import pytest
from llm_fixtures import ODD_TEXTS, documents, prose, rows, table  # noqa: F401
from test_lines import brute as brute_lines
from test_minhash import brute as brute_groups
from test_quality import brute as brute_counts

import corpus_pipeline as p

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    """The input and result of each stage."""
    docs, made = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in p.STAGES:
        given = docs
        docs = p.written(stage(spark, docs, SMALL))
        made.append((name, given, docs))
    return made


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_return_documents(stages):
    assert [name for name, _, _ in stages] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "encoding"]
    for _, given, found in stages[:-1]:
        assert found.dtypes == given.dtypes
        assert 0 < found.count() <= given.count()


def test_quality_rules_drop_what_fails_the_fixed_rules_and_keep_good_labels(stages):
    _, given, found = stages[0]
    kept, before = texts_of(found), texts_of(given)
    good = {r["doc_id"] for r in pq.read_table(f"{SMALL}/labels.parquet").to_pylist() if r["quality"]}
    for doc_id, text in before.items():
        counts = brute_counts(text)
        failed = counts["n_words"] < 20 or 100 * counts["n_repeat_words"] > 30 * counts["n_words"]
        if failed:
            assert doc_id not in kept
        elif doc_id in good:
            assert kept[doc_id] == text


def test_line_dedup_drops_the_lines_that_are_not_kept(stages):
    _, given, found = stages[1]
    before, kept = texts_of(given), texts_of(found)
    ids = sorted(before)
    gone = {(ids[d], n) for d, n, *_, keep in brute_lines([before[i] for i in ids]) if not keep}
    for doc_id, text in before.items():
        lines = text.split("\n")
        rest = "\n".join(x for n, x in enumerate(lines) if (doc_id, n) not in gone)
        if rest.strip(" \t\n\x0b\x0c\r"):
            assert kept[doc_id] == rest
        else:
            assert doc_id not in kept
    assert gone
    assert all(r["n_chars"] == len(r["text"]) for r in found.collect())


def test_near_dedup_keeps_one_of_each_group(stages):
    _, given, found = stages[2]
    before = texts_of(given)
    ids = sorted(before)
    expected = {ids[i]: before[ids[i]] for i, _, _, keep in brute_groups([before[i] for i in ids], 5) if keep}
    assert texts_of(found) == expected


def test_decontamination_drops_documents_with_a_passage(stages):
    _, given, found = stages[3]
    items = [" ".join(r["text"].lower().split()) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    kept = texts_of(found)
    for doc_id, text in texts_of(given).items():
        words = " ".join(text.lower().split())
        assert (doc_id not in kept) == any(item in words for item in items)


def test_encoding_has_every_document(stages):
    _, given, found = stages[4]
    made = {r["doc_id"]: r for r in found.collect()}
    assert made.keys() == texts_of(given).keys()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) > 0 for r in made.values())


def test_run_is_all_stages(spark, stages):
    found = p.run(spark, SMALL)
    assert rows(found, "doc_id", "n_tokens") == rows(stages[-1][2], "doc_id", "n_tokens")
    assert p.ORACLE_SQL is None


def test_odd_documents(spark, table, prose):
    """Nulls in any column, repeated rows and extra columns go through all stages; so does an empty table."""
    text = prose(60, 1)
    given = [(1, text, "en", None, None, "x"), (1, text, "en", None, None, "x"), (None, prose(60, 2), None, "s", 3, None)]
    given += [(10 + i, t, "en", "s", 0, "x") for i, t in enumerate(ODD_TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, bucket string"
    for some in (given, []):
        docs = table(some, schema)
        for _, stage in p.STAGES:
            docs = p.written(stage(spark, docs, SMALL))
        assert {r[0] for r in rows(docs, "doc_id")} == ({1, None} if some else set())


def test_texts_of_the_odd_documents_are_short():
    assert all(len(re.findall(r"\S+", t or "")) < 20 or len(set(t.split())) == 1 for t in ODD_TEXTS)
