import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import ODD_TEXTS, documents, prose, rows, table  # noqa: F401

from stratalake.llm import minhash as m
from stratalake.llm.words import blocks


def shingle_set(text, n):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute(texts, n):
    """(size, smallest id reachable) of each text."""
    sets = [shingle_set(t, n) for t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for b in range(len(sets)):
        for a in range(b):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def edited(text, share, r):
    return " ".join(w if r.random() > share else f"new{r.randrange(10**6)}" for w in text.split(" "))


@pytest.mark.parametrize("n, block", [(4, 512), (5, 8)])
def test_components_are_those_of_all_pairs(documents, prose, monkeypatch, n, block):
    """Copies, near copies around the threshold, a large family of them, and texts with a common passage."""
    monkeypatch.setattr(m, "BLOCK", block)
    r = random.Random(n)
    texts = [*ODD_TEXTS, "a b c", "A B C", "a b d", "same words here now"]
    for family in range(6):
        base = prose(120, family)
        texts += [base, base, edited(base, 0.02, r), edited(base, 0.03, r), edited(base, 0.05, r)]
    hot = prose(100, 77)
    texts += [edited(hot, 0.035, r) for _ in range(90)] + [hot] * 30
    passage = prose(60, 88)
    texts += [f"{passage} {prose(40, 200 + i)}" for i in range(25)]
    r.shuffle(texts)
    found = m.near_duplicates(documents(texts, extra="size"), words=n)
    assert sorted(rows(found, "doc_id", "n_shingles", "component_id", "kept")) == brute(texts, n)


def test_one_of_each_group_stays(documents, prose):
    texts = [prose(50, 1), None, prose(50, 1), prose(50, 2), "", prose(50, 2), None]
    kept = m.drop_near_duplicates(documents(texts, extra="dropped_id"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "dropped_id"]
    assert [r[0] for r in sorted(rows(kept, "doc_id"))] == [0, 1, 3, 4, 6]


def test_null_and_repeated_ids(table, prose):
    a, b = prose(40, 1), prose(40, 2)
    docs = table([(None, a), (5, a), (None, b), (7, prose(40, 3)), (7, prose(40, 3)), (None, None)], "doc_id long, text string")
    found = rows(m.near_duplicates(docs), "doc_id", "component_id", "kept")
    expected = [(5, 5, True), (7, 7, True), (7, 7, True), (None, 5, False), (None, None, True), (None, None, True)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_no_documents(documents):
    assert m.near_duplicates(documents([])).count() == 0
    assert m.drop_near_duplicates(documents([])).count() == 0


def test_bands_agree_as_often_as_sets_do():
    """Coordinates agree with the probability of the similarity, so a band with its power."""
    r = random.Random(4)
    agreed = total = 0
    for _ in range(60):
        words = [f"w{r.randrange(10**9)}" for _ in range(303)]
        other = words[:253] + [f"w{r.randrange(10**9)}" for _ in range(50)]
        found = []
        for block in blocks(pa.array([" ".join(words), " ".join(other)])):
            found.append(m.band_hashes(*m.shingles(block, 4)))
        one, two = np.concatenate(found)
        agreed, total = agreed + (one == two).sum(), total + m.BANDS
    similarity = 250 / 350
    assert abs(agreed / total - similarity**m.ROWS) < 0.05
