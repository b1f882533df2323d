import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import ODD_TEXTS, documents, prose, rows, table  # noqa: F401

from stratalake.llm import decontaminate as m


def test_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(500):
        a = [r.randrange(5) for _ in range(r.randrange(12))]
        b = [r.randrange(5) for _ in range(r.randrange(15))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert m.common_length(a, b) == table[-1][-1]


def changed(text, share, seed, keep_end=0):
    r = random.Random(seed)
    words = text.split()
    others = set(r.sample(range(len(words) - keep_end), round(share * len(words))))
    return " ".join(f"other{r.randrange(99)}" if i in others else w for i, w in enumerate(words))


def test_leaks(documents, table, prose, monkeypatch):
    """Whole passages, paraphrases that keep the answer or not, parts, and none, in texts of any length."""
    monkeypatch.setattr(m, "GROUP", 12)
    items = [prose(15 + 2 * i, 1000 + i) for i in range(20)]
    bench = table([(i, t, "x") for i, t in enumerate(items)] + [(50, None, "x"), (51, "", "x"), (52, items[0], "x"), (None, items[1], "x")], "item_id long, text string, doc_id string")
    texts, expected = list(ODD_TEXTS), set()
    for i, item in enumerate(items):
        for long in (0, 30, 700):
            texts.append(f"{prose(long, 5 * i + long)} {item} {prose(long, 7 * i + long)}")
            expected.add((len(texts) - 1, i))
        texts.append(f"{prose(60, i)}\n{item.upper()}!\n{prose(60, i + 50)}")
        expected.add((len(texts) - 1, i))
        texts.append(f"{prose(60, i)} {' '.join(item.split()[: len(item.split()) // 3])} {prose(60, i + 50)}")
    clean_from = len(texts)
    texts += [prose(300, 3000 + i) for i in range(40)]
    expected |= {(d, 52) for d, i in expected if i == 0} | {(d, None) for d, i in expected if i == 1}
    docs = documents(texts, extra="item_id")
    found = m.contamination(docs, bench)
    assert set(rows(found, "doc_id", "item_id")) == expected
    assert found.count() == len(expected)
    clean = m.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r[0] for r in rows(clean, "doc_id")) == [i for i in range(len(texts)) if i not in {d for d, _ in expected}]
    assert clean_from in {r[0] for r in rows(clean, "doc_id")}


def test_paraphrases_need_the_answer(documents, table, prose):
    items = [prose(40, 1000 + i) for i in range(8)]
    bench = table(list(enumerate(items)), "item_id long, text string")
    texts = [f"{prose(90, i)} {changed(x, 0.3, i, keep_end=5)} {prose(90, 50 + i)}" for i, x in enumerate(items)]
    texts += [f"{prose(90, i)} {' '.join(changed(x, 0.25, i).split()[:-5])} {prose(90, 50 + i)}" for i, x in enumerate(items)]
    found = {d: (c / n, a) for d, c, n, a in rows(m.contamination(documents(texts), bench), "doc_id", "n_common", "n_tokens", "answer_found")}
    assert sorted(d for d in found if d < 8) == list(range(8))
    assert all(share >= m.VERBATIM or answer for share, answer in found.values())
    assert not [d for d in found if d >= 8]


@pytest.mark.parametrize("size", [300, 1000])
def test_long_passages(documents, table, prose, size):
    """Copies and paraphrases of passages many windows long, whose pieces are those of several spaces."""
    items = [prose(size, 1000 + i) for i in range(8)]
    bench = table(list(enumerate(items)), "item_id long, text string")
    texts = [f"{prose(100, i)} {x} {prose(100, 50 + i)}" for i, x in enumerate(items)]
    texts += [f"{prose(100, i)} {changed(x, 0.35, i, keep_end=5)} {prose(100, 50 + i)}" for i, x in enumerate(items)]
    texts += [f"{prose(100, i)} {' '.join(x.split()[: size // 2])} {prose(900, 50 + i)}" for i, x in enumerate(items)]
    found = rows(m.contamination(documents(texts), bench), "doc_id", "item_id", "n_tokens")
    assert found == sorted([(d, d % 8, size) for d in range(16)], key=repr)


def test_a_keyword_repeated_before_a_passage(documents, table, prose):
    """The passage's rarest word three times just before it doesn't hide it."""
    words = [w.strip(".") for w in prose(400, 7).split()]
    item = words[:16] + ["keyword"] + words[17:20]
    text = words[100:148] + ["keyword"] * 3 + [words[200]] + item + words[201:300]
    assert text[48:51] == ["keyword"] * 3 and text[52:72] == item
    bench = table([(1, " ".join(item))], "item_id long, text string")
    # others that hold the passage's other words, so that the keyword is its rarest
    others = [" ".join(x for w in item if w != "keyword" for x in (w, words[300 + i])) for i in range(5)]
    found = m.contamination(documents([" ".join(text), *others]), bench)
    assert (0, 1, 20, 20) in rows(found, "doc_id", "item_id", "n_common", "n_tokens")


def test_best_part_is_that_of_all_alignments():
    """Ranges of starts that are left out hold no longer leak."""
    r = random.Random(4)
    leaks = 0
    for _ in range(400):
        size = r.randint(1, 24)
        item = [r.randrange(1, 30) for _ in range(size)]
        middle = [x for x in item if r.random() < 0.6]
        text = [r.randrange(1, 90) for _ in range(r.randint(0, 50))] + middle + [r.randrange(1, 90) for _ in range(r.randint(0, 50))]
        passage = m.Passage(np.array(item, np.uint64))
        room, tail = -(-size // 3), item[-m.ANSWER :]
        first, last = -room - size, len(text)
        every = []
        for start in range(first, last + 1):
            part = text[max(0, start) : max(0, start + size + 2 * room)]
            n, answer = m.common_length(item, part), m.common_length(tail, part) >= max(1, len(tail) - 1)
            if n / size >= m.VERBATIM or n / size >= m.PARAPHRASE and answer:
                every.append(n)
        found = passage.best(np.array(text, np.uint64), first, last)
        assert (found[0] if found else None) == max(every, default=None)
        leaks += found is not None
    assert 50 < leaks < 390


def test_repeated_rows_of_a_benchmark_are_searched_once(documents, table, prose, monkeypatch):
    """Null, blank and repeated rows don't reach the driver; each repeated row has its leaks."""
    item = prose(30, 1)
    given = [(7, item)] * 40 + [(8, item), (None, None)] + [(None, None)] * 40 + [(9, ".!")] * 40 + [(10, prose(30, 2))]
    seen, build = [], m.build_pass
    monkeypatch.setattr(m, "build_pass", lambda passages, *rest: seen.append(passages.count()) or build(passages, *rest))
    found = m.contamination(documents([f"{prose(50, 3)} {item}"]), table(given, "item_id long, text string"))
    assert rows(found, "doc_id", "item_id") == [(0, 7)] * 40 + [(0, 8)]
    assert seen == [2]


def rarest_changed(text, share, counts, seed):
    """The text with the rarest part of its words replaced by new ones; the last five stay."""
    r = random.Random(seed)
    words = text.split()
    by_count = sorted(range(len(words) - 5), key=lambda i: counts[words[i].lower().strip(".")])
    others = set(by_count[: round(share * len(words))])
    return " ".join(f"new{r.randrange(10**9)}" if i in others else w for i, w in enumerate(words))


@pytest.mark.parametrize("size", [15, 27, 40, 59, 120])
def test_recall_of_all_leaks(spark, table, size):
    """Of leaks by the check itself, over every alignment, nearly all are found whatever words were replaced."""
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").orderBy("doc_id").collect()]
    texts = [" ".join((t or "").split()) for t in texts]
    counts = Counter(w for t in texts for w in {x.lower().strip(".") for x in t.split()})
    r = random.Random(size)
    long = [t for t in texts if len(t.split()) > size + 20]
    items, planted = [], []
    for i in range(25):
        words = r.choice(long).split()
        begin = r.randrange(len(words) - size)
        items.append(" ".join(words[begin : begin + size]))
        for made in (items[-1], changed(items[-1], 0.35, i, 5), rarest_changed(items[-1], 0.2, counts, i), rarest_changed(items[-1], 0.35, counts, i), rarest_changed(items[-1], 0.38, counts, i)):
            other = r.choice(long).split()
            cut = r.randrange(len(other))
            planted.append(" ".join([*other[:cut], made, *other[cut:]]))
    bench = table(list(enumerate(items)), "item_id long, text string")
    docs = table(list(enumerate(planted + texts)), "doc_id long, text string")
    found = {tuple(x) for x in rows(m.contamination(docs, bench), "doc_id", "item_id")}
    passages = [m.Passage(own) for own in m.token_lists(pa.array(items))]
    leaks = set()
    for doc_id, own in enumerate(m.token_lists(pa.array(planted))):
        for item_id, passage in enumerate(passages):
            if passage.best(own, -passage.size - passage.room, len(own)):
                leaks.add((doc_id, item_id))
    assert len(leaks) > 115  # a few texts are no leaks, as new words may fall upon repeated ones
    assert len(leaks & found) >= 0.99 * len(leaks)
    assert {x for x in found if x[0] < len(planted)} <= leaks


def test_many_passes_give_what_one_does(documents, table, prose, monkeypatch):
    """Passages of several passes, and tokens counted in several scans."""
    items = [prose(30, 1000 + i) for i in range(30)]
    bench = table(list(enumerate(items)), "item_id long, text string")
    docs = documents([f"{prose(50, i)} {x} {prose(50, 50 + i)}" for i, x in enumerate(items)])
    one = rows(m.contamination(docs, bench).drop("cosine"))
    for name, value in (("GROUP", 3), ("SPACES", 2), ("COUNTED", 100)):
        monkeypatch.setattr(m, name, value)
    assert rows(m.contamination(docs, bench).drop("cosine")) == one
    assert len(one) >= 30


def test_pieces_cover_a_passage():
    for size in range(1, 400):
        starts = m.piece_starts(size)
        assert {i for s in starts for i in range(s, min(s + m.WINDOW, size))} == set(range(size))
        assert len(set(starts)) == len(starts) and max(starts) + min(m.WINDOW, size) == size
    assert m.piece_starts(0) == []
    text = " ".join(f"Wört{i}," for i in range(100))
    assert [len(x) for x in m.token_lists(pa.array(m._pieces(text)))] == [48] * len(m.piece_starts(100))


def test_token_vectors_are_singular_vectors(table, prose):
    """With as many dimensions as passages nothing is lost: products in the latent space are those of the rows."""
    texts = [prose(30, i) for i in range(12)] + [prose(30, 0)]
    lists = m.token_lists(pa.array(texts))
    vocabulary = np.unique(np.concatenate(lists))
    weights = np.linspace(1, 3, len(vocabulary))
    found = m.token_vectors(table([(t,) for t in texts], "text string").repartition(3), vocabulary, weights)
    rows_ = np.zeros((len(texts), len(vocabulary)))
    for i, own in enumerate(lists):
        np.add.at(rows_[i], np.searchsorted(vocabulary, own), weights[np.searchsorted(vocabulary, own)])
    assert found.shape[1] == 12
    assert np.allclose(found.T @ found, np.eye(12), atol=1e-4)
    assert np.allclose((rows_ @ found) @ (rows_ @ found).T, rows_ @ rows_.T, atol=1e-2)


def space_of(items, documents_of):
    """A latent space of the passages, each of its own dimension."""
    lists = m.token_lists(pa.array(items))
    vocabulary = np.unique(np.concatenate(lists))
    weights = np.sqrt(np.log(1000 / documents_of(vocabulary)))
    at = [np.searchsorted(vocabulary, own) for own in lists]
    a = np.zeros((len(items), len(vocabulary)))
    for i, own in enumerate(at):
        np.add.at(a[i], own, weights[own])
    vectors = np.linalg.svd(a, full_matrices=False)[2].T.astype(np.float32)
    pieces = np.array([weights[own] @ vectors[own] for own in at], np.float32)
    return m.Space(np.arange(len(items)), vocabulary, weights, vectors, pieces, m.least_products([weights[own] for own in at]))


def test_bounds_leave_out_no_candidate(prose):
    """Candidates are those of all products, of passages of many sizes."""
    items = [prose(5 + i % 44, 1000 + i) for i in range(101)]
    space = space_of(items, lambda v: 1 + v % np.uint64(900))
    texts = [f"{prose(30, i)} {changed(x, 0.1 * (i % 6), i)} {prose(90, 50 + i)}" for i, x in enumerate(items)]
    found, expected = {}, {}
    vectors = space.vectors * space.weights[:, None].astype(np.float32)
    for block in m.blocks(pa.array(texts)):
        hashes, firsts = m.tokens(block)
        found |= {(row, begin, i): cosine for row, begin, i, cosine in m.Searcher(space).candidates(hashes, firsts)}
        for row in range(len(texts)):
            own = hashes[firsts[row] : firsts[row + 1]]
            for begin in m.piece_starts(len(own))[:-1] + [m.STRIDE * (len(m.piece_starts(len(own))) - 1)]:
                at = np.flatnonzero(np.isin(space.vocabulary, own[begin : begin + m.WINDOW]))
                window = vectors[at].sum(0)
                for i in np.flatnonzero(space.pieces @ window >= space.least * (1 - 1e-4)):
                    expected[row, begin, int(i)] = space.pieces[i] @ window / np.linalg.norm(space.pieces[i]) / np.linalg.norm(window)
    assert found.keys() == expected.keys() and len(found) > 100
    assert all(abs(found[k] - expected[k]) < 1e-5 for k in found)


def test_windows_of_other_texts_are_not_summed_piece_by_piece():
    """Windows with words of many passages, but few of any, are left out by sums over bundles of pieces."""
    r = random.Random(3)
    items = [" ".join(f"word{48 * i + j}" for j in range(48)) for i in range(200)]
    space = space_of(items, lambda v: np.ones(len(v)))
    texts = [" ".join(f"word{r.randrange(48 * 200)}" for _ in range(2000)) for _ in range(13)]
    searcher = m.Searcher(space)
    (block,) = m.blocks(pa.array(texts))
    hashes, firsts = m.tokens(block)
    tracemalloc.start()
    assert list(searcher.candidates(hashes, firsts)) == []
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # the products of a thousand windows' tokens with 200 pieces are 39 MB


@pytest.mark.parametrize("empty", ["documents", "benchmark"])
def test_empty_tables(documents, table, prose, empty):
    docs = documents([] if empty == "documents" else [prose(50, 1)])
    bench = table([] if empty == "benchmark" else [(1, prose(50, 1))], "item_id long, text string")
    assert m.contamination(docs, bench).count() == 0
    assert m.decontaminate(docs, bench).count() == docs.count()


def test_small_tables_need_no_python_workers(documents, prose):
    docs = documents([prose(30, 1)])
    counts, _ = m.document_counts(docs, docs.select("text"))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "RDD" not in plan and counts.count() > 0
