import math
import random

import pytest
from llm_fixtures import ODD_TEXTS, documents, prose, rows, table  # noqa: F401
from pyspark.sql import functions as F

from stratalake.llm import toxicity as m
from stratalake.llm.words import block_of

BAD = ["stupid", "idiot", "worthless", "moron"]


def with_words(text, words, seed):
    parts = text.split(" ")
    r = random.Random(seed)
    for word in words:
        parts.insert(r.randrange(len(parts)), word)
    return " ".join(parts)


@pytest.fixture(scope="module")
def fitted(spark, prose):
    from stratalake.llm.shared import shipped

    r = random.Random(1)
    texts = [prose(80, i) for i in range(160)]
    toxic = [i % 4 == 0 for i in range(160)]
    texts = [with_words(t, r.sample(BAD, r.randint(1, 3)), i) if bad else t for i, (t, bad) in enumerate(zip(texts, toxic, strict=True))]
    shipped(spark)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(900, None, 1)], "doc_id long, text string, toxic int")
    labels = [(i, 0, int(t)) for i, t in enumerate(toxic)] + [(900, 0, 0), (3, 0, None), (None, 0, 1), (0, 0, 1)]
    return m.Toxicity(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def scores(model, docs):
    return [s for _, s in sorted(rows(docs.select("doc_id", model.score(F.col("text")).alias("s"))))]


DISGUISES = ["stupid", "STUPID!", "s7up1d", "$tup!d", "st*pid", "s t u p i d", "s.t.u.p.i.d", "stuuuupid", "1d10t", "id i0t"[:2] + "10t", "wоrthless", "m0r0n,"]


def test_disguised_words_score_like_plain_ones(fitted, documents, prose):
    texts = [with_words(prose(80, 700), [word], 5) for word in DISGUISES] + [prose(80, 700 + i) for i in range(12)]
    found = scores(fitted, documents(texts, extra="score"))
    assert min(found[: len(DISGUISES)]) >= 0.3 > max(found[len(DISGUISES) :])


def test_odd_texts(fitted, documents):
    found = scores(fitted, documents([*ODD_TEXTS, "idiot", "idiot"]))
    assert all(0 <= s < 0.3 for s in found[: len(ODD_TEXTS)])
    assert found[0] == found[1] < found[-1] == found[-2]


@pytest.mark.parametrize(
    "word, text",
    [("st0p", "stop"), ("w1th", "with"), ("heeello", "hello"), ("t.h.e", "the"), ("th*", "the"), ("n0t$$$", "not"), ("all", "all")],
)
def test_decoding(word, text):
    words = "stop with hello the the the not not all all tall".split()
    grams = {}
    for w in words:
        marked = f"^^{w}$"
        for i in range(len(marked) - 2):
            grams[marked[i : i + 3]] = grams.get(marked[i : i + 3], 0) + 1
    assert m.decode(word, m.CharModel(grams)) == text


def model_of(words):
    grams = {}
    for w in words.split():
        for i in range(len(w) + 1):
            gram = f"^^{w}$"[i : i + 3]
            grams[gram] = grams.get(gram, 0) + 1
    return m.CharModel(grams)


@pytest.mark.parametrize(
    "word, text",
    [("aidiot", "a idiot"), ("youidiot", "you idiot"), ("1hate", "i hate"), ("baddog", "bad dog"), ("stupid", "stupid"), ("alllove", "all love")],
)
def test_rows_of_letters_are_decoded_into_words(word, text):
    model = model_of(20 * "a i a i you you hate idiot idiot stupid stupid bad dog all love all love the dog ")
    assert m.decode(word, model, True) == text


@pytest.mark.parametrize("word, text", [("i****", "idiot"), ("wor******", "worthless"), ("w" + "*" * 30, "w")])
def test_masks_stand_for_as_many_letters_as_signs(word, text):
    assert m.decode(word, model_of(20 * "idiot worthless ")) == text
    assert m.disguised(block_of([f"a {word} there".encode()]))[1] == [word]


def test_words_within_rows_of_letters_and_masks_are_cues(spark, documents, prose):
    from stratalake.llm.shared import shipped

    r = random.Random(3)
    shipped(spark)
    texts = [f"you and I do a {prose(60, i)}" for i in range(160)]
    texts = [with_words(t, 3 * [r.choice(BAD)], i) if i % 4 == 0 else t for i, t in enumerate(texts)]
    labels = [(i, int(i % 4 == 0)) for i in range(160)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = m.Toxicity(spark, docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    hidden = ["you are a i d i o t here", "y o u i d i o t", "I m o r o n"]
    found = scores(model, documents([*hidden, "y o u a n d I", "and I do a", "do a* the**"]))
    assert min(found[: len(hidden)]) >= 0.3 > max(found[len(hidden) :])


def test_trigrams_are_those_of_all_documents(table, monkeypatch):
    monkeypatch.setattr(m, "HELD_WORDS", 2)
    docs = table([(0, "some words"), (1, "zyxwvu zyxwvu some"), (2, None), (3, "more zyxwvu words")], "doc_id long, text string")
    model = m.Toxicity(docs.sparkSession, docs, table([(0, 0)], "doc_id long, toxic int"))
    assert model.trigrams.value["zyx"] == 2 and model.trigrams.value["^so"] == 2


def test_decoding_is_the_best_path():
    """Viterbi finds what trying all paths finds."""
    from itertools import product

    model = m.CharModel({"^^a": 5, "^ab": 3, "abi": 2, "bia": 1, "ia$": 1, "^al": 2, "ali": 2, "li$": 1, "bi$": 1})

    def cost(text):
        marked = f"^^{text}$"
        return sum(model.cost(marked[i : i + 3]) for i in range(len(marked) - 2))

    for word in ("a81a", "4bb1", "al!", "a.b.i", "aa8ii", "*bi"):
        paths = []
        for path in product(*m.lattice(m._TAIL.sub("", word), model.alphabet)):
            text = "".join(t for t, _ in path)
            paths.append((sum(c for _, c in path) + cost(text), text))
        assert m.decode(word, model) == min(paths)[1]


def test_which_words_look_disguised():
    texts = ["plain words, here. And 42", "st0p th.e.e.m w o r d s", "a b", "soooo x!!!", "Wörter$$$ straße", "mіx", ""]
    found = m.disguised(block_of([t.encode() for t in texts]))
    assert list(zip(found[0].tolist(), found[1], strict=True)) == [
        (1, "st0p"),
        (1, "th.e.e.m"),
        (3, "soooo"),
        (4, "Wörter$$$"),
        (5, "mіx"),
        (1, "words"),
    ]


def test_without_toxic_documents(spark, documents, table):
    labels = table([(0, 0)], "doc_id long, toxic int")
    model = m.Toxicity(spark, documents(["some words"]), labels)
    assert all(s < 0.3 for s in scores(model, documents(["idiot", None])))
    empty = m.Toxicity(spark, documents([]), labels.where("false"))
    assert all(s < 0.3 for s in scores(empty, documents(["idiot", None])))


def test_the_curve_is_right_for_labels_that_are_separated():
    points = [(0.0, 0, 9000), (1.9, 0, 4000), (3.0, 0, 800), (20.0, 1, 300), (90.0, 1, 900), (400.0, 1, 50)]
    a, b = m.fit_curve(points)
    score = {x: 1 / (1 + math.exp(-(a + b * x))) for x, _, _ in points}
    assert max(score[0.0], score[1.9], score[3.0]) < 0.05 and min(score[20.0], score[90.0], score[400.0]) > 0.95
    assert m.fit_curve([(0.0, 0, 10)]) == (-30.0, 0.0)


def test_the_curve_is_the_best_one():
    points = [(0.0, 0, 70), (0.0, 1, 10), (2.0, 0, 20), (2.0, 1, 30), (5.0, 1, 25), (5.0, 0, 2)]
    a, b = m.fit_curve(points, ridge=1e-9)

    def loss(a, b):
        return sum(n * (math.log1p(math.exp(a + b * x)) - y * (a + b * x)) for x, y, n in points)

    assert all(loss(a, b) <= loss(a + da, b + db) for da in (-0.01, 0, 0.01) for db in (-0.01, 0, 0.01))
