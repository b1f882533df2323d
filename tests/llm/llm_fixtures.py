"""Fixtures and helpers of these tests; test modules import the ones they use."""

import pytest

from stratalake.llm.shared import shipped

#: What every operator has to take: nulls, empty and blank texts, repeated rows, a long text.
ODD_TEXTS = [None, "", " \t\n", "a", "É", "\x1c\x85 ", "a" * 5000, "word " * 4000]


@pytest.fixture
def table(spark):
    """Makes a table of rows by a schema."""
    shipped(spark)
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def documents(table):
    """Documents by their texts, ids from 0, with the columns of the given table."""

    def make(texts, lang="en", source="s", extra=""):
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        if extra:
            rows, schema = [(*r, "x") for r in rows], f"{schema}, `{extra}` string"
        return table(rows, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    """Makes texts of invented words."""
    import random

    def make(words, seed, sentence=9, line=30):
        r = random.Random(seed)
        parts = "the of and in on er an th re ing ou ea ti st ha nt".split()
        made = []
        for i in range(words):
            made.append("".join(r.choice(parts) for _ in range(r.randint(1, 4))))
            if i % line == line - 1:
                made[-1] += "."
        text = ""
        for i, word in enumerate(made):
            text += word + ("\n" if i % line == line - 1 else " ")
        return text.strip()

    return make


def rows(df, *columns):
    """All rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
