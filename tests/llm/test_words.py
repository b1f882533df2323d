import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import rows  # noqa: F401

from stratalake.llm.words import Members, blocks, folded, windows

WORD = re.compile("[^\x20\x09-\x0d]+")
CHARS = "aB é\n\t\x0b\x1c€😀."


def texts(seed, n=60, most=40):
    r = random.Random(seed)
    return [None if r.random() < 0.1 else "".join(r.choice(CHARS) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 64, 1 << 20])
def test_words_are_those_of_the_pattern(size):
    given = texts(size)
    column = pa.chunked_array([pa.array(given[:20], pa.string()), pa.array(given[20:], pa.string())])
    found = []
    for block in blocks(column, size):
        starts, ends, firsts = block.words()
        raw = block.data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(starts, ends, strict=True)]
        found += [words[firsts[i] : firsts[i + 1]] for i in range(block.rows)]
    assert found == [WORD.findall(t or "") for t in given]


def test_hashes_are_equal_for_equal_words_only():
    block = next(blocks(pa.array(texts(5, 300))))
    starts, ends, _ = block.words()
    raw = block.data.tobytes()
    words = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
    hashes = block.hashes(starts, ends).tolist()
    assert len(set(words)) == len(set(hashes)) == len(set(zip(words, hashes, strict=True)))


def test_lower_case_is_of_ascii_alone():
    block = next(blocks(pa.array(["AbÉ abÉ abé"])))
    a, b, c = block.hashes(*block.words()[:2], lower=True)
    assert a == b != c


def test_folded_has_latin_letters_too():
    assert folded(np.frombuffer("ÀÉÞ×ßaZ€".encode(), np.uint8)).tobytes().decode() == "àéþ×ßaz€"


@pytest.mark.parametrize("n", [1, 3, 8])
def test_windows_stay_in_their_text(n):
    given = texts(n, 80)
    block = next(blocks(pa.array(given, pa.string())))
    starts, ends, firsts = block.words()
    hashes, offsets = windows(block.hashes(starts, ends), firsts, n)
    expected = [tuple(w[i : i + n]) for w in (WORD.findall(t or "") for t in given) for i in range(max(0, len(w) - n + 1))]
    assert len(hashes) == len(expected) == offsets[-1]
    assert len(set(expected)) == len(set(hashes.tolist())) == len(set(zip(expected, hashes.tolist(), strict=True)))


def test_members():
    wanted = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 500).astype(np.uint64))
    asked = np.concatenate([wanted[::3], wanted[::5] + np.uint64(1 << 40)])
    at, place = Members(wanted).find(asked)
    assert (wanted[place] == asked[at]).all() and set(at) >= set(range(len(wanted[::3])))
    assert len(Members(wanted[:0]).find(asked)[0]) == 0


def test_no_texts():
    assert list(blocks(pa.array([], pa.string()))) == []
    assert [b.rows for b in blocks(pa.array([None, None], pa.string()))] == [2]
