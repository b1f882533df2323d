"""Whitening against the full eigendecomposition."""

import numpy as np
import pytest
from llm_fixtures import rows, table  # noqa: F401

from stratalake.llm import whiten as w

SCHEMA = "vec_id long, embedding array<double>"


def brute(vectors, k=w.COMPONENTS):
    """Exact deviations, eigenvalues and vectors of the covariance, and whitened vectors."""
    x = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1000000
    n, total = len(x), x.sum(0)
    deviations = [sum(int(d) ** 2 for d in n * row - total) for row in x]
    y = (n * x - total) / n
    values, turned = np.linalg.eigh(y.T @ y / n)
    values, turned = values[::-1][:k], turned[:, ::-1][:, :k]
    return deviations, values / np.trace(y.T @ y / n), y @ turned / np.sqrt(values)


def same_up_to_sign(got, expected, tolerance=1e-8):
    signs = np.sign((got * expected).sum(0))
    assert np.abs(got * signs - expected).max() < tolerance


def check(found, ids, vectors):
    deviations, shares, z = brute(vectors)
    got = sorted(found.collect(), key=lambda r: r["vec_id"])
    order = np.argsort(ids, kind="stable")
    assert [r["vec_id"] for r in got] == [ids[i] for i in order]
    assert [int(r["deviation"]) for r in got] == [deviations[i] for i in order]
    assert {r["n"] for r in got} == {len(vectors)}
    assert np.allclose(got[0]["explained"], shares, rtol=1e-10)
    assert got[0]["identity_error"] < 1e-9
    same_up_to_sign(np.array([r["whitened"] for r in got]), z[order])


@pytest.mark.parametrize("dim, n", [(64, 700), (20, 90), (90, 400)])
def test_equals_the_full_decomposition(table, dim, n):
    """More, fewer and about as many dimensions as columns of the iteration, with clusters and scales."""
    r = np.random.default_rng(dim)
    vectors = r.normal(0, 1, (n, dim)) * np.linspace(0.5, 3, dim) + 4 * r.normal(0, 1, (5, dim))[r.integers(0, 5, n)]
    ids = [int(i) for i in r.permutation(n)]
    found = w.whiten(table([(i, v.tolist()) for i, v in zip(ids, vectors, strict=True)], SCHEMA).repartition(5))
    check(found, ids, vectors)


def test_filter_is_needed_and_certified():
    """A slowly falling spectrum of many dimensions: the certified residual holds for the true vectors."""
    r = np.random.default_rng(1)
    dim = 300
    basis = np.linalg.qr(r.normal(size=(dim, dim)))[0]
    spectrum = np.linspace(1, 0.2, dim) ** 2
    v = (basis * spectrum) @ basis.T
    found = w.chebyshev(lambda q: v @ q, dim)
    assert found.passes > w.DEGREE
    assert np.abs(found.values - spectrum[: w.COMPONENTS]).max() < 1e-12
    assert np.abs(np.abs((found.vectors * basis[:, : w.COMPONENTS]).sum(0)) - 1).max() < 1e-9


def test_rows_without_a_usable_vector_are_left_out(table):
    r = np.random.default_rng(2)
    good = r.normal(0, 5, (60, 4)).tolist()
    odd = [None, [], [1.0, None, 2.0, 3.0], [float("nan"), 1.0, 1.0, 1.0], [1.0, float("inf"), 1.0, 1.0], [1.0, 2.0], [1.0] * 5]
    data = [(i, v, "x") for i, v in enumerate([*odd, *good])] + [(7, good[0], "x")]
    found = w.whiten(table(data, f"{SCHEMA}, n string"))
    check(found, [i for i, _, _ in data[len(odd) :]], [v for _, v, _ in data[len(odd) :]])


def test_null_and_repeated_ids(table):
    good = np.random.default_rng(3).normal(0, 5, (20, 3)).tolist()
    found = w.long_form(w.whiten(table([(None if i < 2 else 1, v) for i, v in enumerate(good)], SCHEMA)))
    assert found.count() == 60 and found.where("vec_id is null").count() == 6
    assert found.dtypes[:4] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint")]


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[]]])
def test_nothing_to_divide_by(table, vectors):
    assert w.long_form(w.whiten(table([(i, v) for i, v in enumerate(vectors)], SCHEMA))).count() == 0


def test_fewer_vectors_than_components(table):
    """Ten vectors span nine directions."""
    vectors = np.random.default_rng(4).normal(0, 5, (10, 64)).tolist()
    found = w.whiten(table(list(enumerate(vectors)), SCHEMA)).collect()
    assert {len(r["whitened"]) for r in found} == {9}
    assert found[0]["identity_error"] < 1e-9


def test_great_entries(table):
    """Sums and deviations beyond 64 bits stay exact; a long that can't hold one is null."""
    vectors = (np.random.default_rng(5).normal(0, 1, (40, 3)) * 1e11).round(2).tolist()
    data = table(list(enumerate(vectors)), SCHEMA)
    found = w.whiten(data)
    check(found, list(range(40)), vectors)
    assert w.long_form(found).where("deviation is not null").count() == 0
    assert w.whiten(table([(0, [1e300, 1.0]), (1, [-1e300, 2.0]), (2, [5.0, -1e308])], SCHEMA)).count() == 3
