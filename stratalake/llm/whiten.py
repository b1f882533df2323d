"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every entry c becomes the whole number floor(64 * c) + 1000000. The covariance V of those vectors (centred
before multiplying, divisor n) is never built: a pass over the data takes V Q = X'(X Q) / n for a few columns Q,
where each task sums its own part and the parts are added up by dimension.

The components are the eigenvectors of the ``COMPONENTS`` largest eigenvalues, found with ``GUARD`` more
columns. A cycle of the iteration is

1. a pass for V Q, and Rayleigh-Ritz on it: the eigenvectors of Q'V Q turn Q to the Ritz vectors;
2. ``DEGREE`` - 1 further passes of the Chebyshev recurrence, whose polynomial is at most 1 between the
   lower bound of the spectrum and the least Ritz value of the guard and grows fast above that, so that the
   unwanted directions are damped;
3. QR of the filtered columns, each scaled to length 1 before.

The first pass of a cycle is also the first step of its recurrence. The lower bound comes from a Lanczos
recurrence on one more column, which takes part in the passes of the first cycle: its least Ritz value
less its last residual. The iteration ends when it is certified: the residual norm of every component is at
most ``TOLERANCE`` of the largest eigenvalue; rounding may hold residuals above that, so it also ends when
they stay below ``SETTLED`` of it and no longer halve. Without either after ``CYCLES`` cycles it is an error. If there are no more
dimensions than columns, the first cycle is exact.

At the start the vectors are written once as blocks of whole numbers, in as few bytes as a block's range
needs; every pass reads those. The driver holds matrices of dimensions by columns only.

Rows whose vector is null, or has a null or non-finite entry, are left out. Vectors have the length that most
of the rest have (of several such, the greatest); others, and empty ones, are left out too. Entries beyond 2^53 / 64 count as that.
Components whose eigenvalue is nothing but rounding (all vectors equal, fewer vectors than
components, dependent dimensions) are left out, as nothing can be divided by it. Repeated rows count as often as they occur;
a null id is an id. Equal eigenvalues have some orthonormal basis of their space. An empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.shared import lean, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS, GUARD = 32, 16
DEGREE, CYCLES = 8, 60
TOLERANCE, SETTLED = 2e-14, 1e-10
#: Eigenvalues up to this part of the largest one, times the dimensions, are rounding.
RANK = 1e-15
#: Entries of a block of vectors, about.
BLOCK_ENTRIES = 1 << 18
_MOST = float(1 << 53)
_LOW = (1 << 31) - 1
_WIDTHS = (np.uint8, np.uint16, np.uint32, np.uint64)

_BLOCK = pa.schema(
    [
        ("dim", pa.int64()),
        ("n", pa.int64()),
        ("low", pa.int64()),
        ("width", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("data", pa.binary()),
    ]
)
_BLOCKS = "dim long, n long, low long, width int, ids array<long>, data binary"
_PARTS = "row long, values array<double>"


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) of each length there is, without null and non-finite ones."""
    flat, sizes = column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    begins = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == dim)
        own = values[begins[rows][:, None] + np.arange(dim)]
        fine = np.isfinite(own).all(1)
        if fine.any():
            yield rows[fine], own[fine]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``BLOCK_ENTRIES`` entries."""
    entries = pc.sum(pc.list_value_length(batch.column(1))).as_py() or 1
    step = max(1, BLOCK_ENTRIES * len(batch) // entries)
    for first in range(0, len(batch), step):
        yield batch.slice(first, step)


def whole_numbers(entries: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000 of each entry."""
    return np.floor(np.clip(SCALE * entries, -_MOST, _MOST)).astype(np.int64) + SHIFT


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in (part for batch in batches for part in _slices(batch)):
        for rows, entries in _matrices(part.column(1)):
            x = whole_numbers(entries)
            low, high = int(x.min()), int(x.max())
            kind = next(w for w in _WIDTHS if high - low <= np.iinfo(w).max)
            block = {
                "dim": x.shape[1],
                "n": len(x),
                "low": low,
                "width": np.dtype(kind).itemsize,
                "ids": part.column(0).take(pa.array(rows)).to_pylist(),
                "data": (x - low).astype(kind).tobytes(),
            }
            yield pa.RecordBatch.from_pylist([block], schema=_BLOCK)


def _small(block: dict) -> np.ndarray:
    """A block's vectors less its ``low``."""
    kind = _WIDTHS[int(block["width"]).bit_length() - 1]
    return np.frombuffer(block["data"], kind).reshape(block["n"], block["dim"])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(len(batch)):
            yield {name: batch.column(name)[i].as_py() for name in ("dim", "n", "low", "width", "data")} | {
                "ids": batch.column("ids")[i].values
            }


@dataclass
class Moments:
    """How many vectors there are, and the exact sum of each dimension."""

    n: int
    sums: list[int]

    def mean_above(self, low: int) -> np.ndarray:
        """The mean less a whole number, without losing digits to it."""
        return np.array([(s - low * self.n) / self.n for s in self.sums])

    def centred(self, block: dict) -> np.ndarray:
        return _small(block).astype(np.float64) - self.mean_above(block["low"])

    def deviations(self, block: dict) -> tuple[list[int], np.ndarray]:
        """The sum over dimensions of (n x - S)^2, exact, and x - S / n of each vector."""
        x = _small(block)
        room = max(map(abs, (s - block["low"] * self.n for s in self.sums)), default=0) + self.n * int(x.max(initial=0))
        kind = np.int64 if room < 1 << 62 else object
        y = x.astype(kind) * self.n - np.array([s - block["low"] * self.n for s in self.sums], kind)
        squares = y if room * room * x.shape[1] < 1 << 62 else y.astype(object)
        return (squares * squares).sum(1).tolist(), (y / self.n).astype(np.float64)


def _moments(blocks: DataFrame) -> Moments:
    """Sums go through Spark in two parts, so that no number of entries overflows one."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for block in _each(batches):
            x, base = _small(block), block["low"] * block["n"]
            own = x.sum(0, dtype=np.uint64 if block["width"] < 8 else object).tolist()
            total = [a + b + base for a, b in zip(total or [0] * len(own), own, strict=True)]
        columns = [range(len(total)), [s >> 31 for s in total], [s & _LOW for s in total]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["row", "high", "rest"])

    found = blocks.mapInArrow(lean(sums), "row long, high long, rest long").groupBy("row").agg(F.sum("high"), F.sum("rest")).collect()
    n = blocks.agg(F.sum("n")).first()[0] or 0
    return Moments(n, [(r[1] << 31) + r[2] for r in sorted(found)])


def _summed(table: pa.Table) -> pa.Table:
    lists = table["values"].combine_chunks()
    values = lists.flatten().to_numpy().reshape(len(lists), -1).sum(0)
    return pa.table({"row": table["row"][:1], "values": pa.array([values], pa.list_(pa.float64()))})


class Data:
    """The written blocks of a table's vectors, and passes over them."""

    def __init__(self, vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding"):
        chosen = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("vector"))
        blocks = written(chosen.mapInArrow(lean(_to_blocks), _BLOCKS))
        lengths = blocks.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
        self.dim = lengths[0]["dim"] if lengths else 0
        self.written, self.blocks = blocks, blocks.where(F.col("dim") == self.dim)
        self.context = vectors.sparkSession.sparkContext
        self.moments = _moments(self.blocks) if lengths else Moments(0, [])

    def total(self, of: Callable[[np.ndarray], np.ndarray], height: int, width: int) -> np.ndarray:
        """The sum of a matrix over all blocks of centred vectors."""
        moments = self.context.broadcast(self.moments)

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = np.zeros((height, width))
            for block in _each(batches):
                made += of(moments.value.centred(block))
            yield pa.RecordBatch.from_pydict({"row": pa.array(np.arange(height)), "values": pa.array(list(made), pa.list_(pa.float64()))})

        rows = self.blocks.select("dim", "n", "low", "width", F.lit(None).cast("array<long>").alias("ids"), "data")
        made = np.zeros((height, width))
        for row in rows.mapInArrow(lean(parts), _PARTS).groupBy("row").applyInArrow(_summed, _PARTS).collect():
            made[row["row"]] = row["values"]
        moments.unpersist()
        return made

    def times(self, columns: np.ndarray) -> np.ndarray:
        """V Q for the columns Q."""
        shared = self.context.broadcast(columns)
        found = self.total(lambda y: y.T @ (y @ shared.value), *columns.shape) / self.moments.n
        shared.unpersist()
        return found

    def variances(self) -> np.ndarray:
        """The diagonal of V."""
        return self.total(lambda y: (y * y).sum(0)[:, None], self.dim, 1)[:, 0] / self.moments.n


class Lanczos:
    """A Lanczos recurrence that is given one product with V after the other."""

    def __init__(self, dim: int, seed: int):
        start = np.random.default_rng(seed).standard_normal(dim)
        self.basis, self.diagonal, self.beside, self.done = [start / np.linalg.norm(start)], [], [], False

    @property
    def column(self) -> np.ndarray:
        return self.basis[-1]

    def add(self, product: np.ndarray) -> None:
        if self.done:
            return
        self.diagonal.append(float(product @ self.basis[-1]))
        rest = product
        for _ in range(2):
            for q in self.basis:
                rest = rest - (rest @ q) * q
        length = float(np.linalg.norm(rest))
        self.beside.append(length)
        self.done = length <= 1e-12 * max(map(abs, self.diagonal)) or len(self.basis) == len(rest)
        if not self.done:
            self.basis.append(rest / length)

    def lower_bound(self) -> float:
        if not self.diagonal:
            return 0.0
        inner = self.beside[: len(self.diagonal) - 1]
        least = np.linalg.eigvalsh(np.diag(self.diagonal) + np.diag(inner, 1) + np.diag(inner, -1))[0]
        return max(0.0, float(least) - (0.0 if self.done else self.beside[-1]))


@dataclass
class Components:
    """Eigenvalues, falling, and their vectors as columns; how they were found."""

    values: np.ndarray
    vectors: np.ndarray
    passes: int
    residual: float


def chebyshev(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int = COMPONENTS, seed: int = 5) -> Components:
    """The largest eigenvalues of the positive semi-definite map ``times`` and their vectors, certified."""
    size = min(dim, wanted + GUARD)
    wanted = min(wanted, dim)
    lanczos = Lanczos(dim, seed + 1)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, size)))[0]
    passes, before = 0, np.inf

    def product(columns: np.ndarray, first_cycle: bool) -> np.ndarray:
        nonlocal passes
        passes += 1
        if not first_cycle or lanczos.done:
            return times(columns)
        made = times(np.column_stack([columns, lanczos.column]))
        lanczos.add(made[:, -1])
        return made[:, :-1]

    for cycle in range(CYCLES):
        v = product(q, cycle == 0 and size < dim)
        inner = q.T @ v
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, v = q @ turn, v @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(v[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        sure = residual <= TOLERANCE * top or size == dim or top == 0.0
        if sure or (residual <= SETTLED * top and residual > before / 2):
            return Components(np.maximum(values[:wanted], 0.0), q[:, :wanted], passes, residual)
        before = residual
        low, cut = lanczos.lower_bound() if cycle else 0.0, float(values[-1])
        half, middle = (cut - low) / 2, (cut + low) / 2
        if half <= 1e-14 * top:  # nothing but rounding is left to damp
            q = np.linalg.qr(v)[0]
            continue
        # scaled by the value at the largest eigenvalue, so that nothing overflows
        scale = first = half / (top - middle)
        old, new = q, (v - middle * q) * (first / half)
        for _ in range(DEGREE - 1):
            following = 1 / (2 / first - scale)
            step = product(new, cycle == 0) - middle * new
            old, new = new, step * (2 * following / half) - old * (scale * following)
            scale = following
        lengths = np.linalg.norm(new, axis=0)
        q = np.linalg.qr(new / np.where(lengths > 0, lengths, 1))[0]
    raise ArithmeticError(f"components are not certified after {CYCLES} cycles: the largest residual is {residual} of {top}")


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, n, deviation, whitened array, explained array, identity_error) of each vector.

    ``deviation`` is the exact sum over dimensions of (n x - S)^2, as decimal(38, 0). The identity error is
    the largest absolute entry of the whitened vectors' covariance less the identity, from a pass over all.
    """
    data = Data(vectors, vec_id, embedding)
    spark, moments = vectors.sparkSession, data.moments
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if moments.n == 0:
        return spark.createDataFrame([], schema)
    found = chebyshev(data.times, data.dim, components)
    real = found.values > RANK * data.dim * max(float(found.values[0]), 0.0)
    values, directions = found.values[real], found.vectors[:, real]
    if not len(values):
        return spark.createDataFrame([], schema)
    turn = data.context.broadcast(directions / np.sqrt(values))
    size = len(values)

    def spread(y: np.ndarray) -> np.ndarray:
        z = y @ turn.value
        return np.vstack([z.T @ z, z.sum(0)])

    total = data.total(spread, size + 1, size) / moments.n
    error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(size)).max())
    shared = data.context.broadcast(moments)
    kind = pa.decimal128(38, 0)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _each(batches):
            deviations, y = shared.value.deviations(block)
            z = y @ turn.value
            ends = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            columns = [block["ids"], pa.array([Decimal(d) if d < 10**38 else None for d in deviations], kind)]
            columns.append(pa.ListArray.from_arrays(ends, pa.array(z.ravel())))
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    rows = data.blocks.mapInArrow(lean(project), "vec_id long, deviation decimal(38,0), whitened array<double>")
    shares = F.array(*[F.lit(float(e)) for e in values / data.variances().sum()])
    return rows.select(
        "vec_id",
        F.lit(moments.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def long_form(found: DataFrame) -> DataFrame:
    """One row for each vector and component; deviations that no long holds are null."""
    each = found.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        F.element_at("explained", F.col("at") + 1).alias("explained"),
        "identity_error",
    )
