"""Benchmark decontamination by latent semantic retrieval.

Tokens are runs of letters and digits in lower case. Benchmark passages are cut into overlapping pieces of
``WINDOW`` tokens, shorter ones are one piece. Pieces are vectors of their tokens weighted by the square
root of inverse document frequency, which is counted over all documents. A randomised SVD of that
matrix, whose products are summed over the partitions of the pieces, gives each token a vector of
``LATENT`` numbers. Every document is cut into overlapping windows of ``WINDOW`` tokens, each window
becomes the weighted sum of its different tokens' vectors, and its product with every piece is taken. A leak keeps
``PARAPHRASE`` of a piece's tokens, at worst its most frequent ones; a passage is a candidate if a window's cosine with a piece is
at least what a window of that length would have with the ``COVER`` part of those. Windows whose whole weight is less than that for every piece
are left out before.

A candidate is checked by the longest common subsequence of the passage and each part of the document
where it can lie: the passage's length and a third of it on both sides, for every alignment of one of its
tokens with one of a candidate window. It is a leak if that is ``VERBATIM`` of the passage, or ``PARAPHRASE``
of it and the answer, its last ``ANSWER`` tokens, is there but for one token. The part with the longest one
counts; alignments are left out only in ranges whose whole text bounds them below that, or below a leak.

What may be missed is a leak that is so stretched, within the third on both sides, that no window holds ``COVER`` of
what is left of a piece. README has figures by kind of paraphrase; no document or window is left out otherwise.

Passages are the query set. Every ``GROUP`` pieces have a latent space, so that a space has about
as many dimensions as pieces and tells them apart; about ``SPACES`` of them are searched in one pass over the
documents, so that what is broadcast is bounded, and freed after it. A passage's pieces are all searched in the same pass.
Tokens are counted before, for all passes at once, ``COUNTED`` different ones in one scan.
Each different text is searched once, and joined with the ids of all its rows after.

Null and empty texts, and passages without tokens, match nothing. Long texts are searched window by window; equal texts get equal results; rows
with equal ids give their own rows. Passages with equal texts all match. Empty tables give no rows.
Extra columns are kept by ``decontaminate`` and otherwise ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.shared import lean, size_bounded, without, written
from stratalake.llm.words import Block, Members, blocks, folded

LATENT, OVERSAMPLE = 256, 16
WINDOW, STRIDE = 48, 24
#: The part of a paraphrase that one window holds.
COVER = 0.7
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 5
#: Pieces of a latent space at most, and spaces that are searched in one pass in expectation.
GROUP, SPACES = 200, 24
#: Pieces whose products with a window are bounded together before they are summed.
BUNDLE = 8
#: Different tokens of passages whose documents are counted in one scan, in expectation (8 bytes each).
COUNTED = 1 << 21
#: Documents found that are joined by broadcast; more are joined by shuffle.
BROADCAST_ROWS = 300_000

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True


def tokens(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and each text's first."""
    starts, ends, firsts = block.runs(_TOKEN[block.data])
    return Block(block.first, folded(block.data), block.offsets).hashes(starts, ends), firsts


def token_lists(texts: pa.Array) -> list[np.ndarray]:
    made = []
    for block in blocks(texts):
        hashes, firsts = tokens(block)
        made += np.split(hashes, firsts[1:-1])
    return made


def piece_starts(size: int) -> list[int]:
    """First tokens of the pieces of a passage of so many tokens; the last one ends with the passage."""
    return [*range(0, size - WINDOW, STRIDE), max(0, size - WINDOW)] if size else []


@dataclass
class Space:
    """A latent space: the passage of each piece, token weights and vectors, piece vectors, and the least product of a candidate."""

    owners: np.ndarray
    vocabulary: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    pieces: np.ndarray
    least: np.ndarray


@dataclass
class Pass:
    """What a pass over the documents needs: hashes and tokens of passages, and the spaces of their pieces."""

    items: list[tuple[int, np.ndarray]]
    spaces: list[Space]


_TOKENS = "token long"
#: Small tables are made of Arrow ones: lists would be passed through Python workers of their own by every job that reads them.
_COUNTS = pa.schema([("token", pa.int64()), ("n", pa.int64())])


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different tokens of a batch's texts."""
    for batch in batches:
        every = np.unique(np.concatenate([np.zeros(0, np.uint64), *token_lists(batch.column(0))]))
        yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64))], ["token"])


def document_counts(docs: DataFrame, passages: DataFrame) -> tuple[DataFrame, int]:
    """(token, n): in how many documents each token of the passages is; and how many documents there are."""
    spark = docs.sparkSession
    every = written(passages.select("text").mapInArrow(lean(_distinct_tokens), _TOKENS).distinct())
    scans = max(1, -(-every.count() // COUNTED))
    found = spark.createDataFrame(_COUNTS.empty_table())
    for part in range(scans):
        chosen = every.where(F.pmod(F.xxhash64("token"), F.lit(scans)) == part).toPandas()["token"].to_numpy(np.int64)
        shared = spark.sparkContext.broadcast(np.sort(chosen.view(np.uint64)))
        found = found.union(written(_count(docs, shared)))
        shared.unpersist()
    total = found.where("token is null").agg(F.max("n")).first()[0] or 0
    return found.where("token is not null"), total


def _count(docs: DataFrame, shared: Broadcast) -> DataFrame:
    """(token, n) of the tokens that are shared, and of a null token the number of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = Members(shared.value)
        size = len(shared.value)
        total, texts = np.zeros(size, np.int64), 0
        for batch in batches:
            texts += len(batch)
            for block in blocks(batch.column(0)):
                hashes, firsts = tokens(block)
                at, token = members.find(hashes)
                row = np.searchsorted(firsts, at, "right") - 1
                total += np.bincount(np.unique(row * size + token) % max(size, 1), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(shared.value[seen].view(np.int64)), pa.array(total[seen])], ["token", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([texts], pa.int64())], ["token", "n"])

    return docs.select("text").mapInArrow(lean(count), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _rows(texts: pa.Array, vocabulary: np.ndarray, weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Token numbers and weights of each text, tokens repeated as in the text."""
    made = []
    for own in token_lists(texts):
        at = np.searchsorted(vocabulary, own)
        made.append((at, weights[at]))
    return made


def token_vectors(passages: DataFrame, vocabulary: np.ndarray, weights: np.ndarray, seed: int = 11) -> np.ndarray:
    """Right singular vectors of the weighted passages (tokens x ``LATENT`` at most).

    With A the passages and W random: the Gram matrix of A W is summed over partitions and gives an
    orthonormal basis Q = A W T; then Q' A, a vector for each token, is summed over partitions too.
    The singular vectors of that small matrix come from its own Gram matrix.
    """
    context = passages.sparkSession.sparkContext
    width = LATENT + OVERSAMPLE
    shared = context.broadcast((vocabulary, weights))

    def projected(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        own, weight = shared.value
        random = np.random.default_rng(seed).standard_normal((len(own), width))
        rows = _rows(texts, own, weight)
        return rows, np.array([w @ random[at] for at, w in rows]).reshape(len(rows), width)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            _, y = projected(batch.column(0))
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"row": pa.array(np.arange(width)), "values": pa.array(list(total), pa.list_(pa.float64()))})

    def summed(table: pa.Table) -> pa.Table:
        values = np.array(table["values"].to_pylist(), np.float64).sum(0)
        return pa.table({"row": table["row"][:1], "values": pa.array([values], pa.list_(pa.float64()))})

    def total_of(parts: DataFrame, height: int) -> np.ndarray:
        found = np.zeros((height, width))
        for row in parts.groupBy("row").applyInArrow(summed, "row long, values array<double>").collect():
            found[row["row"]] = row["values"]
        return found

    schema = "row long, values array<double>"
    square = total_of(passages.select("text").mapInArrow(lean(gram), schema), width)
    values, turned = np.linalg.eigh(square)
    good = values > max(values.max(), 0) * 1e-10
    turn = context.broadcast(turned[:, good] / np.sqrt(values[good]))

    def basis(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(shared.value[0]), width))
        for batch in batches:
            rows, y = projected(batch.column(0))
            q = y @ turn.value
            for (at, w), own in zip(rows, q, strict=True):
                np.add.at(total[:, : q.shape[1]], at, w[:, None] * own)
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_pydict({"row": pa.array(at), "values": pa.array(list(total[at]), pa.list_(pa.float64()))})

    small = total_of(passages.select("text").mapInArrow(lean(basis), schema), len(vocabulary))
    values, turned = np.linalg.eigh(small.T @ small)
    keep = np.argsort(-values)[:LATENT]
    keep = keep[values[keep] > max(values.max(), 0) * 1e-10]
    return (small @ turned[:, keep] / np.sqrt(values[keep])).astype(np.float32)


def _pieces(text: str) -> list[str]:
    """The texts of a passage's pieces."""
    for block in blocks(pa.array([text], pa.string())):
        starts, ends, _ = block.runs(_TOKEN[block.data])
        raw = block.data.tobytes()
        return [raw[starts[i] : ends[min(i + WINDOW, len(ends)) - 1]].decode() for i in piece_starts(len(starts))]
    return []


def least_products(weights: list[np.ndarray]) -> np.ndarray:
    """The least product of a piece, by its tokens' weights, with a window that holds enough of it."""
    kept = [np.sort(w**2)[: -int(-PARAPHRASE * len(w) // 1)].sum() for w in weights]
    return np.array(kept) * COVER


def build_pass(passages: DataFrame, counts: DataFrame, total: int) -> Pass:
    """Passages (passage, text) with tokens and the latent spaces of their pieces; ``counts`` of ``total`` documents by token."""
    spark = passages.sparkSession
    rows = passages.orderBy("passage", "text").collect()  # GROUP * SPACES pieces in expectation
    lists = token_lists(pa.array([r["text"] for r in rows], pa.string())) if rows else []
    items = [(row["passage"], own) for row, own in zip(rows, lists, strict=True)]
    texts = [piece for row in rows for piece in _pieces(row["text"])]
    owners = np.array([i for i, (_, own) in enumerate(items) for _ in piece_starts(len(own))], np.int64)
    if not items:
        return Pass([], [])
    every = np.unique(np.concatenate([own for _, own in items]))
    own_tokens = passages.select("text").mapInArrow(lean(_distinct_tokens), _TOKENS).distinct()
    in_docs = np.zeros(len(every), np.int64)
    counted = counts.join(F.broadcast(own_tokens), "token", "left_semi").toPandas()  # tokens of GROUP * SPACES pieces in expectation
    in_docs[np.searchsorted(every, counted["token"].to_numpy(np.int64).view(np.uint64))] = counted["n"].to_numpy(np.int64)
    spaces = []
    for first in range(0, len(texts), GROUP):
        part = texts[first : first + GROUP]
        own_lists = token_lists(pa.array(part, pa.string()))
        vocabulary = np.unique(np.concatenate(own_lists))
        weights = (np.log((1 + total) / (1 + in_docs[np.searchsorted(every, vocabulary)])) + 1e-3) ** 0.5
        own_rows = spark.createDataFrame(pa.table({"text": pa.array(part, pa.string())}))
        vectors = token_vectors(own_rows, vocabulary, weights)
        at = [np.searchsorted(vocabulary, own) for own in own_lists]
        pieces = np.array([weights[a] @ vectors[a] for a in at], np.float32)
        least = least_products([weights[a] for a in at])
        spaces.append(Space(owners[first : first + GROUP], vocabulary, weights, vectors, pieces, least))
    return Pass(items, spaces)


def _bits(tokens: list[int]) -> dict[int, int]:
    """The places of each token as a number's bits."""
    where: dict[int, int] = {}
    for i, token in enumerate(tokens):
        where[token] = where.get(token, 0) | 1 << i
    return where


def _common(matches: list[int], size: int) -> int:
    """Length of the longest common subsequence by each token's places in the other list, of so many tokens."""
    full = (1 << size) - 1
    row = full
    for match in matches:
        match &= row
        row = (row + match | row - match) & full
    return size - row.bit_count()


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence; one word of bits holds a row of the table."""
    where = _bits(a)
    return _common([where.get(token, 0) for token in b], len(a))


class Passage:
    """A passage made ready in a task."""

    def __init__(self, tokens: np.ndarray):
        self.size = len(tokens)
        self.where = _bits(tokens.tolist())
        self.room = -(-self.size // 3)
        self.tail = min(ANSWER, self.size)
        self.least = next(n for n in range(self.size + 1) if n / self.size >= PARAPHRASE)
        self.verbatim = next(n for n in range(self.size + 1) if n / self.size >= VERBATIM)

    def starts(self, begin: int, end: int) -> tuple[int, int]:
        """First and last start of the parts where it can lie, if one of its tokens is in this window."""
        return begin - self.size + 1 - self.room, end - 1 - self.room

    def best(self, text: np.ndarray, first: int, last: int, length: int = 0) -> tuple[int, bool] | None:
        """Common length, and whether the answer is there, of the longest leak over ``length`` with a start in this range.

        The whole text of a range bounds what its parts have in common, so most ranges fall at once.
        """
        low, high = max(0, first), max(0, last + self.size + 2 * self.room)
        here = text[low:high].tolist()
        at = [i for i, token in enumerate(here, low) if token in self.where]
        matches = [self.where[here[i - low]] for i in at]
        above = self.size - self.tail
        found = None

        def of(one: int, two: int) -> tuple[int, bool]:
            a, b = bisect_left(at, one), bisect_left(at, two + self.size + 2 * self.room)
            part = matches[a:b]
            n = _common(part, self.size) if len(part) > max(length, self.least - 1) else 0
            if n <= length or n < self.least:
                return 0, False
            answer = _common([match >> above for match in part], self.tail) >= max(1, self.tail - 1)
            return (n, answer) if answer or n >= self.verbatim else (0, False)

        ranges = [(*of(first, last), first, last)] if first <= last else []
        while ranges:
            n, answer, one, two = ranges.pop()
            if n <= length:
                continue
            if one == two:
                length, found = n, (n, answer)
                continue
            middle = (one + two) // 2
            ranges += sorted((*of(a, b), a, b) for a, b in ((one, middle), (middle + 1, two)))
        return found


_FOUND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("passage", pa.int64()),
        ("cosine", pa.float64()),
        ("n_common", pa.int32()),
        ("n_tokens", pa.int32()),
        ("answer_found", pa.bool_()),
    ]
)
FOUND = "doc_id long, text_hash long, passage long, cosine double, n_common int, n_tokens int, answer_found boolean"


class Searcher:
    """A space made ready in a task. ``dots`` has the product of each weighted token vector with each piece.

    Pieces lie in bundles of ``BUNDLE``, ordered by their least products. ``bounds`` has for each token and bundle the
    greatest part of a least product that the token adds to one of its pieces, so that windows whose parts don't
    sum up to one are no candidates of any of them; all others are summed piece by piece.
    """

    def __init__(self, space: Space):
        self.space, self.members = space, Members(space.vocabulary)
        self.vectors = space.vectors * space.weights[:, None].astype(np.float32)
        pieces = len(space.pieces)
        bundles = -(-pieces // BUNDLE)
        self.order = np.append(np.argsort(space.least, kind="stable"), np.full(bundles * BUNDLE - pieces, -1))
        dots = (self.vectors @ space.pieces.T)[:, self.order]
        self.norms = np.linalg.norm(space.pieces, axis=1)
        least = (space.least * (1 - 1e-4)).astype(np.float32)[self.order]
        dots[:, pieces:], least[pieces:] = 0, np.inf
        self.least = least.reshape(bundles, BUNDLE)
        parts = np.maximum(dots, 0) / np.maximum(least, 1e-9)
        self.bounds = np.ascontiguousarray(parts.reshape(-1, bundles, BUNDLE).max(2))
        # the products of a bundle side by side, those of token t and bundle b in row b * tokens + t
        self.dots = dots.reshape(-1, bundles, BUNDLE).swapaxes(0, 1).reshape(-1, BUNDLE)

    def candidates(self, hashes: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(text, first token there, passage, cosine) of each candidate of a block.

        A window's product with a piece is the sum of its tokens' products; both lengths divide the cosine
        and its least value alike, so products are compared, and cosines taken of candidates alone.
        """
        hit, token = self.members.find(hashes)
        total = np.concatenate([[0.0], np.cumsum(self.space.weights[token] ** 2)])
        sizes = np.diff(firsts)
        counts = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1, 0)
        row = np.repeat(np.arange(len(sizes)), counts)
        starts = firsts[row] + STRIDE * (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
        low = np.searchsorted(hit, starts)
        high = np.searchsorted(hit, np.minimum(starts + WINDOW, firsts[row + 1]))
        keep = np.flatnonzero((total[high] - total[low] >= self.space.least.min()) & (high > low))
        width = len(self.space.vocabulary)
        for first in range(0, len(keep), 1024):
            part = keep[first : first + 1024]
            n = high[part] - low[part]
            at = np.repeat(low[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            # each window's different tokens
            different = np.unique(np.repeat(np.arange(len(part)), n) * width + token[at])
            of, different = np.divmod(different, width)
            begins = np.searchsorted(of, np.arange(len(part) + 1))
            sums = np.add.reduceat(np.take(self.bounds, different, axis=0), begins[:-1])
            window, bundle = np.nonzero(sums >= 1 - 1e-3)
            if not len(window):
                continue
            n = np.diff(begins)[window]
            ends = np.cumsum(n)
            own = different[np.repeat(begins[window] - ends + n, n) + np.arange(ends[-1])]
            dots = np.add.reduceat(np.take(self.dots, own + np.repeat(bundle * width, n), axis=0), ends - n)
            pair, piece = np.nonzero(dots >= self.least[bundle])
            lengths: dict[int, float] = {}
            for j, i in zip(pair.tolist(), piece.tolist(), strict=True):
                w, place = int(window[j]), int(self.order[bundle[j] * BUNDLE + i])
                if w not in lengths:
                    lengths[w] = float(np.linalg.norm(self.vectors[different[begins[w] : begins[w + 1]]].sum(0)))
                cosine = dots[j, i] / max(lengths[w] * self.norms[place], 1e-9)
                k = part[w]
                yield int(row[k]), int(starts[k] - firsts[row[k]]), int(self.space.owners[place]), float(cosine)


def _leak(passage: Passage, text: np.ndarray, begins: list[int]) -> tuple[int, bool] | None:
    """The longest leak of a passage by its candidate windows; each start is looked at once."""
    best, done = None, None
    for begin in begins:
        first, last = passage.starts(begin, min(begin + WINDOW, len(text)))
        first = first if done is None else max(first, done + 1)
        best = passage.best(text, first, last, best[0] if best else 0) or best
        done = last
        if best and best[0] == passage.size:
            break
    return best


def search(docs: DataFrame, wanted: Pass) -> DataFrame:
    """The leaks of all documents, one row per document row and different passage; written."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def leaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = shared.value.items
        own = [Searcher(space) for space in shared.value.spaces]
        ready: dict[int, Passage] = {}
        for batch in batches:
            found: dict[tuple[int, int], tuple[int, float, bool]] = {}
            for block in blocks(batch.column(2)):
                hashes, firsts = tokens(block)
                windows: dict[tuple[int, int], list[tuple[int, float]]] = {}
                for searcher in own:
                    for row, begin, i, cosine in searcher.candidates(hashes, firsts):
                        windows.setdefault((row, i), []).append((begin, cosine))
                for (row, i), seen in windows.items():
                    if i not in ready:
                        ready[i] = Passage(passages[i][1])
                    leak = _leak(ready[i], hashes[firsts[row] : firsts[row + 1]], sorted({begin for begin, _ in seen}))
                    if leak is not None:
                        found[block.first + row, i] = (leak[0], max(cosine for _, cosine in seen), leak[1])
            items = [passages[i] for _, i in found]
            rows = pa.array([r for r, _ in found], pa.int64())
            columns = [batch.column(0).take(rows), batch.column(1).take(rows)]
            columns.append(pa.array([passage for passage, _ in items], pa.int64()))
            columns += [pa.array([v[1] for v in found.values()], pa.float64()), pa.array([v[0] for v in found.values()], pa.int32())]
            columns.append(pa.array([len(item) for _, item in items], pa.int32()))
            columns.append(pa.array([v[2] for v in found.values()], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, schema=_FOUND)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    found = written(rows.mapInArrow(lean(leaks), FOUND))
    shared.unpersist()
    return found


def _count_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with tokens, and how many pieces each has."""
    for batch in batches:
        counts = pa.array([len(piece_starts(len(own))) for own in token_lists(batch.column(0))], pa.int64())
        rows = pa.RecordBatch.from_arrays([batch.column(0), counts], ["text", "n"])
        yield rows.filter(pc.greater(counts, 0))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All leaks of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text); written.

    Columns doc_id, text_hash, item_id, cosine (the highest of a candidate window and a piece), n_common,
    n_tokens, answer_found.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.xxhash64("text").alias("passage"), "text")
    passages = items.select("text").where("text is not null").distinct().mapInArrow(lean(_count_pieces), "text string, n long")
    passages = written(passages.withColumn("passage", F.xxhash64("text")))
    pieces = passages.agg(F.sum("n").alias("n")).first()["n"] or 0
    passes = max(1, -(-pieces // (GROUP * SPACES)))
    found = spark.createDataFrame(_FOUND.empty_table())
    counts, total = document_counts(docs, passages) if pieces else (None, 0)
    for part in range(passes if pieces else 0):
        wanted = build_pass(passages.where(F.pmod("passage", F.lit(passes)) == part), counts, total)
        if wanted.spaces:
            found = found.union(search(docs, wanted))
    leaked = size_bounded(written(found.select("passage").distinct()), BROADCAST_ROWS)
    items = written(items.select("passage", "item_id").join(leaked, "passage", "left_semi"))
    found = found.join(size_bounded(items, BROADCAST_ROWS), "passage")
    return written(found.select("doc_id", "text_hash", "item_id", "cosine", "n_common", "n_tokens", "answer_found"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak."""
    return without(docs, contamination(docs, benchmark), BROADCAST_ROWS)
