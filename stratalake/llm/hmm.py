"""A hidden Markov language model of words, trained by Baum-Welch over the whole corpus.

A text's tokens are its words, A-Z in lower case, and one end. The ``FREQUENT`` most frequent words of
the training texts and the end are symbols of their own; every other word is a symbol by its last
letters, one of ``CLASSES``, times the probability of the word within its class. That factor is the
same in all states, so it leaves the recursion and is summed per document by a join with the counts
of all words. Thus the model that is broadcast has a fixed size, while what is counted grows with
the corpus: all words of all training texts, and the expected counts of every state.

Training: from a random start, ``SAMPLE_ROUNDS`` and ``FULL_ROUNDS`` rounds, each over all training texts. In each round every task runs
the scaled forward and backward recursions over its texts and emits its expected counts, which are added
up by symbol. A round has a task for every ``POOL_TOKENS`` of the corpus, or for each core if those are more, as each emits
counts of most symbols; a task gathers that many before it groups texts by length.
Scoring is the scaled forward recursion alone: the exact likelihood of the whole sequence of tokens.
Texts are worked on in strips of time of ``STRIP_TOKENS``: scoring hands the states' probabilities from strip to
strip, training keeps them at the start of each and computes a strip's values again on its way back. So beside its
symbols (4 bytes a token; some ten times that while it is split into words) the longest text costs no memory.

Base: the sum over tokens of log10((c + 0.5) / (N + 0.5 * (V + 1))) with the counts c of training
tokens, N in all and V distinct.

Null and empty texts have one token, the end. Equal texts get equal scores. Rows are scored one by
one, whatever their ids; extra columns are ignored. Without training texts every word is unknown. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.shared import lean, written
from stratalake.llm.words import Block, blocks

STATES = 8
FREQUENT = 1 << 16
CLASSES = 32
#: Rounds that once read a sample of so many texts and rounds over all; now all of them read all training texts.
SAMPLE_DOCS, SAMPLE_ROUNDS, FULL_ROUNDS = 4000, 12, 2
#: Tokens that are grouped by length at a time, and of a task of a round.
POOL_TOKENS = 1 << 23
#: Tokens that are worked on together.
BATCH_TOKENS = 1 << 19
#: Tokens whose values are held at a time.
STRIP_TOKENS = 1 << 19
#: Times between which values are scaled; they don't fall by more than 1e-38 each.
SCALED = 8
#: Distinct words that a task holds before it emits their counts.
HELD_WORDS = 1 << 21
STICKY = 0.9
SMOOTH = 0.5


def word_keys(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """A key for each word, whose lowest bits are its class, and each text's first word."""
    starts, ends, firsts = block.words()
    hashes = block.hashes(starts, ends, lower=True)
    if not len(starts):
        return hashes, firsts
    last = block.data[ends - 1].astype(np.uint64)
    before = block.data[np.maximum(ends - 2, starts)].astype(np.uint64)
    kind = (last * np.uint64(31) + before) % np.uint64(CLASSES)
    return (hashes & ~np.uint64(CLASSES - 1)) | kind, firsts


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a task's texts with how often each occurs, once for each so many distinct ones."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys[0].view(np.int64)), pa.array(counts[0])], ["word", "n"])

    for batch in batches:
        for block in blocks(batch.column(0)):
            found, n = np.unique(word_keys(block)[0], return_counts=True)
            keys.append(found)
            counts.append(n)
            if sum(map(len, keys[1:])) >= HELD_WORDS // 4:
                keys[:], counts[:] = ([x] for x in _summed(keys, counts))
                if len(keys[0]) >= HELD_WORDS:
                    yield out()
                    keys[:], counts[:] = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    keys[:], counts[:] = ([x] for x in _summed(keys, counts))
    yield out()


class Vocabulary:
    """Counts of all training words (a table), and the frequent ones (broadcast, ``FREQUENT`` at most)."""

    def __init__(self, training: DataFrame):
        spark = training.sparkSession
        counted = training.select("text").mapInArrow(lean(_count_words), "word long, n long")
        self.counts = written(counted.groupBy("word").agg(F.sum("n").alias("c")))
        self.texts = training.count()
        totals = self.counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.tokens = (totals["n"] or 0) + self.texts
        self.distinct = totals["v"] + (self.texts > 0)
        top = self.counts.where(F.col("c") >= _least_frequent(self.counts)).toPandas()
        words = top["word"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(words)
        self.words, self.frequent = words[order], top["c"].to_numpy(np.int64)[order]
        self.base = _log_base(np.append(self.frequent, self.texts), self.tokens, self.distinct)
        self.shared = spark.sparkContext.broadcast((self.words, self.base))

        kind = F.pmod("word", F.lit(CLASSES))
        rare = self.counts.join(F.broadcast(spark.createDataFrame(pa.table({"word": pa.array(top["word"], pa.int64())}))), "word", "left_anti")
        by_class = {r["kind"]: r for r in rare.groupBy(kind.alias("kind")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
        self.class_tokens = np.array([by_class[k]["n"] if k in by_class else 0 for k in range(CLASSES)], np.int64)
        self.class_words = np.array([by_class[k]["v"] if k in by_class else 0 for k in range(CLASSES)], np.int64)

    @property
    def symbols(self) -> np.ndarray:
        """How often each symbol occurs: the frequent words, the end, the classes."""
        return np.concatenate([self.frequent, [self.texts], self.class_tokens]).astype(float)

    def encode(self, docs: DataFrame, packed: bool = False) -> DataFrame:
        """``docs`` (doc_id, text, held_out) as symbols, with the words of classes beside; written.

        ``packed`` symbols are bytes, four each, which Spark passes on whole.
        """
        shared = self.shared
        kind = "binary" if packed else "array<int>"
        schema = f"doc_id long, held_out boolean, symbols {kind}, base double, rare array<struct<word: bigint, n: int>>"

        def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, base = shared.value
            places = Places(words)
            for batch in batches:
                for block in blocks(batch.column(1)):
                    part = batch.slice(block.first, block.rows)
                    symbols, *others = _encode_block(block, places, base)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(2), _packed(symbols) if packed else symbols, *others],
                        ["doc_id", "held_out", "symbols", "base", "rare"],
                    )

        rows = docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(lean(encoded), schema)
        return written(rows.withColumn("key", F.monotonically_increasing_id()))


def _least_frequent(counts: DataFrame) -> int:
    """The count from which on words are frequent, so that ``FREQUENT`` words are at most."""
    steps = counts.groupBy(F.floor(16 * F.log2("c")).alias("step")).agg(F.count("*").alias("words"), F.min("c").alias("least"))
    words, least = 0, 1 << 62
    for row in sorted(steps.collect(), key=lambda r: -r["step"]):  # some hundreds, however large the corpus
        words += row["words"]
        if words > FREQUENT:
            break
        least = row["least"]
    return least


def _log_base(counts: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    return np.log10((counts + 0.5) / (tokens + 0.5 * (distinct + 1)))


class Places:
    """Places of keys in a sorted array, as ``np.searchsorted`` gives them, by a table of their highest bits."""

    BITS = 18

    def __init__(self, words: np.ndarray):
        self.shift = np.uint64(64 - self.BITS)
        self.words = words
        self.padded = np.append(words, np.uint64(2**64 - 1))
        self.first = np.searchsorted(words, np.arange(1 << self.BITS, dtype=np.uint64) << self.shift)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.first[(keys >> self.shift).astype(np.int64)]
        low = np.flatnonzero(self.padded[at] < keys)
        while len(low):
            at[low] += 1
            low = low[self.padded[at[low]] < keys[low]]
        return at


def _encode_block(block: Block, places: Places, base: np.ndarray) -> list[pa.Array]:
    words = places.words
    keys, firsts = word_keys(block)
    rows = np.repeat(np.arange(block.rows), np.diff(firsts))
    at = np.minimum(places.find(keys), max(len(words) - 1, 0))
    known = words[at] == keys if len(words) else np.zeros(len(keys), bool)
    end = len(words)
    symbols = np.where(known, at, end + 1 + (keys & np.uint64(CLASSES - 1)).astype(np.int64))
    symbols = np.insert(symbols, firsts[1:], end).astype(np.int32)
    sums = np.bincount(rows[known], base[at[known]], block.rows) + base[end]

    rare_rows, rare = rows[~known], keys[~known]
    order = np.lexsort((rare, rare_rows))
    rare_rows, rare = rare_rows[order], rare[order]
    new = np.ones(len(rare), bool)
    new[1:] = (rare[1:] != rare[:-1]) | (rare_rows[1:] != rare_rows[:-1])
    begins = np.flatnonzero(new)
    times = np.diff(np.append(begins, len(rare))).astype(np.int32)
    ends = np.searchsorted(rare_rows[begins], np.arange(block.rows + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(rare[begins].view(np.int64)), pa.array(times)], ["word", "n"])
    offsets = (firsts + np.arange(block.rows + 1)).astype(np.int32)
    return [
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols)),
        pa.array(sums),
        pa.ListArray.from_arrays(pa.array(ends), pairs),
    ]


class Model:
    """Probabilities of states at the start, of the next state, and of symbols by state (symbols x states)."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @cached_property
    def by_state(self) -> np.ndarray:
        """The probabilities of symbols, those of a state side by side."""
        return np.ascontiguousarray(self.emit.T)

    @classmethod
    def random(cls, symbols: np.ndarray, seed: int = 7) -> Model:
        """Sticky states, whose symbols vary at random around how frequent they are."""
        made = np.random.default_rng(seed)
        emit = (symbols + SMOOTH)[:, None] * np.exp(made.normal(0, 0.5, (len(symbols), STATES)))
        step = np.full((STATES, STATES), (1 - STICKY) / max(1, STATES - 1))
        np.fill_diagonal(step, STICKY if STATES > 1 else 1.0)
        return cls(np.full(STATES, 1 / STATES), step, emit / emit.sum(0))

    def trained(self, counts: np.ndarray, symbols: np.ndarray) -> Model:
        """The model by expected counts: rows of symbols, then of steps by state, then of starts.

        Symbols are smoothed by how frequent they are in all texts, so that none is impossible.
        """
        n = len(symbols)
        prior = (symbols + SMOOTH) / (symbols + SMOOTH).sum()
        emit = counts[:n] + SMOOTH * STATES * prior[:, None] * np.sqrt(n)
        step, start = counts[n : n + STATES] + 0.1, counts[n + STATES] + 0.1
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def batches_of(offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Texts in groups of about ``BATCH_TOKENS`` tokens, the longest first, those of similar length together."""
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    total = np.cumsum(sizes[order])
    first = 0
    while first < len(order):
        last = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + BATCH_TOKENS, "right")))
        yield order[first:last]
        first = last


class Room:
    """Memory for values by state, used again by one strip after the other: to get it anew costs as much as a pass over it."""

    def __init__(self) -> None:
        self._held: dict[str, np.ndarray] = {}

    def array(self, name: str, states: int, tokens: int) -> np.ndarray:
        if len(self._held.get(name, ())) < states * tokens:
            self._held.pop(name, None)
            self._held[name] = np.empty(states * tokens)
        return self._held[name][: states * tokens].reshape(states, tokens)


class Strip:
    """Parts of texts, longest first, with the symbols of one time side by side."""

    def __init__(self, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray):
        self.width = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # parts longer than t
        self.at = np.concatenate([[0], np.cumsum(self.width)])
        self.ends = self.at[sizes - 1] + np.arange(len(sizes))
        text = np.repeat(np.arange(len(sizes)), sizes)
        time = np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.symbols = np.empty(len(text), np.int64)
        self.symbols[self.at[time] + text] = symbols[np.repeat(begins, sizes) + time]

    def forward(self, model: Model, now: np.ndarray, room: Room | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, their scales, and the probabilities of the symbols, by time and text.

        ``now`` are the probabilities of the states at the first time, before its symbols. Values have a row
        for each state, so that each step runs over long rows of texts. They are scaled to a sum of one at every
        ``SCALED``-th time only; elsewhere scales are one. The values lie in ``room``, until it is used again.
        """
        room, states, tokens = room or Room(), len(model.by_state), len(self.symbols)
        emit, alpha = room.array("emit", states, tokens), room.array("alpha", states, tokens)
        for own, to in zip(model.by_state, emit, strict=True):
            np.take(own, self.symbols, out=to, mode="clip")  # all are within; other modes copy once more
        scale = np.ones(tokens)
        onward = model.step.T
        at = self.at.tolist()
        for t, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            if t:
                now = np.dot(onward, now[:, : b - a])
            now = np.multiply(now, emit[:, a:b], out=alpha[:, a:b])
            if t % SCALED == 0:
                now /= np.add.reduce(now, 0, out=scale[a:b])
        return alpha, scale, emit

    def last(self, alpha: np.ndarray, texts: int) -> np.ndarray:
        """The values at the last time, of so many texts."""
        return alpha[:, self.at[-2] : self.at[-2] + texts].copy()


class Lattice:
    """A group of texts, longest first, worked on in strips of time."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray, group: np.ndarray, room: Room | None = None):
        self.room = room or Room()
        self.symbols, self.begins, self.sizes = symbols, offsets[group], np.diff(offsets)[group]
        self.starts, t = [], 0
        while t < self.sizes[0]:
            self.starts.append(t)
            left = np.maximum(self.sizes - t, 0)
            t += int(left[0]) if left.sum() <= STRIP_TOKENS else max(1, STRIP_TOKENS // self._texts(t))

    def _texts(self, t: int) -> int:
        """How many texts are longer than ``t``."""
        return int(np.searchsorted(-self.sizes, -t, "left"))

    def _strip(self, i: int) -> Strip:
        t, n = self.starts[i], self._texts(self.starts[i])
        end = self.starts[i + 1] if i + 1 < len(self.starts) else self.sizes[0]
        return Strip(self.symbols, self.begins[:n] + t, np.minimum(self.sizes[:n], end) - t)

    def _first(self, model: Model) -> np.ndarray:
        return np.broadcast_to(model.start[:, None], (len(model.start), len(self.sizes)))

    def log10(self, model: Model) -> np.ndarray:
        """The log10 probability of each text."""
        total, now = np.zeros(len(self.sizes)), self._first(model)
        for i in range(len(self.starts)):
            strip = self._strip(i)
            alpha, scale, _ = strip.forward(model, now, self.room)
            for a, b in zip(strip.at[:-1:SCALED].tolist(), strip.at[1::SCALED].tolist(), strict=True):
                total[: b - a] += np.log10(scale[a:b])
            left = self._texts(self.starts[i + 1]) if i + 1 < len(self.starts) else 0
            total[left : now.shape[1]] += np.log10(alpha[:, strip.ends[left:]].sum(0))
            if left:
                now = model.step.T @ strip.last(alpha, left)
        return total

    def add_counts(self, model: Model, counts: np.ndarray) -> None:
        """Add the expected counts of symbols, steps and starts."""
        now, before = self._first(model), []  # the values at the end of each strip but the last
        for i, t in enumerate(self.starts[1:]):
            strip = self._strip(i)
            before.append(strip.last(strip.forward(model, now, self.room)[0], self._texts(t)))
            now = model.step.T @ before[-1]
        n, states = model.emit.shape
        beta, steps = np.ones((states, len(self.sizes))), np.zeros_like(model.step)
        for i in reversed(range(len(self.starts))):
            strip = self._strip(i)
            earlier = before[i - 1] if i else None
            alpha, scale, emit = strip.forward(model, model.step.T @ earlier if i else self._first(model), self.room)
            left = self._texts(self.starts[i + 1]) if i + 1 < len(self.starts) else 0
            beta[:, left : len(strip.ends)] = 1 / alpha[:, strip.ends[left:]].sum(0)
            at = strip.at.tolist()
            for t in range(len(strip.width) - 1, -1, -1):
                a, b = at[t], at[t + 1]
                width = b - a
                if i or t:
                    weight = np.multiply(emit[:, a:b], beta[:, :width], out=emit[:, a:b])
                    if t % SCALED == 0:
                        weight /= scale[a:b]
                    steps += np.dot(alpha[:, at[t - 1] : at[t - 1] + width] if t else earlier, weight.T)
                alpha[:, a:b] *= beta[:, :width]
                if i or t:
                    beta[:, :width] = np.dot(model.step, weight)
            for state in range(states):
                counts[:n, state] += np.bincount(strip.symbols, alpha[state], n)
        counts[n : n + states] += steps * model.step
        counts[n + states] += alpha[:, : len(self.sizes)].sum(1)


def _packed(lists: pa.ListArray) -> pa.Array:
    """Lists of 32-bit numbers as their bytes."""
    offsets = pa.array(lists.offsets.to_numpy().astype(np.int64) * 4)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, offsets.buffers()[1], lists.values.buffers()[1]]).cast(pa.binary())


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, or of their bytes, and where each list begins."""
    if not pa.types.is_list(column.type):
        column = column.cast(pa.large_binary())
        _, where, data = column.buffers()
        offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        symbols = np.frombuffer(data, np.int32, (offsets[-1] - offsets[0]) // 4, offsets[0]) if offsets[-1] > offsets[0] else np.zeros(0, np.int32)
        return symbols, (offsets - offsets[0]) // 4
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def pools(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The symbols of several batches, of ``POOL_TOKENS`` or one batch more, and where each text begins."""
    held, size = [], 0
    for batch in batches:
        held.append(_lists(batch.column(0)))
        size += len(held[-1][0])
        if size >= POOL_TOKENS:
            made, held, size = _joined(held), [], 0
            yield made
    if held:
        made, held = _joined(held), []
        yield made


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.concatenate([np.diff(offsets) for _, offsets in parts])
    return np.concatenate([symbols for symbols, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])


def expected_counts(encoded: DataFrame, model: Model, tokens: int = 0) -> np.ndarray:
    """Expected counts over all rows, of so many tokens: summed in each task, then by row of the counts."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    names = [f"s{k}" for k in range(STATES)]
    height = len(model.emit) + STATES + 1

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, room = shared.value, np.zeros((STATES, height)).T, Room()
        for symbols, offsets in pools(batches):
            for group in batches_of(offsets):
                Lattice(symbols, offsets, group, room).add_counts(own, counts)
        rows = np.flatnonzero(counts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(rows), *(pa.array(counts[rows, k]) for k in range(STATES))], ["row", *names])

    tasks = max(encoded.sparkSession.sparkContext.defaultParallelism, -(-tokens // POOL_TOKENS))
    parts = encoded.select("symbols").coalesce(tasks).mapInArrow(lean(expect), "row long, " + ", ".join(f"{n} double" for n in names))
    found = parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    shared.unpersist()
    counts = np.zeros((height, STATES))
    counts[found["row"].to_numpy(np.int64)] = found[names].to_numpy(float)
    return counts


def train(encoded: DataFrame, vocabulary: Vocabulary) -> Model:
    """Baum-Welch, every round over all encoded training texts."""
    symbols = vocabulary.symbols
    model = Model.random(symbols)
    if not vocabulary.texts:
        return model
    for _ in range(SAMPLE_ROUNDS + FULL_ROUNDS):
        model = model.trained(expected_counts(encoded, model, vocabulary.tokens), symbols)
    return model


def forward_score(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, room = model.value, Room()
        for batch in batches:
            symbols, offsets = _lists(batch.column(0))
            found = np.zeros(len(batch))
            for group in batches_of(offsets):
                found[group] = Lattice(symbols, offsets, group, room).log10(own)
            columns = [*batch.columns[1:], pa.array(np.diff(offsets)), pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "held_out", "base", "n_tokens", "forward"])

    return score


def score(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, held_out) with counts of tokens, the base score and the model's score.

    The model learns from rows that aren't ``held_out``.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(docs.where("not held_out"))
    encoded = vocabulary.encode(docs, packed=True)
    model = train(encoded.where("not held_out"), vocabulary)

    # words of classes: their counts, by a join on the word
    rare = encoded.select("key", F.explode("rare").alias("r")).select("key", "r.word", "r.n")
    rare = rare.join(vocabulary.counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    within = (vocabulary.class_tokens + 0.5 * (vocabulary.class_words + 1)).tolist()
    of_class = F.element_at(F.array(*map(F.lit, within)), (F.pmod("word", F.lit(CLASSES)) + 1).cast("int"))
    total = vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)
    rare = rare.groupBy("key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum("n").alias("rare_tokens"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / total)).alias("rare_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / of_class)).alias("rare_score"),
    )
    shared = spark.sparkContext.broadcast(model)
    scored = encoded.select("symbols", "key", "doc_id", "held_out", "base").mapInArrow(
        lean(forward_score(shared)), "key long, doc_id long, held_out boolean, base double, n_tokens long, forward double"
    )
    rows = scored.join(rare, "key", "left").na.fill(0, ["rare_known", "rare_tokens", "rare_base", "rare_score"])
    end_known = 1 if vocabulary.texts else 0
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_tokens") - 1 + end_known - F.col("rare_tokens") + F.col("rare_known")).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_base")).alias("base_score"),
        (F.col("forward") + F.col("rare_score")).alias("score"),
    )
