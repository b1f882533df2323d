"""Toxicity of texts, obfuscated ones included, by a noisy channel.

Words that look disguised (digits or signs for letters, single letters with blanks or signs between,
letters repeated, foreign look-alikes, masked letters) become a lattice: each observed piece may stand
for several letters, each with a cost. Viterbi decoding finds the letters that are likeliest under
those costs and a character trigram model. A row of single letters is decoded as one word, and also with
words' ends allowed between any two letters; a mask stands for as many letters as it has signs, or for none
if it has more than ``MASK_SIGNS``. A document is scored by its words and the restored ones.

The trigrams are counted over all documents, which needs no labels, and the ``MAX_TRIGRAMS`` most frequent
are kept; others cost what their letters and pairs do. The rest of the model is fitted on labelled documents,
``SAMPLE`` of them in expectation, chosen by a hash of the id: cues, which are words and beginnings of words that are more frequent in toxic
documents than chance allows (a log-likelihood ratio of ``MIN_RATIO`` at least); and a logistic curve over
the sum of the log odds of a document's distinct cues. Documents propose cues; then each cue is counted
once for each pair of neighbours, so that copies of a text, near ones too, weigh as one.

Null and empty texts have no cues and get the lowest score. Equal texts get equal scores. A null
label is left out. Without toxic documents there are no cues and every score is 0. Whole texts are
scored; extra columns are kept or ignored as stated at each function.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.shared import lean
from stratalake.llm.words import Block, Members, block_of, blocks, folded

#: Labelled documents to learn from.
SAMPLE = 16_000
MIN_DOCS, MIN_RATIO = 3, 14.0
MAX_CUES, MAX_TRIGRAMS = 20_000, 200_000
#: Beginnings of words of so many bytes are cues too.
PREFIXES = (4, 5)
#: Signs of a mask that can stand for letters; longer runs are rules and frames.
MASK_SIGNS = 16
#: Distinct words that are counted before their trigrams are.
HELD_WORDS = 1 << 17

#: What a sign can stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c",
    "у": "y", "х": "x", "і": "i", "ѕ": "s", "к": "k", "м": "m", "т": "t",
}
MASK, SEPARATORS = "*", ".-_~"
SWAP_COST, MASK_COST, DROP_COST, COLLAPSE_COST, DOUBLE_COST = 1.0, 2.0, 0.5, 0.7, 2.5

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_LEET = np.zeros(256, bool)
_LEET[list(b"0123456789@$!|+(*")] = True
_INNER = np.zeros(256, bool)
_INNER[list(b"0123456789@$")] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b".-_~*")] = True
_MASK = np.zeros(256, bool)
_MASK[ord(MASK)] = True
_TAIL = re.compile(r"([^\w\s*])\1{2,}$|[.,;:?!)\]\"']+$")
_SALTS = np.array([0x9E3779B97F4A7C15 * (n + 1) % (1 << 64) for n in range(len(PREFIXES) + 1)], np.uint64)


class CharModel:
    """Interpolated character trigrams; ``^`` begins a word and ``$`` ends it."""

    def __init__(self, trigrams: dict[str, int]):
        self.trigrams, self.pairs, self.bigrams, self.firsts, self.letters = trigrams, Counter(), Counter(), Counter(), Counter()
        for gram, n in trigrams.items():
            self.pairs[gram[:2]] += n
            self.bigrams[gram[1:]] += n
            self.firsts[gram[1]] += n
            self.letters[gram[2]] += n
        self.total = sum(self.letters.values())
        self.alphabet = [c for c, _ in self.letters.most_common(64) if c.isalpha()][:40]
        self.cost = lru_cache(1 << 18)(self._cost)
        self.completion = lru_cache(1 << 16)(self._completion)
        self._of_masks: np.ndarray | None = None

    def _cost(self, gram: str) -> float:
        """Minus the log probability of the third character after the first two."""
        one = (self.letters[gram[2]] + 1) / (self.total + 256)
        two = (self.bigrams[gram[1:]] + 5 * one) / (self.firsts[gram[1]] + 5)
        return -math.log((self.trigrams.get(gram, 0) + 2 * two) / (self.pairs[gram[:2]] + 2))

    def _completion(self, state: str, masks: int) -> tuple[float, str]:
        """Cost and letters of the likeliest end of a word, of so many masked letters after these two."""
        if not masks or not self.alphabet:
            return self.cost(state + "$"), ""
        found = None
        for c in self.alphabet:
            cost, rest = self.completion(state[1] + c, masks - 1)
            made = (self.cost(state + c) + MASK_COST + cost, c + rest)
            found = made if found is None else min(found, made)
        return found

    def masked(self, best: dict[str, tuple[float, str]]) -> dict[str, tuple[float, str]]:
        """The best paths with one more masked letter, from those that end with any two of the alphabet."""
        letters = self.alphabet
        if self._of_masks is None:
            self._of_masks = np.array([[[self._cost(a + b + c) for c in letters] for b in letters] for a in letters])
        before = np.array([[best[a + b][0] for b in letters] for a in letters])
        total = before[:, :, None] + (self._of_masks + MASK_COST)
        first = total.argmin(0)
        least = np.take_along_axis(total, first[None], 0)[0].tolist()
        return {
            b + c: (least[i][k], best[letters[first[i, k]] + b][1] + c) for i, b in enumerate(letters) for k, c in enumerate(letters)
        }


def lattice(word: str, alphabet: list[str], spaced: bool = False) -> list[list[tuple[str, float]]]:
    """What each piece of a word in lower case may stand for, with costs; a run of one sign is one piece.

    In a ``spaced`` row of letters a word may also end, as a blank, within a run of two or three.
    """
    pieces, at = [], 0
    while at < len(word):
        end = at + 1
        while end < len(word) and word[end] == word[at]:
            end += 1
        sign, count = word[at], end - at
        if sign == MASK:
            pieces += [[(c, MASK_COST) for c in alphabet]] * count if count <= MASK_SIGNS else [[("", DROP_COST * count)]]
        elif sign in LOOKS or sign.isalpha():
            for letter in [LOOKS.get(sign, sign)]:
                swap = SWAP_COST * (sign in LOOKS)
                once = 0 if count == 1 else DOUBLE_COST if count == 2 else COLLAPSE_COST
                options = [(c, swap + once) for c in letter]
                if count > 1:
                    options += [(2 * c, 2 * swap + (0 if count == 2 else COLLAPSE_COST + 0.3)) for c in letter]
                if spaced and count in (2, 3):
                    forms = ("{0} {0}",) if count == 2 else ("{0}{0} {0}", "{0} {0}{0}")
                    options += [(form.format(c), count * swap) for c in letter for form in forms]
                pieces.append(options)
        elif pieces:
            pieces.append([("", DROP_COST * count)])
        at = end
    return pieces


def decode(word: str, model: CharModel, spaced: bool = False) -> str:
    """The likeliest letters behind a word, or the likeliest words behind a ``spaced`` row of letters."""
    best = {"^^": (0.0, "")}
    word = _TAIL.sub("", word.lower())
    masks = 0 if spaced else len(word) - len(word.rstrip(MASK))
    masks = masks if masks <= MASK_SIGNS else 0
    for options in lattice(word[: len(word) - masks], model.alphabet, spaced):
        if len(options) == len(model.alphabet) and len(best) == len(options) ** 2 > 100 and not spaced:
            best = model.masked(best)
            continue
        found: dict[str, tuple[float, str]] = {}
        ended = [(cost + model.cost(last + "$"), text + " ") for last, (cost, text) in best.items() if last != "^^"]
        if spaced and ended:
            best["^^"] = min([*ended, *([best["^^"]] if "^^" in best else [])])
        for last, (cost, text) in best.items():
            for letters, extra in options:
                state, total = last, cost + extra
                for c in letters:
                    total += model.cost(state + ("$" if c == " " else c))
                    state = "^^" if c == " " else state[1] + c
                if state not in found or (total, text + letters) < found[state]:
                    found[state] = (total, text + letters)
        best = found
    ends = ((cost, text, model.completion(state, masks)) for state, (cost, text) in best.items())
    return min((cost + more, text + rest) for cost, text, (more, rest) in ends)[1]


def disguised(block: Block) -> tuple[np.ndarray, list[str], list[bool]]:
    """The text and the observed form of each word, or row of single letters, that looks disguised; which are rows."""
    # a line break between texts, so that no sign has a neighbour in another text
    data = np.insert(block.data, block.offsets[1:-1], 10)
    offsets = block.offsets + np.arange(block.rows + 1)
    offsets[-1] = len(data)
    block = Block(block.first, data, offsets)
    starts, ends, firsts = block.words()
    if not len(starts):
        return np.zeros(0, np.int64), [], []
    letter, leet, separator = _LETTER[data], _LEET[data], _SEPARATOR[data]
    odd = np.zeros(len(data) + 1, bool)
    odd[1:-2] = letter[:-2] & leet[1:-1] & (letter[2:] | _INNER[data[2:]])
    odd[:-2] |= leet[:-1] & letter[1:]
    odd[1:-1] |= letter[:-1] & _MASK[data[1:]]
    odd[2:-1] |= letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    odd[1:-4] |= letter[:-4] & separator[1:-3] & letter[2:-2] & separator[3:-1] & letter[4:]
    odd[1:-1] |= (letter & (data < 0x80))[1:] & ((data[:-1] & 0xC0) == 0x80) & _cyrillic(data)[:-1]
    total = np.concatenate([[0], np.cumsum(odd[:-1])])
    strange = total[ends] > total[starts]

    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    single = chars[ends] - chars[starts] == 1
    single &= letter[starts] | leet[starts]
    rows = np.repeat(np.arange(block.rows), np.diff(firsts))
    begins = np.flatnonzero(single & ~np.concatenate([[False], single[:-1] & (rows[1:] == rows[:-1])]))
    stops = np.flatnonzero(single & ~np.concatenate([single[1:] & (rows[1:] == rows[:-1]), [False]])) + 1
    long = stops - begins >= 3
    raw = data.tobytes()
    found = [(int(rows[i]), raw[starts[i] : ends[i]].decode("utf-8", "replace")) for i in np.flatnonzero(strange & ~single)]
    words = len(found)
    for b, e in zip(begins[long], stops[long], strict=True):
        found.append((int(rows[b]), "".join(raw[starts[b] : ends[e - 1]].decode("utf-8", "replace").split())))
    return np.array([r for r, _ in found], np.int64), [w for _, w in found], [i >= words for i in range(len(found))]


def _cyrillic(data: np.ndarray) -> np.ndarray:
    """Second bytes of Cyrillic letters."""
    lead = np.zeros(len(data), bool)
    lead[1:] = (data[:-1] == 0xD0) | (data[:-1] == 0xD1)
    return lead


def _occurrences(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and neighbours of each word of letters and of its beginnings."""
    block = Block(block.first, folded(block.data), block.offsets)
    starts, ends, firsts = block.runs(_LETTER[block.data])
    rows = np.repeat(np.arange(block.rows), np.diff(firsts))
    hashed = block.hasher()
    whole = hashed(starts, ends)
    beside = np.zeros(len(whole), np.uint64)
    same = rows[1:] == rows[:-1]
    beside[1:][same] = whole[:-1][same] * _SALTS[-1]
    beside[:-1][same] += whole[1:][same]
    found = [(rows, whole ^ _SALTS[0], beside)]
    for n, salt in zip(PREFIXES, _SALTS[1:], strict=True):
        longer = ends - starts > n
        found.append((rows[longer], hashed(starts[longer], starts[longer] + n) ^ salt, beside[longer]))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _all_occurrences(block: Block, model: CharModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of a text's words and restored words; a restored one's neighbour is the word as it was seen."""
    rows, hashes, beside = _occurrences(block)
    hidden, words, spaced = disguised(block)
    if len(words):
        own, more, _ = _occurrences(block_of([_restored(word, model, row).encode() for word, row in zip(words, spaced, strict=True)]))
        seen = block_of([word.encode() for word in words])
        seen = seen.hashes(seen.offsets[:-1], seen.offsets[1:])
        rows, hashes = np.concatenate([rows, hidden[own]]), np.concatenate([hashes, more])
        beside = np.concatenate([beside, seen[own]])
    return rows, hashes, beside


def features(block: Block, model: CharModel, cues: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct feature of its words and restored words; of ``cues`` only, if given."""
    rows, hashes, _ = _all_occurrences(block, model)
    if cues is not None:
        at, _ = _members(cues).find(hashes)
        rows, hashes = rows[at], hashes[at]
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


_kept: dict[str, tuple[bytes, object]] = {}


def _members(cues: np.ndarray) -> Members:
    key = cues.tobytes()
    if _kept.get("cues", (None,))[0] != key:
        _kept["cues"] = (key, Members(cues))
    return _kept["cues"][1]


def _model(trigrams: dict[str, int]) -> CharModel:
    """The model, made once in each worker process."""
    key = repr((len(trigrams), sum(trigrams.values()), max(trigrams, default=""))).encode()
    if _kept.get("model", (None,))[0] != key:
        _kept["model"] = (key, CharModel(trigrams))
        _words.clear()
    return _kept["model"][1]


_words: dict[tuple[str, bool], str] = {}


def _restored(word: str, model: CharModel, spaced: bool) -> str:
    """All readings of a word: as one, as several if it is a row of letters, and without a mask that ends it."""
    if (word, spaced) not in _words:
        if len(_words) >= 1 << 17:
            _words.clear()
        readings = [decode(word, model)]
        if spaced:
            readings.append(decode(word, model, spaced))
        if word.endswith(3 * MASK):
            readings.append(decode(word.rstrip(MASK), model))
        _words[word, spaced] = " ".join(dict.fromkeys(readings))
    return _words[word, spaced]


class Toxicity:
    """A fitted model; trigrams, cues and the curve are of bounded size and are broadcast."""

    def __init__(self, spark: SparkSession, docs: DataFrame, labels: DataFrame):
        """Learn from ``docs`` (doc_id, text) whose ``labels`` (doc_id, toxic) are given."""
        known = labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic").distinct()
        part = min(1.0, SAMPLE / max(1, known.count()))
        chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
        rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("long"))

        grams = docs.select("text").mapInArrow(lean(_count_trigrams), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        top = grams.orderBy(F.desc("n"), "gram").limit(MAX_TRIGRAMS)
        self.trigrams = spark.sparkContext.broadcast({r["gram"]: r["n"] for r in top.collect()})

        totals = rows.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).first()
        of_toxic, of_clean = (totals["toxic"] or 0) + 1, totals["all"] - (totals["toxic"] or 0) + 1
        found = _telling(rows.mapInArrow(lean(_feature_counter(self.trigrams)), _COUNTS), of_toxic, of_clean)
        proposed = spark.sparkContext.broadcast(_hashes([r["cue"] for r in found.select("cue").collect()]))
        seen = rows.mapInArrow(lean(_context_counter(self.trigrams, proposed)), "cue long, context long, toxic long")
        seen = seen.groupBy("cue", "context").agg(F.max("toxic").alias("toxic"))
        found = _telling(seen.select("cue", "toxic", (1 - F.col("toxic")).alias("clean")), of_toxic, of_clean)
        odds = {r["cue"]: r["odds"] for r in found.collect()}
        hashes = _hashes(list(odds))
        self.cues = spark.sparkContext.broadcast((hashes, np.array([odds[h] for h in hashes.view(np.int64).tolist()])))

        # sums of log odds, in tenths, and how often each is toxic
        seen = rows.select("toxic", F.round(10 * self.evidence(F.col("text"))).cast("long").alias("x"))
        points = [(r["x"] / 10, r["toxic"], r["count"]) for r in seen.groupBy("x", "toxic").count().collect()]
        self.curve = fit_curve(points)

    def evidence(self, text: Column) -> Column:
        """The sum of the log odds of a text's distinct cues."""
        trigrams, shared = self.trigrams, self.cues

        def of(texts: pa.Array) -> pa.Array:
            model, (cues, odds) = _model(trigrams.value), shared.value
            sums = np.zeros(len(texts))
            for block in blocks(texts):
                rows, hashes = features(block, model, cues)
                if len(rows):
                    np.add.at(sums, block.first + rows, odds[np.searchsorted(cues, hashes)])
            return pa.array(sums)

        return F.arrow_udf(lean(of), "double")(text)

    def score(self, text: Column) -> Column:
        """The probability of label 1, from 0 to 1."""
        a, b = self.curve
        return 1 / (1 + F.exp(-F.least(F.greatest(a + b * self.evidence(text), F.lit(-30.0)), F.lit(30.0))))


_COUNTS = "cue long, toxic long, clean long"


def _telling(counted: DataFrame, of_toxic: int, of_clean: int) -> DataFrame:
    """(cue, odds) of what is more frequent in toxic texts than chance allows, ``MAX_CUES`` at most."""
    counted = counted.groupBy("cue").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / of_toxic) - F.log((F.col("clean") + 0.5) / of_clean)
    part = of_toxic / (of_toxic + of_clean)
    rate = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = F.col("toxic") * F.log(rate / part)
    ratio += F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - rate) / (1 - part))).otherwise(0)
    telling = counted.where(F.col("toxic") >= MIN_DOCS).where((rate > part) & (ratio >= MIN_RATIO))
    return telling.withColumn("odds", odds).orderBy(F.desc("odds"), "cue").limit(MAX_CUES).select("cue", "odds")


def _hashes(cues: list[int]) -> np.ndarray:
    return np.sort(np.array(cues, np.int64).view(np.uint64))


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigrams of the plain words of each so many; a word counts once in each text."""
    words = Counter()

    def out() -> pa.RecordBatch:
        grams = Counter()
        for word, n in words.items():
            marked = f"^^{word}$"
            for i in range(len(marked) - 2):
                grams[marked[i : i + 3]] += n
        words.clear()
        return pa.RecordBatch.from_pydict({"gram": pa.array(grams.keys(), pa.string()), "n": pa.array(grams.values(), pa.int64())})

    for batch in batches:
        for text in batch.column(0):
            words.update({w for w in re.split(r"[\W\d_]+", (text.as_py() or "").lower()) if w})
            if len(words) >= HELD_WORDS:
                yield out()
    yield out()


def _feature_counter(trigrams):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(trigrams.value)
        for batch in batches:
            toxic = batch.column(1).to_numpy() > 0
            for block in blocks(batch.column(0)):
                rows, hashes = features(block, model)
                cues, at = np.unique(hashes, return_inverse=True)
                hits = np.bincount(at, toxic[block.first + rows], len(cues)).astype(np.int64)
                rest = np.bincount(at, minlength=len(cues)) - hits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cues.view(np.int64)), pa.array(hits), pa.array(rest.astype(np.int64))], ["cue", "toxic", "clean"]
                )

    return count


def _context_counter(trigrams, cues):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(trigrams.value)
        for batch in batches:
            toxic = (batch.column(1).to_numpy() > 0).astype(np.int64)
            for block in blocks(batch.column(0)):
                rows, hashes, beside = _all_occurrences(block, model)
                at, _ = _members(cues.value).find(hashes)
                columns = [hashes[at].view(np.int64), beside[at].view(np.int64), toxic[block.first + rows[at]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cue", "context", "toxic"])

    return count


def fit_curve(points: list[tuple[float, int, int]], ridge: float = 0.01) -> tuple[float, float]:
    """Intercept and slope of a logistic curve through (x, label, rows), by damped Newton steps.

    The penalised loss is convex and every step lowers it, so labels that x separates do no harm.
    """
    if not any(label for _, label, _ in points):
        return -30.0, 0.0
    x, y, n = (np.array(c, float) for c in zip(*points, strict=True))
    design = np.stack([np.ones_like(x), x], 1)

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.sum(n * (np.logaddexp(0, z) - y * z)) + ridge / 2 * w @ w)

    weights = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -500, 500)))
        slope = design.T @ (n * (p - y)) + ridge * weights
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step, now, part = np.linalg.solve(curve, slope), loss(weights), 1.0
        while part > 1e-9 and loss(weights - part * step) > now:
            part /= 2
        if part <= 1e-9 or np.abs(part * step).max() < 1e-9:
            break
        weights = weights - part * step
    return float(weights[0]), float(weights[1])
