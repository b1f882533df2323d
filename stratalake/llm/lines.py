"""Line dedup by a segment-partition edit join.

Lines are stripped of white space at both ends; those of at least ``MIN_CHARS`` code points take part.
Shorter ones, down to one, do if they are asked for: they are linked with equal lines only, and
``dedup_lines`` leaves them, as "}" or "Yes." mean what they stand in. Two lines are linked if they are equal
or ``EDITS`` edits (insertions, deletions, substitutions of code points) apart at most. A line's class is all it reaches by links, and
the first line of a class, by doc_id and line number, is kept.

The join of different lines: every line is cut into ``EDITS`` + 1 segments. If a line is within so
many edits of another, one of its segments stands unchanged in the other, and not further from its own
place than the edits on both sides allow, given both lengths. Those substrings are the only ones
probed, by (length, segment, substring). What shares a key is compared by three parity masks (counts
of letters, pairs and triples modulo 2: an edit changes 2, 4 or 6 bits at most), first by equal parts
of the first mask, of which one more than it can change bits has to be equal. Those that remain are verified by a
banded bit-parallel edit distance, whose steps are looked up: a band of 2 * ``EDITS`` + 1 rows has few states.
All filters are exact: no link is lost, and no group has a limit.

Lines of one form, as of a table or a template, are near each other by the thousand. A key of more than ``CROWD`` lines
emits no pairs: its lines are compared in blocks of ``BLOCK`` a side, in many tasks, and what leaves a block are
each line's number of links and a spanning forest of them. So that no link counts twice, it
counts for the least of the keys it is found by, and not at all in blocks if one of those is no crowd's.

Each line's keys leave a task once, however often the line occurs there. Lines of any length take part whole; memory follows the longest text. Null and empty texts have no
lines. A null id comes before all others. Rows with equal ids and texts are the same lines, and
keep the same ones. An empty table gives no rows. Extra columns are kept by
``dedup_lines``; of documents that lose lines it sets ``n_chars`` anew, if there is such a column.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.shared import free_name, lean, once, size_bounded, written
from stratalake.llm.words import Block, blocks, mix

EDITS = 2
MIN_CHARS = 30
#: Fewer rows are joined by broadcast, more by shuffle.
BROADCAST_ROWS = 300_000
#: Changed bits for each edit: of letters, of pairs, of triples.
FLIPS = (2, 4, 6)
#: Lines of a key that are joined pair by pair, and of a side of a block beyond that.
CROWD, BLOCK = 64, 512
#: Longer lines are verified one pair after the other, shorter ones many pairs at once, of so many characters in all.
LONG, AT_ONCE = 4096, 1 << 22
_ONE, _STEP = np.uint64(1), np.uint64(0xD6E8FEB86659FD93)


def code_points(block: Block) -> Block:
    """The block with code points in place of bytes."""
    data = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    begins = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    return Block(block.first, data, begins[block.offsets])


def find_lines(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line with a word, stripped; its text and its number there, from 0."""
    data, offsets = block.data, block.offsets
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts, ends, firsts = block.runs(~blank)
    rows = np.repeat(np.arange(block.rows), np.diff(firsts))
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    number = breaks[starts] - breaks[offsets[rows]]
    new = np.ones(len(starts), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (number[1:] != number[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts)) - 1
    return starts[at], ends[last] if len(at) else ends, rows[at], number[at]


def _segment(length: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment ``i``; the last ones are longer by one if need be."""
    part, extra = np.divmod(length, EDITS + 1)
    longer = np.maximum(0, i - (EDITS + 1 - extra))
    return i * part + longer, part + (i >= EDITS + 1 - extra)


def keys_of(hashed, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines x keys) hashes of each line's segments and probed substrings; a mask of those there are.

    The first ``EDITS`` + 1 are the segments, which are also probed by lines of the same length.
    """
    length = ends - starts
    keys, there = [], []
    for shorter in range(EDITS + 1):
        for i in range(EDITS + 1):
            begin, size = _segment(length - shorter, i)
            rest = EDITS - i
            for shift in range(max(-i, shorter - rest), min(i, shorter + rest) + 1):
                if shorter == 0 and shift == 0:
                    continue
                keys.append((length - shorter, i, begin + shift, size))
    keys = [(length, i, *_segment(length, i)) for i in range(EDITS + 1)] + keys
    made = np.zeros((len(starts), len(keys)), np.uint64)
    there = np.zeros(made.shape, bool)
    for k, (of, i, begin, size) in enumerate(keys):
        ok = (begin >= 0) & (begin + size <= length) & (of >= MIN_CHARS)
        there[:, k] = ok
        at = starts[ok] + begin[ok]
        tag = mix(of[ok].astype(np.uint64) * np.uint64(EDITS + 1) + np.uint64(i))
        made[ok, k] = mix(hashed(at, at + size[ok]) ^ tag)
    return made, there


def masks_of(block: Block, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """For each line, which of 64 kinds of letters, pairs and triples it has an odd number of."""
    grams = block.data.astype(np.uint64)
    made = []
    for n in (1, 2, 3):
        if n > 1:
            grams = grams[: len(grams) - 1] * _STEP + block.data[n - 1 :].astype(np.uint64)
        bits = _ONE << (mix(grams + np.uint64(n)) >> np.uint64(58))
        total = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bits)]) if len(bits) else np.zeros(1, np.uint64)
        made.append((total[ends - n + 1] ^ total[starts]).view(np.int64))
    return made


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("line_no", pa.int32()),
        ("line", pa.int64()),
        ("at", pa.int32()),
        ("length", pa.int32()),
        ("mask1", pa.int64()),
        ("mask2", pa.int64()),
        ("mask3", pa.int64()),
        ("segments", pa.list_(pa.int64())),
        ("probes", pa.list_(pa.int64())),
    ]
)
_LINES = (
    "doc_id long, text_hash long, line_no int, line long, at int, length int, mask1 long, mask2 long, mask3 long, "
    "segments array<long>, probes array<long>"
)


def _split(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The lines of a task's texts; segments, probes and masks of long lines, the former with the first of equal ones only."""
    seen = np.zeros(0, np.uint64)
    for batch in batches:
        for block in map(code_points, blocks(batch.column(2))):
            starts, ends, rows, number = find_lines(block)
            wanted = ends - starts >= least
            starts, ends, rows, number = starts[wanted], ends[wanted], rows[wanted], number[wanted]
            long = ends - starts >= MIN_CHARS
            hashed = block.hasher()
            line = hashed(starts, ends) ^ mix((ends - starts).astype(np.uint64))
            found, first = np.unique(line, return_index=True)
            at = np.minimum(np.searchsorted(seen, found), max(len(seen) - 1, 0))
            new = np.zeros(len(line), bool)
            new[first if not len(seen) else first[seen[at] != found]] = True
            seen = np.union1d(seen, found)
            new &= long
            keys, there = keys_of(hashed, starts[new], ends[new])
            own = block.first + rows
            columns = [batch.column(0).take(pa.array(own)), batch.column(1).take(pa.array(own))]
            columns += [pa.array(number, pa.int32()), pa.array(line.view(np.int64)), pa.array(starts - block.offsets[rows], pa.int32())]
            columns.append(pa.array(ends - starts, pa.int32()))
            for mask in masks_of(block, starts[long], ends[long]):
                every = np.zeros(len(line), np.int64)
                every[long] = mask
                columns.append(pa.array(every))
            for part in (slice(0, EDITS + 1), slice(EDITS + 1, None)):
                sizes = np.zeros(len(line), np.int32)
                sizes[new] = there[:, part].sum(1)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                values = keys[:, part][there[:, part]].view(np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """All lines of ``least`` code points, with what the join needs; written."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _split(batches, least)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    return written(rows.mapInArrow(lean(split), _LINES))


_KEYED = pa.schema([("key", pa.int64()), ("line", pa.int64()), ("probe", pa.bool_())])


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (key, line, probe) by key and line, those whose key has several lines, as a stream."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_arrays(batch.columns, schema=_KEYED)
        rows = rows if held is None else pa.concat_tables([held, rows])
        if not rows.num_rows:
            continue
        key, line = rows["key"].to_numpy(), rows["line"].to_numpy()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        ends = np.append(new[1:], len(key))
        several = line[ends - 1] != line[new]
        tail = int(new[-1])
        wanted = np.repeat(several, ends - new)
        if several[-1] and len(key) - tail > 2:  # what is held of it needs but two lines
            held = rows.take(pa.array([tail, len(key) - 1]))
            yield from rows.filter(pa.array(wanted)).to_batches()
            held = held.set_column(2, "probe", pa.array([None, None], pa.bool_()))
        else:
            held = rows.slice(tail)
            wanted[tail:] = False
            yield from rows.filter(pa.array(wanted)).to_batches()
    if held is not None:
        line = held["line"].to_numpy()
        if line[0] != line[-1]:
            yield from held.to_batches()


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(key, line, probe) of keys that several lines have; written."""
    rows = keyed.select(F.explode("segments").alias("key"), "line", F.lit(False).alias("probe")).union(
        keyed.select(F.explode("probes").alias("key"), "line", F.lit(True).alias("probe"))
    )
    rows = rows.repartition("key").sortWithinPartitions("key", "line")
    shared = rows.mapInArrow(lean(_shared_keys), "key long, line long, probe boolean").where("probe is not null")
    return written(shared.distinct())


def candidates(shared: DataFrame, keyed: DataFrame) -> DataFrame:
    """(a, b) of lines that share one of these keys and whose masks allow ``EDITS`` edits."""
    masks = keyed.select("line", "length", "mask1", "mask2", "mask3")
    wanted = size_bounded(written(shared.select("line").distinct()), BROADCAST_ROWS)
    masks = masks.join(wanted, "line", "left_semi").dropDuplicates(["line"])
    parts = FLIPS[0] * EDITS + 1
    width = -(-64 // parts)
    part = F.expr(f"shiftrightunsigned(mask1, int(part * {width})) & {(1 << width) - 1}L")
    rows = shared.join(masks, "line").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("value", part)
    mine = rows.where("not probe").select("key", "part", "value", *[F.col(c).alias(f"{c}_a") for c in _OF_LINE])
    other = rows.select("key", "part", "value", *[F.col(c).alias(f"{c}_b") for c in _OF_LINE])
    close = F.col("line_a") != F.col("line_b")
    for name, flips in zip(("mask1", "mask2", "mask3"), FLIPS, strict=True):
        close &= F.bit_count(F.col(f"{name}_a").bitwiseXOR(F.col(f"{name}_b"))) <= flips * EDITS
    same = [mine[c] == other[c] for c in ("key", "part", "value")]
    pairs = mine.join(other, [*same, close])
    return pairs.select(F.least("line_a", "line_b").alias("a"), F.greatest("line_a", "line_b").alias("b")).distinct()


_OF_LINE = ("line", "mask1", "mask2", "mask3")


class Band:
    """The banded bit-parallel edit distance as a machine that reads matches.

    Bit-vectors hold the differences +1 and -1 down a band of 2 * ``most`` + 1 rows that moves along the diagonal. A
    step depends on them and on which of the band's rows match the next character alone, so all
    steps there are can be listed: the following state, and whether the band's last row grew.
    """

    def __init__(self, most: int):
        self.most, self.bits = most, 2 * most + 1
        band = (1 << self.bits) - 1
        states, following, grown = {(band >> most << most, 0): 0}, [], []
        for up, down in states_of(states):
            for match in range(band + 1):
                zero = ((((match & up) + up) ^ up) | match | down) & band  # no difference along the diagonal
                right = (down | ~(zero | up)) & band
                left = zero & up
                state = ((left | ~(zero >> 1 | right)) & band, zero >> 1 & right)
                following.append(states.setdefault(state, len(states)))
                grown.append(not zero >> 2 * most)
        self.following, self.grown = np.array(following, np.int32), np.array(grown, np.int32)
        # from the band's last row up to the row that both lengths ask for
        ends = [[self._rise(up, down, apart) for apart in range(-most, most + 1)] for up, down in states]
        self.rise = np.array(ends, np.int32)

    def _rise(self, up: int, down: int, apart: int) -> int:
        rows = (1 << 2 * self.most) - (1 << apart + self.most)
        return (up & rows).bit_count() - (down & rows).bit_count()

    def of_long(self, a: np.ndarray, b: np.ndarray) -> int:
        """The distance of two lines of code points whose lengths are no further apart than it may be."""
        none = np.full(self.most, _NONE, np.uint32)
        padded = np.concatenate([none, a, none, none])
        codes = np.zeros(len(b), np.uint8)
        for i in range(self.bits):
            own = padded[i : i + len(b)]
            codes[: len(own)] |= (own == b[: len(own)]).astype(np.uint8) << np.uint8(i)
        following, grown = self.following.tolist(), self.grown.tolist()
        state, distance, bits = 0, self.most, self.bits
        for code in codes.tobytes():
            step = state << bits | code
            distance += grown[step]
            state = following[step]
        return distance - int(self.rise[state, len(a) - len(b) + self.most])

    def within(self, points: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs of lines, by their numbers, are no more than ``most`` edits apart."""
        lengths = np.array([len(p) for p in points], np.int64)
        made = np.zeros(len(x), bool)
        order = np.flatnonzero(np.abs(lengths[x] - lengths[y]) <= self.most)
        order = order[np.argsort(lengths[y[order]], kind="stable")]
        short = int(np.searchsorted(lengths[y[order]], LONG, "right"))
        first = 0
        while first < short:
            last = min(short, first + max(1, AT_ONCE // LONG))
            last = min(short, first + max(1, AT_ONCE // max(1, int(lengths[y[order[last - 1]]]))))
            part = order[first:last]
            made[part] = self._distances(points, lengths, x[part], y[part]) <= self.most
            first = last
        for k in order[short:].tolist():
            made[k] = _distance(points[x[k]], points[y[k]], self) <= self.most
        return made

    def _distances(self, points: list[np.ndarray], lengths: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The distances of pairs that are sorted by the length of the second line."""
        used, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        left, right = at[: len(x)], at[len(x) :]
        size = int(lengths[used].max())
        # one row for each place, so that a place of all pairs is taken at once
        own = np.full((size + 3 * self.most, len(used)), _NONE, np.uint32)
        for k, line in enumerate(used.tolist()):
            own[self.most : self.most + lengths[line], k] = points[line]
        ends = lengths[y]
        state, distance = np.zeros(len(x), np.int32), np.full(len(x), self.most, np.int32)
        band = [own[i][left] for i in range(self.bits - 1)]
        for c in range(int(ends[-1])):
            band.append(own[c + self.bits - 1][left])
            active = int(np.searchsorted(ends, c, "right"))
            sign = own[c + self.most][right[active:]]
            code = np.zeros(len(sign), np.int32)
            for i, row in enumerate(band):
                code |= (row[active:] == sign).astype(np.int32) << i
            step = state[active:] << self.bits | code
            distance[active:] += self.grown[step]
            state[active:] = self.following[step]
            band.pop(0)
        return distance - self.rise[state, lengths[x] - ends + self.most]


def states_of(states: dict) -> Iterator[tuple[int, int]]:
    """All states, those that are found meanwhile too."""
    done = 0
    while done < len(states):
        for state in list(states)[done:]:
            done += 1
            yield state


_NONE = np.uint32(0xFFFFFFFF)


@cache
def _band(most: int) -> Band:
    return Band(most)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _distance(a: np.ndarray, b: np.ndarray, band: Band) -> int:
    """The distance if the band holds it, else a larger number; common ends cost nothing."""
    if abs(len(a) - len(b)) > band.most:
        return band.most + 1
    for _ in range(2):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        begin = int(differ[0]) if len(differ) else n
        a, b = a[begin:][::-1], b[begin:][::-1]
    return band.of_long(a, b)


def edit_distance(a: str, b: str, most: int) -> int:
    """The edit distance if it is ``most`` or less, else a larger number."""
    return _distance(_points(a), _points(b), _band(most))


def _within(a: Column, b: Column) -> Column:
    def of(left: pa.Array, right: pa.Array) -> pa.Array:
        points = [_points(text) for texts in (left, right) for text in texts.to_pylist()]
        every = np.arange(len(left))
        return pa.array(_band(EDITS).within(points, every, every + len(left)))

    return F.arrow_udf(lean(of), "boolean")(a, b)


def links(docs: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a, b) that connect all lines which links connect, and (line, n_links) of lines with links; written."""
    keyed = found.where("size(segments) > 0")
    shared = shared_keys(keyed)
    crowds = shared.groupBy("key").agg(F.count_distinct("line").alias("n"), F.min("probe").alias("only_probes"))
    crowds = written(crowds.where((F.col("n") > CROWD) & ~F.col("only_probes")).drop("only_probes"))
    some = crowds.limit(1).count() > 0
    crowds = size_bounded(crowds, BROADCAST_ROWS)
    few = shared.join(crowds, "key", "left_anti") if some else shared
    pairs = written(candidates(few, keyed))
    wanted = pairs.select(F.col("a").alias("line")).union(pairs.select("b"))
    crowded = written(shared.join(crowds, "key").select("key", "line", "n").distinct()) if some else None
    wanted = (wanted.union(crowded.select("line")) if some else wanted).distinct()
    wanted = size_bounded(written(wanted), BROADCAST_ROWS)
    place = F.min(F.struct("doc_id", "text_hash", "at", "length")).alias("place")
    places = found.join(wanted, "line", "left_semi").groupBy("line").agg(place).select("line", "place.*")
    places = size_bounded(written(places), BROADCAST_ROWS)
    docs = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    same = docs["_id"].eqNullSafe(places["doc_id"]) & (docs["_hash"] == places["text_hash"])
    texts = docs.join(places, same).select("line", F.expr("substring(text, at + 1, length)").alias("content"))
    texts = written(texts.dropDuplicates(["line"]))
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("line").alias(side), F.col("content").alias(f"of_{side}")), side)
    near = written(pairs.where(_within(F.col("of_a"), F.col("of_b"))).select("a", "b"))
    counts = near.select(F.col("a").alias("line"), F.lit(1).alias("n")).union(near.select("b", F.lit(1)))
    if some:
        blocks_ = _crowd_links(crowded, crowds, keyed, texts)
        near = near.union(blocks_.where("b is not null").select("a", "b")).distinct()
        counts = counts.union(blocks_.where("b is null").select("a", "n"))
    return near, counts.groupBy("line").agg(F.sum("n").alias("n_links"))


def _crowd_links(crowded: DataFrame, crowds: DataFrame, keyed: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, n) of lines that share crowds' keys: links that connect, or a line's number of them with a null b; written."""
    own = size_bounded(written(crowded.select("line").distinct()), BROADCAST_ROWS)
    of_line = keyed.join(own, "line", "left_semi").dropDuplicates(["line"])
    of_line = of_line.select("line", "mask1", "mask2", "mask3", "segments", "probes")
    of_line = written(of_line.join(texts, "line"))
    keys = of_line.select("line", F.explode(F.concat("segments", "probes")).alias("key")).join(crowds, "key")
    keys = keys.groupBy("line").agg(F.collect_set("key").alias("crowds"))
    of_line = written(of_line.join(keys, "line"))
    n = F.ceil(F.col("n") / BLOCK).cast("long")
    rows = crowded.withColumn("own", F.pmod(F.xxhash64("line"), n))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    sides = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second")]
    rows = rows.select("key", "line", *sides).join(of_line, "line")
    return written(rows.groupBy("key", "i", "j").applyInArrow(_compare, "a long, b long, n long"))


def _padded(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of so many numbers; 0, which no key is, where a list has fewer."""
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(sizes), width), np.int64)
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return made


def _compare(table: pa.Table) -> pa.Table:
    """Links of a block's two sides, or within it: those that count for its key by line, and a spanning forest of all."""
    table = table.combine_chunks()
    second = table["second"].to_numpy(zero_copy_only=False)
    left, right = np.flatnonzero(~second), np.flatnonzero(second)
    inside = not len(right) and table["i"][0] == table["j"][0]
    right = left if inside else right
    near = np.triu(np.ones((len(left), len(right)), bool), 1) if inside else np.ones((len(left), len(right)), bool)
    for name, flips in zip(("mask1", "mask2", "mask3"), FLIPS, strict=True):
        mask = table[name].to_numpy().view(np.uint64)
        near &= np.bitwise_count(mask[left][:, None] ^ mask[right][None, :]) <= flips * EDITS
    x, y = (side[i] for side, i in zip((left, right), np.nonzero(near), strict=True))
    same = _band(EDITS).within([_points(t) for t in table["content"].to_pylist()], x, y)
    x, y = x[same], y[same]
    count = _counts_here(table, x, y)
    number = np.bincount(x[count], minlength=len(second)) + np.bincount(y[count], minlength=len(second))
    line = table["line"].to_numpy()
    forest = _forest(x, y, len(second))
    counted = np.flatnonzero(number)
    return pa.table(
        {
            "a": pa.array(np.concatenate([line[counted], line[forest[:, 0]]])),
            "b": pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(line[forest[:, 1]])]),
            "n": pa.array(np.concatenate([number[counted], np.zeros(len(forest), np.int64)])),
        }
    )


def _counts_here(table: pa.Table, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which links count for this key: it is the least they are found by, and all of those are crowds'.

    They are found by segments of one line that the other has as a segment or probes, not by what both probe.
    """
    segments, probes = _padded(table["segments"].chunk(0), EDITS + 1), table["probes"].chunk(0)
    probes = _padded(probes, max(1, int(np.diff(probes.offsets.to_numpy()).max(initial=0))))
    crowds = np.unique(table["crowds"].chunk(0).flatten().to_numpy())
    key = table["key"][0].as_py()
    here, before = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for one, two, mine, others in ((x, y, segments, (segments, probes)), (y, x, segments, (probes,))):
        for own in (mine[one, i] for i in range(mine.shape[1])):
            found = np.zeros(len(x), bool)
            for other in others:
                for k in range(other.shape[1]):
                    found |= own == other[two, k]
            here |= found & (own == key)
            before |= found & ((own < key) | ~np.isin(own, crowds))
    return here & ~before


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Pairs that connect what links x - y connect, n - 1 at most."""
    linked = np.zeros((n, n), bool)
    linked[x, y] = linked[y, x] = True
    waiting = linked.any(1)
    made = [np.zeros((0, 2), np.int64)]
    for root in np.flatnonzero(waiting).tolist():
        if not waiting[root]:
            continue
        waiting[root], open_ = False, [root]
        while open_:
            node = open_.pop()
            new = np.flatnonzero(linked[node] & waiting)
            waiting[new] = False
            made.append(np.stack([np.full(len(new), node), new], 1))
            open_ += new.tolist()
    return np.concatenate(made)


def line_classes(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """One row per line of ``least`` code points: doc_id, line_no, its class and whether it is kept; written.

    ``class_doc`` and ``class_line`` name the first line of the class; ``n_links`` is how many different
    lines are linked with this one, and ``n_copies`` how many lines its class has.
    """
    found = lines(docs, least)
    near, linked = links(docs, found)
    linked = linked.join(components(near).withColumnRenamed("node", "line"), "line", "left")
    linked = size_bounded(written(linked), BROADCAST_ROWS)
    rows = found.select("doc_id", "text_hash", "line_no", "line").join(linked, "line", "left")
    rows = rows.select(
        "doc_id", "text_hash", "line_no", F.coalesce("component", "line").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    first = F.min(F.struct("doc_id", "line_no", "text_hash")).alias("first")
    several = rows.groupBy("class").agg(first, F.count("*").alias("n_copies")).where("n_copies > 1")
    several = size_bounded(written(several), BROADCAST_ROWS)
    rows = rows.join(several, "class", "left")
    own = F.struct("doc_id", "line_no", "text_hash")
    first = F.coalesce("first", own)
    return written(
        rows.select(
            "doc_id",
            "line_no",
            "text_hash",
            first["doc_id"].alias("class_doc"),
            first["line_no"].alias("class_line"),
            "n_links",
            F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
            first.eqNullSafe(own).alias("kept"),
        )
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that aren't kept; those that lose all their words are left out."""
    doc_id, text_hash, numbers = (free_name(docs, n) for n in ("lines_id", "lines_hash", "lines_dropped"))
    dropped = line_classes(docs).where("not kept").groupBy(F.col("doc_id").alias(doc_id), F.col("text_hash").alias(text_hash))
    dropped = dropped.agg(F.collect_set("line_no").alias(numbers))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(text_hash))
    whole = F.col(numbers).isNull()
    changed = _without(F.when(~whole, F.col("text")), F.col(numbers))  # whole texts don't leave the JVM
    rest = docs.join(dropped, same, "left").withColumn("text", F.when(whole, F.col("text")).otherwise(changed))
    rest = rest.where(whole | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        rest = rest.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(length))
    return rest.select(*[f"`{c}`" for c in docs.columns])


def _without(text: Column, numbers: Column) -> Column:
    def of(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        made = []
        for text, numbers in zip(texts, dropped, strict=True):
            gone = set(numbers.as_py() or ())
            rest = None
            if text.is_valid:
                rest = "\n".join(x for i, x in enumerate(text.as_py().split("\n")) if i not in gone)
            made.append(rest)
        return pa.array(made, pa.string())

    return once(F.arrow_udf(lean(of), "string"))(text, numbers)
