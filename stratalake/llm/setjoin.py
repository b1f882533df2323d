"""Jaccard join of documents' shingle sets by set-relation skipping.

Documents are linked whose sets have ``SIMILAR_PERCENT`` of their union in common. Equal sets are one
set from the start, known by a 64-bit hash. Shingles have one order for all sets: by how many sets have them, rare ones
first. Those counts are taken over all documents in ``BUCKETS`` buckets of hashes and broadcast as one byte a bucket, a
fixed size; the order decides what is fast, not what is found. Two linked sets share a shingle in their first
parts, the first size - ceil(0.8 size) + 1 shingles, which are indexed.

Skipping within the index: a shingle's list is in blocks by set size and position of the shingle in the
set. Two entries can only belong to linked sets if what is left from their positions on reaches the overlap
that both sizes ask for, so for each pair of sizes all blocks from some position on are skipped, and
sizes that are too far apart are never compared. Entries that no other block can match are dropped,
lists of one entry with them. Lists that hold the same sets are one list.

Skipping between sets: each list has a leader, the set that meets most others in lists. Every set
is compared in full with the leader of its longest list, then with leaders of its other lists that are not in its
component by that; a bit for each of some hash buckets bounds what two sets have in common, and spares most of those that aren't linked. Those bits
also say which sets of a list may be linked with one of another component: sets that only share a passage mostly go by that, before any of
their shingles are moved. Lists of the same leader, which mostly hold the same sets, are one for that. What is then still apart in a list is compared as differences from the leader, which are short for similar sets: with leader L, and M and
E what L has more and less than a set,

    common(X, Y) = size(L) - size(MX) - size(MY) + common(MX, MY) + common(EX, EY),

so answers follow from those of the leader, exactly. Only sets outside a list's largest component are
compared with its others, in blocks of ``BLOCK`` a side, and a spanning forest of the links between components comes
out: what leaves a list grows with its sets, not with its pairs, and a long list is the work of many tasks.

A word is a longest run without white space, A-Z in lower case; a document's set are its distinct shingles
of ``SHINGLE`` words, or its whole sequence if it has fewer. Null texts and those without words have an empty set
and are linked with nothing. Texts are read whole; memory follows the longest one. Rows are documents of their
own, also with equal ids. A null id is left out when the smallest is taken, so it stays null if a component has no other. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.minhash import shingle_sets, shingles
from stratalake.llm.shared import drop_written, lean, once, size_bounded, written
from stratalake.llm.words import blocks, mix

SHINGLE = 5
SIMILAR_PERCENT = 80
#: Buckets in which sets are counted by shingle, and so many of them to a row on their way.
BUCKETS, RANGE = 1 << 21, 1 << 14
#: Sets of a side of a block.
BLOCK = 512
#: Sets that are compared with a leader in one task.
CHUNK = 1024
#: A list with more entries leaves the index as it is, without being held.
HELD = 1 << 16
#: More rows than this are joined by shuffle, fewer by broadcast (16 bytes each).
BROADCAST_ROWS = 500_000
#: A filter of documents has so many bits for each wanted one, and so many at most.
FILTER_BITS, FILTER_MOST = 16, 1 << 26
#: Lists of so many entries are compared entry by entry, longer ones block by block.
_SHORT = 16
_MARK = np.uint64(0x2545F4914F6CDD1D)
_COLUMNS = 2048


def least_overlap(one, two):
    """How much sets of these sizes must have in common, as numbers or arrays."""
    return -(-SIMILAR_PERCENT * (one + two) // (100 + SIMILAR_PERCENT))


def prefix(sizes: np.ndarray) -> np.ndarray:
    """How many of a set's first shingles a linked set can't all lack."""
    return np.where(sizes > 0, sizes + SIMILAR_PERCENT * -sizes // 100 + 1, 0)


def _node_ids(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A hash of each whole set."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found + _MARK), dtype=np.uint64)])
    return mix((total[offsets[1:]] - total[offsets[:-1]]) ^ mix(np.diff(offsets).astype(np.uint64)))


def _bucket(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


class _Seen:
    """Which sets a task has met."""

    def __init__(self) -> None:
        self.known = np.zeros(0, np.uint64)

    def new(self, nodes: np.ndarray) -> np.ndarray:
        """A mask of the first of each set that was not met before."""
        found, first = np.unique(nodes, return_index=True)
        first = first[~np.isin(found, self.known, assume_unique=True)]
        self.known = np.union1d(self.known, found)
        made = np.zeros(len(nodes), bool)
        made[first] = True
        return made


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest takes, byte by byte, compressed."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << 8 * w)
    planes = counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(pa.decompress(packed[1:], RANGE * width, "zstd"), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


_ROWS = "doc_id long, text_hash long, size long, node long, range int, counts binary"
_ROW_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("size", pa.int64()),
        ("node", pa.int64()),
        ("range", pa.int32()),
        ("counts", pa.binary()),
    ]
)


def _read(docs: DataFrame, words: int) -> DataFrame:
    """Each document's set size and set; beside them (range, counts) of each task; written."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = _Seen(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            sizes, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for block in blocks(batch.column(2)):
                found, offsets = shingles(block, words)
                sizes.append(np.diff(offsets))
                nodes.append(_node_ids(found, offsets))
                counted = np.repeat(seen.new(nodes[-1]), sizes[-1])
                np.add.at(total, _bucket(found[counted]), 1)
            none = pa.nulls(len(batch))
            columns = [*batch.columns[:2], pa.array(np.concatenate(sizes)), pa.array(np.concatenate(nodes).view(np.int64))]
            yield pa.RecordBatch.from_arrays([*columns, none.cast(pa.int32()), none.cast(pa.binary())], schema=_ROW_SCHEMA)
        parts = np.minimum(total, 65535).reshape(-1, RANGE)
        at = np.flatnonzero(parts.any(1))
        empty = pa.nulls(len(at), pa.int64())
        counts = pa.array([_packed(part) for part in parts[at]], pa.binary())
        yield pa.RecordBatch.from_arrays([empty] * 4 + [pa.array(at, pa.int32()), counts], schema=_ROW_SCHEMA)

    return written(docs.mapInArrow(lean(read), _ROWS))


def _order(rows: DataFrame) -> np.ndarray:
    """One byte for each bucket, which grows with the logarithm of its count; 0 for a bucket of one set at most."""

    def summed(table: pa.Table) -> pa.Table:
        total = sum(_unpacked(x.as_py()) for x in table["counts"])
        return pa.table({"range": table["range"][:1], "counts": pa.array([_packed(total)], pa.binary())})

    kind = "range int, counts binary"
    # in two steps, so that groups grow with the root of the number of tasks
    parts = rows.where("range is not null").select("range", "counts")
    groups = math.isqrt(parts.count() * RANGE // BUCKETS) + 1
    parts = parts.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(groups)))
    parts = parts.groupBy("range", "part").applyInArrow(summed, kind).groupBy("range").applyInArrow(summed, kind)
    made = np.zeros(BUCKETS, np.int64)
    for row in parts.collect():
        made[row["range"] * RANGE : (row["range"] + 1) * RANGE] = _unpacked(bytes(row["counts"]))
    return np.minimum(np.ceil(4 * np.log2(np.maximum(made, 1))), 255).astype(np.uint8)


_ENTRIES = pa.schema([("token", pa.int64()), ("place", pa.int64()), ("node", pa.int64())])


def _entries(docs: DataFrame, order: np.ndarray, words: int) -> DataFrame:
    """(token, place, node): the first shingles of every set, once for each task; a place is a set's size, then a position."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for block in blocks(batch.column(2)):
                found, offsets = shingles(block, words)
                nodes, sizes = _node_ids(found, offsets), np.diff(offsets)
                own = np.flatnonzero(seen.new(nodes) & (sizes > 0))
                wanted = np.zeros(len(sizes), bool)
                wanted[own] = True
                found = found[np.repeat(wanted, sizes)]
                sizes, nodes = sizes[own], nodes[own]
                rows, rank = np.repeat(np.arange(len(own)), sizes), shared.value[_bucket(found)]
                by = np.lexsort((found, rank, rows))
                found, rank = found[by], rank[by]
                at = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                # a bucket of one set has no shingle that two sets share
                first = np.flatnonzero((at < np.repeat(prefix(sizes), sizes)) & (rank > 0))
                places = (np.repeat(sizes, sizes)[first] << 32) | at[first]
                columns = [found[first].view(np.int64), places, np.repeat(nodes, sizes)[first].view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ENTRIES)

    return docs.mapInArrow(lean(entries), "token long, place long, node long")


def _matched(size: np.ndarray, at: np.ndarray, node: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mask of the entries that another one of their list can match; lists are sorted by size and position."""
    made = np.zeros(len(size), bool)
    left = size - at
    lengths = ends - begins
    list_of = np.repeat(np.arange(len(begins)), lengths)
    short = np.repeat(lengths <= _SHORT, lengths)
    for k in range(1, min(_SHORT, int(lengths.max(initial=0)))):
        a = np.flatnonzero(short[:-k] & (list_of[k:] == list_of[:-k]))
        b = a + k
        near = (100 * size[a] >= SIMILAR_PERCENT * size[b]) & (node[a] != node[b])
        near &= np.minimum(left[a], left[b]) >= least_overlap(size[a], size[b])
        made[a[near]] = True
        made[b[near]] = True
    for i in np.flatnonzero(lengths > _SHORT):
        begin, end = int(begins[i]), int(ends[i])
        sizes, first = np.unique(size[begin:end], return_index=True)
        edges = np.append(first, end - begin) + begin
        for x in range(len(sizes)):
            last = int(np.searchsorted(sizes, 100 * sizes[x] // SIMILAR_PERCENT, "right"))
            for y in range(x, last):
                need = least_overlap(sizes[x], sizes[y])
                # positions rise within a size, so the rest of its blocks is skipped at once
                to_x = edges[x] + np.searchsorted(-left[edges[x] : edges[x + 1]], -need, "right")
                to_y = edges[y] + np.searchsorted(-left[edges[y] : edges[y + 1]], -need, "right")
                if to_x > edges[x] and to_y > edges[y] and (x != y or node[edges[x]] != node[to_x - 1]):
                    made[edges[x] : to_x] = True
                    made[edges[y] : to_y] = True
    return made


_MEMBERS = pa.schema([("list", pa.int64()), ("node", pa.int64())])


def _lists_of(rows: pa.Table) -> pa.RecordBatch:
    """(list, node) of whole lists, by what entries can match; equal lists once."""
    token, place, node = (rows[name].to_numpy() for name in ("token", "place", "node"))
    size, at = place >> 32, place & 0xFFFFFFFF
    begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    kept = np.flatnonzero(_matched(size, at, node, begins, np.append(begins[1:], len(token))))
    if not len(kept):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, schema=_MEMBERS)
    token, node = token[kept], node[kept]
    by = np.lexsort((node, token))
    token, node = token[by], node[by]
    once = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
    token, node = token[once], node[once]
    begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    lengths = np.diff(np.append(begins, len(token)))
    name = mix(np.add.reduceat(mix(node.view(np.uint64)), begins) ^ lengths.astype(np.uint64))
    _, first = np.unique(name, return_index=True)
    wanted = np.zeros(len(begins), bool)
    wanted[first] = True
    wanted &= lengths > 1
    rows_of = np.repeat(wanted, lengths)
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(name, lengths)[rows_of].view(np.int64)), pa.array(node[rows_of])], schema=_MEMBERS)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, node) of entries by token, place and set."""
    held: pa.Table | None = None
    passing = None  # the token of a list that is too long to be held
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if passing is not None:
            token = rows["token"].to_numpy()
            n = int(np.argmax(token != passing)) if (token != passing).any() else len(token)
            yield _passed(rows.slice(0, n))
            rows = rows.slice(n)
            passing = passing if not rows.num_rows else None
        if not rows.num_rows:
            continue
        rows = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        token = rows["token"].to_numpy()
        tail = int(np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))[-1])
        if tail:
            yield _lists_of(rows.slice(0, tail))
        held = rows.slice(tail)
        if held.num_rows > HELD:
            passing, held = token[tail], None
            yield _passed(rows.slice(tail))
    if held is not None:
        yield _lists_of(held)


def _passed(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    name = mix(rows["token"].to_numpy().view(np.uint64) + _MARK).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(rows["node"].to_numpy())], schema=_MEMBERS)


def _members(docs: DataFrame, order: np.ndarray, words: int) -> DataFrame:
    """(list, node, members, leader) of all lists; written."""
    entries = _entries(docs, order, words).repartition("token").sortWithinPartitions("token", "place", "node")
    members = written(entries.mapInArrow(lean(_lists), "list long, node long").distinct())
    sizes = written(members.groupBy("list").agg(F.count("*").alias("members")).where("members > 1"))
    sized = written(members.join(sizes, "list"))
    met = sized.groupBy("node").agg(F.sum("members").alias("met"))
    leaders = sized.join(met, "node").groupBy("list").agg(F.max_by("node", F.struct("met", -F.col("node"))).alias("leader"))
    led = written(sized.join(leaders, "list"))
    for old in (members, sizes, sized):
        drop_written(old)
    return led


def _places(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(node, doc_id, text_hash) of one document for each set in lists; written."""
    places = rows.where("size > 0").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("place"))
    return written(places.join(members.select("node").distinct(), "node").select("node", "place.*"))


def _wanted(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(_id, _hash, text) of all documents in ``places``, and few others.

    A bit for each hash of an id and a text is what all tasks get, so that other texts aren't moved, however many places there are.
    """
    bits = 64
    while bits < min(FILTER_BITS * places.count(), FILTER_MOST):
        bits *= 2
    at = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(bits))
    words = places.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word"))
    words = words.agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toArrow()
    made = np.zeros(bits // 64, np.int64)
    made[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(made)

    def of(places: pa.Array) -> pa.Array:
        at = places.to_numpy()
        return pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool))

    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "text")
    return texts.where(once(F.arrow_udf(lean(of), "boolean"))(F.pmod(F.xxhash64("_id", "_hash"), F.lit(bits))))


def _placed(texts: DataFrame, places: DataFrame) -> DataFrame:
    same = texts["_id"].eqNullSafe(places["doc_id"]) & (texts["_hash"] == places["text_hash"])
    return texts.join(size_bounded(places, BROADCAST_ROWS), same).drop("_id", "_hash", "doc_id", "text_hash")


def _known(docs: DataFrame, places: DataFrame, words: int) -> DataFrame:
    """(node, size, bits) of all sets in lists; written."""
    found = _wanted(docs, places).select("_id", "_hash", shingle_sets(F.col("text"), words).alias("shingles"))
    found = found.select("_id", "_hash", F.size("shingles").cast("long").alias("size"), _bits(F.col("shingles")).alias("bits"))
    return written(_placed(found, places).dropDuplicates(["node"]))


def _sets(docs: DataFrame, places: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of these sets, each from one document; written.

    Repeated rows of a document give its set once for each task.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            new = pa.array(seen.new(batch.column("node").to_numpy().view(np.uint64)))
            yield batch.filter(new)

    places = written(places.join(nodes.select("node").distinct(), "node"))
    chosen = _placed(_wanted(docs, places), places).select("node", "text").mapInArrow(lean(sets), "node long, text string")
    return written(chosen.select("node", shingle_sets(F.col("text"), words).alias("shingles")))


def _bits(sets: Column) -> Column:
    """Which of at least twice as many hash buckets as a set is large it has something in, as words of 64 bits."""

    def of(lists: pa.Array) -> pa.Array:
        made = []
        for own in lists:
            found = own.values.to_numpy().view(np.uint64)
            words = 1 << max(0, (2 * len(found) - 1).bit_length() - 6)
            bits = np.zeros(64 * words, bool)
            bits[(found % np.uint64(64 * words)).astype(np.int64)] = True
            made.append(np.packbits(bits).view(np.int64))
        return pa.array(made, pa.list_(pa.int64()))

    return F.arrow_udf(lean(of), "array<bigint>")(sets)


def _may_link(one: tuple[Column, Column], two: tuple[Column, Column]) -> Column:
    """Whether sets, by (size, bits), can be linked: what only one has in a bucket is not common."""

    def folded(own: Column, other: Column) -> Column:
        half = F.size(other)
        halves = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseOR(y))
        return F.when(F.size(own) == 2 * half, halves).otherwise(own)

    def most(own: tuple[Column, Column], other: tuple[Column, Column]) -> Column:
        mine, its = folded(own[1], other[1]), folded(other[1], own[1])
        alone = F.zip_with(mine, its, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        missing = F.aggregate(alone, F.lit(0), lambda total, n: total + n)
        return own[0] - F.when(F.size(mine) == F.size(its), missing).otherwise(0)

    common = F.least(most(one, two), most(two, one))
    return 100 * common >= SIMILAR_PERCENT * (one[0] + two[0] - common)


def _with_leader(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (node, leader) with both sets, ``own`` and ``led``; the sets of a leader of many go to several tasks."""
    counts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    counts = size_bounded(written(counts), BROADCAST_ROWS)
    many = size_bounded(counts.where("chunks > 1"), BROADCAST_ROWS)
    own = sets.select("node", F.col("shingles").alias("own")).join(size_bounded(pairs, BROADCAST_ROWS), "node")
    chunk = F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1).cast("long")))
    own = own.join(many, "leader", "left").withColumn("chunk", chunk).drop("chunks")
    leaders = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("led")).join(counts, "leader")
    leaders = leaders.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    return own.join(leaders.hint("merge"), ["leader", "chunk"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of these pairs (node, leader) whose sets are linked; written."""
    both = F.size(F.array_intersect("own", "led"))
    union = F.size("own") + F.size("led") - both
    found = _with_leader(sets, pairs).where(100 * both >= SIMILAR_PERCENT * union)
    return written(found.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())


def _led(members: DataFrame, known: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) by links with leaders: first of each set with the leader of its longest list, then with
    leaders that are not in its component by that; written. Pairs whose sizes or bits bound them below a link go before."""
    pairs = members.where("node <> leader").groupBy("node", "leader").agg(F.max("members").alias("members"))
    pairs = pairs.join(known, "node")
    pairs = pairs.join(known.select(F.col("node").alias("leader"), F.col("size").alias("led"), F.col("bits").alias("of_led")), "leader")
    fits = 100 * F.least("size", "led") >= SIMILAR_PERCENT * F.greatest("size", "led")
    fits &= _may_link((F.col("size"), F.col("bits")), (F.col("led"), F.col("of_led")))
    pairs = written(pairs.where(fits).select("node", "leader", "members"))
    sets = sets_of(pairs.select("node").union(pairs.select("leader")))
    best = pairs.groupBy("node").agg(F.max_by("leader", F.struct("members", "leader")).alias("leader"))
    first = _linked(written(best), sets)
    near = components(first)
    rest = pairs.select("node", "leader")
    for side in ("node", "leader"):
        rest = rest.join(near.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}")), side, "left")
    apart = F.coalesce("of_node", "node") != F.coalesce("of_leader", "leader")
    second = _linked(written(rest.where(apart).select("node", "leader")), sets)
    drop_written(sets)
    return components(first.union(second))


def _sides(rows: DataFrame) -> DataFrame:
    """Blocks (list, i, j) of what a list has outside its largest component, ``left``, and of all it has."""
    counts = rows.groupBy("list").agg(F.count_if("other").alias("others"), F.count("*").alias("members"))
    rows = rows.join(size_bounded(written(counts), BROADCAST_ROWS), "list")
    hashed = F.xxhash64("node")
    n_left, n_right = (F.ceil(F.col(c) / BLOCK).cast("long") for c in ("others", "members"))
    left = rows.where("other").withColumn("i", F.pmod(hashed, n_left)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), n_right - 1)))
    right = rows.where("others > 0").withColumn("j", F.pmod(hashed, n_right))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), n_left - 1)))
    columns = ["list", "i", "j", "component", "node", "leader"]
    return left.select(*columns, F.lit(True).alias("left")).union(right.select(*columns, F.lit(False).alias("left")))


def _merged(placed: DataFrame) -> DataFrame:
    """Rows (list, node, leader, component) with lists of the same leader as one, where that makes no list much longer.

    Such lists mostly hold what a passage is in, each for another of its shingles, so that a set is in many of them.
    """
    once_each = placed.groupBy("leader", "node").agg(F.max("members").alias("longest"))
    by = once_each.groupBy("leader").agg(F.count("*").alias("n"), F.max("longest").alias("longest"))
    by = written(by.select("leader", (F.col("n") <= F.greatest(F.lit(BLOCK), 2 * F.col("longest"))).alias("one")))
    merged = placed.join(size_bounded(by, BROADCAST_ROWS), "leader")
    merged = merged.withColumn("list", F.when(F.col("one"), F.col("leader")).otherwise(F.col("list")))
    return written(merged.select("list", "node", "leader", "component").distinct())


def _rest_links(members: DataFrame, near: DataFrame, known: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links between components that meet in a list, as links of components; written."""
    placed = members.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = _merged(written(placed.where("members > 2")))
    parts = placed.groupBy("list", "component").agg(F.count("*").alias("n"))
    open_ = parts.groupBy("list").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    open_ = size_bounded(written(open_.where("most < all").select("list", "main")), BROADCAST_ROWS)
    rows = written(placed.join(open_, "list").withColumn("other", F.col("component") != F.col("main")))
    rows = rows.select("list", "component", "node", "leader", "other")
    may = _sides(rows).join(known, "node").groupBy("list", "i", "j").applyInArrow(_may_meet, "list long, node long").distinct()
    rows = written(rows.join(written(may), ["list", "node"]))
    missing, extra = F.array_except("led", "own"), F.array_except("own", "led")
    sets = sets_of(rows.select("node").union(rows.select("leader")))
    pairs = written(rows.where("node <> leader").select("node", "leader").distinct())
    apart = _with_leader(sets, pairs).select(
        "node", "leader", F.size("own").alias("size"), F.size("led").alias("led"), F.size(missing).alias("missing"), F.concat(missing, extra).alias("apart")
    )
    led = size_bounded(written(rows.select(F.col("leader").alias("node")).distinct()), BROADCAST_ROWS)
    size = F.size("shingles")
    selves = sets.join(led, "node", "left_semi").select(
        "node", F.col("node").alias("leader"), size.alias("size"), size.alias("led"), F.lit(0).alias("missing"), F.slice("shingles", 1, 0).alias("apart")
    )
    apart = apart.union(selves)
    if sets.count() > sets.select("node").distinct().count():  # repeated rows gave a set more than once
        apart = apart.dropDuplicates(["node", "leader"])
    apart = written(apart)
    found = _sides(rows).join(apart, ["node", "leader"]).groupBy("list", "i", "j").applyInArrow(_compare, "a long, b long")
    found = written(found.distinct())
    for old in (sets, apart):
        drop_written(old)
    return found


def may_link(size: np.ndarray, bits: np.ndarray, one_size: int, one_bits: np.ndarray) -> np.ndarray:
    """Which sets, rows of bits as wide as those of one set, can be linked with that, by the same bound as between columns."""
    both = np.bitwise_count(bits & one_bits).sum(1, dtype=np.int64)
    alone, one_alone = np.bitwise_count(bits).sum(1, dtype=np.int64) - both, int(np.bitwise_count(one_bits).sum(dtype=np.int64)) - both
    common = np.minimum(size - alone, one_size - one_alone)
    return 100 * common >= SIMILAR_PERCENT * (size + one_size - common)


def _may_meet(table: pa.Table) -> pa.Table:
    """(list, node) of what may be linked with a set of another component on the other side of a block."""
    component, side, size, node = (table[c].to_numpy(zero_copy_only=False) for c in ("component", "left", "size", "node"))
    lists = table["bits"].combine_chunks()
    begins, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
    words = np.diff(begins)
    bits, rows = {}, {}
    for n in np.unique(words).tolist():
        rows[n] = np.flatnonzero(words == n)
        bits[n] = values[begins[:-1][rows[n]][:, None] + np.arange(n)]
    made = np.zeros(len(node), bool)
    for n, own in rows.items():
        left = np.flatnonzero(side[own])
        for m in (n // 2, n, 2 * n):  # linked sets are not more apart in width
            right = np.flatnonzero(~side[rows[m]]) if m in rows else np.zeros(0, np.int64)
            if not len(right):
                continue
            mine, its, at = bits[n][left], bits[m][right], rows[m][right]
            mine, its = (x[:, : min(n, m)] | x[:, x.shape[1] - min(n, m) :] for x in (mine, its))
            for row, one in zip(own[left].tolist(), mine, strict=True):
                near = at[may_link(size[at], its, int(size[row]), one) & (component[at] != component[row])]
                made[near] = True
                made[row] |= len(near) > 0
    return pa.table({"list": table["list"].filter(pa.array(made)), "node": pa.array(node[made])})


def common_by_leader(led: int, missing: np.ndarray, lists: pa.ListArray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What sets have in common, by their differences from a leader of size ``led`` (rows left x right)."""
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, at, seen = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    common = seen[at] > 1
    rows, at = rows[common], (np.cumsum(seen > 1) - 1)[at[common]]
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, _COLUMNS):
        part = slice(*np.searchsorted(at, [begin, begin + _COLUMNS]))
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[rows[part], at[part] - begin] = 1
        both += has[left] @ has[right].T
    return both.astype(np.int64) + led - missing[left][:, None] - missing[right][None, :]


def _compare(table: pa.Table) -> pa.Table:
    """A spanning forest of the links between components, of the two sides of a block."""
    component, side, size = (table[c].to_numpy(zero_copy_only=False) for c in ("component", "left", "size"))
    left, right = np.flatnonzero(side), np.flatnonzero(~side)
    lists = table["apart"].combine_chunks()
    both = common_by_leader(table["led"][0].as_py(), table["missing"].to_numpy().astype(np.int64), lists, left, right)
    size = size.astype(np.int64)
    union = size[left][:, None] + size[right][None, :] - both
    linked = (100 * both >= SIMILAR_PERCENT * union) & (component[left][:, None] != component[right][None, :])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    forest = []
    one, two = np.nonzero(linked)
    edges = np.unique(np.stack([component[left[one]], component[right[two]]], 1), axis=0) if len(one) else np.zeros((0, 2), np.int64)
    for x, y in edges.tolist():
        low, high = sorted((root(x), root(y)))
        if low != high:
            parent[high] = low
            forest.append((low, high))
    return pa.table({"a": pa.array([a for a, _ in forest], pa.int64()), "b": pa.array([b for _, b in forest], pa.int64())})


def jaccard_classes(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; shingles have so many words."""
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    every = _read(docs, words)
    rows = every.where("range is null").drop("range", "counts")
    members = _members(docs, _order(every), words)
    places = _places(rows, members)
    known = _known(docs, places, words)

    def sets_of(nodes: DataFrame) -> DataFrame:
        return _sets(docs, places, nodes, words)

    near = _led(members, known, sets_of)
    joined = components(_rest_links(members, near, known, sets_of))
    outer = joined.select(F.col("node").alias("component"), F.col("component").alias("outer"))
    inner = near.join(outer, "component", "left").select("node", F.coalesce("outer", "component").alias("component"))
    found = inner.union(joined.join(near, "node", "left_anti").select("node", "component"))
    # the smallest id of a set, of its component, and back
    first = rows.where("size > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    first = written(first.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    least = first.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("sets"))
    several = size_bounded(written(least.where("sets > 1").drop("sets")), BROADCAST_ROWS)
    classes = written(first.join(several, "component", "left").select("node", F.coalesce("component_id", "first").alias("component_id")))
    made = rows.join(classes, "node", "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return made.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
