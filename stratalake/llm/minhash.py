"""Near-duplicate documents by circulant MinHash, confirmed on full shingle sets.

A signature has ``BANDS`` * ``ROWS`` coordinates from two permutations of the 64-bit numbers: the first
scatters a document's shingles, the second orders them, and coordinate k is the least value of the
second after its argument was shifted circularly by k. Documents that agree in a band share a bucket.
A pair with the similarity 0.8 shares none with a probability of 7 in a million.

Links are found in two exact steps, neither of which emits all pairs of a bucket:

1. Equal sets are one node from the start. Each bucket has a pivot, the member that shares most
   buckets with others; all members are compared with it on full sets. Linked ones are joined.
2. Buckets whose members then lie in several components are compared pair by pair, in blocks of
   ``BLOCK`` members a side: a matrix product counts what full sets have in common, and of the links
   between components a spanning forest is emitted.

Thus what leaves a bucket grows with its members, and a large bucket is the work of many tasks.

A word is a longest run without white space, A-Z in lower case; a document's set are its distinct
shingles of ``SHINGLE`` words (a parameter), or its whole sequence if it has fewer. Null texts and those without words have
an empty set and are linked with nothing. Rows with equal ids count as one document for links. A null
id joins the component of its equal set, and has none if there is no other. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.shared import lean, size_bounded, without, written
from stratalake.llm.words import Block, blocks, mix, windows

SHINGLE = 5
SIMILAR_PERCENT = 80
BANDS, ROWS = 30, 5
#: Members of a side of a block.
BLOCK = 512
#: More rows than this are joined by shuffle, fewer by broadcast (8 to 16 bytes each).
BROADCAST_ROWS = 500_000
_SCATTER, _ORDER = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_COLUMNS = 2048


def shingles(block: Block, words: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, in order, and where each text's begin."""
    starts, ends, firsts = block.words()
    hashes = block.hashes(starts, ends, lower=True)
    found, offsets = windows(hashes, firsts, words)
    rows = np.repeat(np.arange(block.rows), np.diff(offsets))
    sizes = np.diff(firsts)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            has = sizes[short] > k
            whole[has] = whole[has] * _STEP + hashes[firsts[short[has]] + k]
        found = np.concatenate([found, mix(whole + sizes[short].astype(np.uint64))])
        rows = np.concatenate([rows, short])
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    found, rows = found[new], rows[new]
    return found, np.searchsorted(rows, np.arange(block.rows + 1))


def band_hashes(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The hash of each band of each text's signature; texts without shingles have zeros."""
    made = np.zeros((len(offsets) - 1, BANDS), np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        scattered, begins = mix(found ^ _SCATTER), offsets[filled]
        for band in range(BANDS):
            value = np.full(len(filled), band + 1, np.uint64)
            for k in range(band * ROWS, band * ROWS + ROWS):
                value = mix(value + np.minimum.reduceat(mix((scattered + np.uint64(k)) ^ _ORDER), begins))
            made[filled, band] = value
    return made


def signed(text: Column, words: int) -> Column:
    """A struct of the size of a text's set, two hashes of the whole set, and its bands."""

    def of(texts: pa.Array) -> pa.Array:
        sizes, sums, others, bands = [], [], [], []
        for block in blocks(texts):
            found, offsets = shingles(block, words)
            sizes.append(np.diff(offsets))
            for sink, values in ((sums, mix(found ^ _STEP)), (others, mix(found + _STEP))):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
                sink.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
            bands.append(band_hashes(found, offsets).view(np.int64).ravel())
        flat = [np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (sizes, sums, others, bands)]
        ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS)
        columns = [*map(pa.array, flat[:3]), pa.ListArray.from_arrays(ends, pa.array(flat[3]))]
        return pa.StructArray.from_arrays(columns, ["size", "sum", "other", "bands"])

    return F.arrow_udf(lean(of), "struct<size: bigint, sum: bigint, other: bigint, bands: array<bigint>>")(text)


def shingle_sets(text: Column, words: int) -> Column:
    """The full set of a text as an array of hashes."""

    def of(texts: pa.Array) -> pa.Array:
        values, sizes = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
        for block in blocks(texts):
            found, offsets = shingles(block, words)
            values.append(found.view(np.int64))
            sizes.append(np.diff(offsets))
        ends = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))

    return F.arrow_udf(lean(of), "array<bigint>")(text)


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row; shingles have so many words."""
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    rows = written(docs.select("doc_id", "text_hash", signed(F.col("text"), words).alias("s")).select("doc_id", "text_hash", "s.*"))
    nodes = rows.where("size > 0").groupBy("size", "sum", "other").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    nodes = written(nodes)
    members = _buckets(nodes)
    sets = _sets(docs, members, words)
    first = _linked(_pivot_pairs(members), sets)
    near = components(first)
    rest = _block_links(members, near, sets)
    joined = _merge(near, components(rest))
    # a node that is linked with no other is its own component
    found = nodes.drop("bands").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("size", "sum", "other", F.coalesce("component", "rep").alias("component_id"))
    every = rows.drop("bands").join(found, ["size", "sum", "other"], "left")
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    every = every.select("doc_id", "text_hash", F.col("size").alias("n_shingles"), component.alias("component_id"))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """The documents that are kept: of each component the one with the smallest id."""
    return without(docs, near_duplicates(docs, words).where("not kept"), BROADCAST_ROWS)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, members, central, rep) of buckets with several nodes; written.

    Of buckets with the same members one is kept. ``central``: in how many rows of buckets a node is.
    """
    banded = nodes.where("rep is not null").select("rep", F.explode("bands").alias("bucket"))
    of_rep = F.xxhash64("rep").cast("decimal(20,0)")
    shared = banded.groupBy("bucket").agg(
        F.count("*").alias("members"), F.sum(of_rep).alias("mark"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("other")
    )
    shared = written(shared.where("members > 1"))
    kept = shared.groupBy("members", "mark", "other").agg(F.min("bucket").alias("bucket"), F.count("*").alias("times"))
    kept = written(kept.select("bucket", "members", "times"))
    members = written(banded.join(size_bounded(kept, BROADCAST_ROWS), "bucket"))
    central = members.groupBy("rep").agg(F.sum(F.col("members") * F.col("times")).alias("central"))
    return written(members.drop("times").join(central, "rep"))


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of all nodes in buckets; written. Other texts are not read beyond the scan."""
    wanted = size_bounded(written(members.select(F.col("rep").alias("doc_id")).distinct()), BROADCAST_ROWS)
    chosen = docs.join(wanted, "doc_id", "left_semi")
    return written(chosen.select(F.col("doc_id").alias("rep"), shingle_sets(F.col("text"), words).alias("shingles")))


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of every member of a bucket and its pivot."""
    best = F.max_by("rep", F.struct("central", -F.col("rep"))).alias("pivot")
    pivots = size_bounded(written(members.groupBy("bucket").agg(best)), BROADCAST_ROWS)
    pairs = members.join(pivots, "bucket").where("rep <> pivot")
    return pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs whose full sets are similar; written."""
    for side in ("a", "b"):
        own = sets.select(F.col("rep").alias(side), F.col("shingles").alias(f"of_{side}"))
        pairs = pairs.join(own, side)
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    return written(pairs.where(100 * both >= SIMILAR_PERCENT * union).select("a", "b"))


def _block_links(members: DataFrame, near: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components that meet in a bucket, as links of components; written."""
    placed = members.join(near.withColumnRenamed("node", "rep"), "rep", "left")
    placed = written(placed.select("bucket", "members", "rep", F.coalesce("component", "rep").alias("component")))
    open_ = placed.where("members > 2").groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = size_bounded(written(open_.where("low <> high").select("bucket")), BROADCAST_ROWS)
    n = F.ceil(F.col("members") / BLOCK).cast("long")
    rows = placed.join(open_, "bucket").withColumn("own", F.pmod(F.xxhash64("rep"), n))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    rows = rows.select(
        "bucket",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).alias("second"),
        "component",
        "rep",
    )
    found = rows.join(sets, "rep").groupBy("bucket", "i", "j").applyInArrow(_compare, "a long, b long")
    return written(found.distinct())


def _compare(table: pa.Table) -> pa.Table:
    """A spanning forest of the links between components, of the two sides of a block or within one."""
    component = table["component"].to_numpy()
    second = table["second"].to_numpy()
    lists = table["shingles"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, at, seen = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    common = seen[at] > 1
    number = np.cumsum(seen > 1) - 1
    rows, at = rows[common], number[at[common]]
    left = np.flatnonzero(~second)
    right = np.flatnonzero(second) if second.any() else left
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    for begin in range(0, int(at[-1]) + 1 if len(at) else 0, _COLUMNS):
        part = slice(*np.searchsorted(at, [begin, begin + _COLUMNS]))
        has = np.zeros((len(sizes), _COLUMNS), np.float32)
        has[rows[part], at[part] - begin] = 1
        both += has[left] @ has[right].T
    both = both.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - both
    linked = (100 * both >= SIMILAR_PERCENT * union) & (component[left][:, None] != component[right][None, :])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    forest = []
    for x, y in zip(*(component[side[i]].tolist() for side, i in zip((left, right), np.nonzero(linked), strict=True)), strict=True):
        low, high = sorted((root(x), root(y)))
        if low != high:
            parent[high] = low
            forest.append((low, high))
    return pa.table({"a": pa.array([a for a, _ in forest], pa.int64()), "b": pa.array([b for _, b in forest], pa.int64())})


def _merge(near: DataFrame, joined: DataFrame) -> DataFrame:
    """(node, component) after components were joined with one another."""
    outer = joined.select(F.col("node").alias("component"), F.col("component").alias("outer"))
    inner = near.join(outer, "component", "left").select("node", F.coalesce("outer", "component").alias("component"))
    alone = joined.join(near, "node", "left_anti").select("node", "component")
    return written(inner.union(alone))
