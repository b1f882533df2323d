"""Quality rules with thresholds that follow each language and source.

Counts of a text: words, their characters, symbols, repeated lines, words in repeated 8-word
windows, upper-case and punctuation bytes, and lines. A text fails the fixed rules if it is too
short or repeats itself. Of the others, each *share* (per thousand, or 100 times the mean word
length) is compared with a fence of its group: third quartile plus ``FENCE`` times the distance of
the quartiles, that distance being ``SPREAD`` of the share at least.

The quartiles come from a mergeable sketch of each group: counts by bucket, with 16 buckets for
each power of two, so a quantile is off by 1/16 of its value at most. A sketch is a table of
(lang, source, share, bucket, rows); merging is adding the rows, so sketches of parts, days or
clusters can be added at any time. Where a group has fewer than ``MIN_DOCS`` documents, the sketch
of its language stands in, and then that of all: the same sketches, merged.

Null and empty texts have no words and fail the fixed rules. A null lang or source is a group of its
own. Rows with equal ids are judged one by one. An empty table has no sketches and no result. Extra
columns are kept; those named like a count or a verdict are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.shared import free_name, lean, once, size_bounded, written
from stratalake.llm.words import Block, blocks, windows

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: A group needs so many documents for thresholds of its own.
MIN_DOCS = 200
FENCE = 4
#: More groups than this are joined by shuffle.
BROADCAST_GROUPS = 20_000
#: Each share: how it is made of the counts, and the least distance of its quartiles.
SHARES = {
    "symbols": ("n_symbols * 1000 div greatest(word_chars, 1)", 10),
    "upper": ("n_upper * 1000 div greatest(word_chars, 1)", 30),
    "punctuation": ("n_punct * 1000 div greatest(word_chars, 1)", 20),
    "dup_lines": ("n_dup_lines * 1000 div greatest(n_lines, 1)", 100),
    "repeats": ("n_repeat_words * 1000 div greatest(n_words, 1)", 80),
    "word_length": ("word_chars * 100 div greatest(n_words, 1)", 100),
}
FENCES = [f"fence_{share}" for share in SHARES]
COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_upper n_punct n_lines".split()

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!?;:\"'()[]{}=+-_/\\~^`@")] = True
_REST_OF_CHAR = (np.arange(256) & 0xC0) == 0x80


def _repeated(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: is it equal to an earlier one of its row; is it equal to any other of its row."""
    order = np.lexsort((hashes, rows))
    same = np.zeros(len(order) + 1, bool)
    if len(order):
        r, h = rows[order], hashes[order]
        same[1:-1] = (r[1:] == r[:-1]) & (h[1:] == h[:-1])
    later, some = np.zeros(len(order), bool), np.zeros(len(order), bool)
    later[order], some[order] = same[:-1], same[:-1] | same[1:]
    return later, some


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marks lie between each two offsets."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def count_block(block: Block) -> dict[str, np.ndarray]:
    """The counts of each text of a block."""
    starts, ends, firsts = block.words()
    hashes = block.hashes(starts, ends)
    data, offsets = block.data, block.offsets
    filled = np.concatenate([[0], np.cumsum(ends - starts)])
    rest = _per_row(_REST_OF_CHAR[data], offsets)  # white space has none

    found, window_firsts = windows(hashes, firsts, WINDOW)
    rows = np.repeat(np.arange(block.rows), np.diff(window_firsts))
    _, some = _repeated(rows, found)
    begins = (firsts[rows] + np.arange(len(found)) - window_firsts[rows])[some]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0

    line_starts, line_ends, line_firsts = block.runs(data != 10)
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    kept_firsts = np.concatenate([[0], np.cumsum(with_word)])[line_firsts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_rows = np.repeat(np.arange(block.rows), np.diff(kept_firsts))
    again, _ = _repeated(line_rows, block.hashes(line_starts, line_ends))

    return {
        "n_words": np.diff(firsts),
        "word_chars": np.diff(filled[firsts]) - rest,
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_dup_lines": _per_row(again, kept_firsts),
        "n_repeat_words": _per_row(covered, firsts),
        "n_upper": _per_row(_UPPER[data], offsets),
        "n_punct": _per_row(_PUNCT[data], offsets),
        "n_lines": np.diff(kept_firsts),
    }


def counts(text: Column) -> Column:
    """A struct of the counts of a text."""

    def of(texts: pa.Array) -> pa.Array:
        parts = [count_block(block) for block in blocks(texts)]
        columns = [np.concatenate([np.zeros(0, np.int64), *(part[c] for part in parts)]) for c in COUNTS]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], COUNTS)

    return once(F.arrow_udf(lean(of), "struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ">"))(text)


def measure(docs: DataFrame) -> DataFrame:
    """The rows with their counts, shares and ``base_failed``."""
    docs = docs.drop(*COUNTS, *SHARES, "base_failed", "kept")
    name = free_name(docs, "counts")
    made = docs.withColumn(name, counts(F.col("text"))).select(*[f"`{c}`" for c in docs.columns], f"{name}.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return made.withColumns({share: F.expr(how) for share, (how, _) in SHARES.items()} | {"base_failed": failed})


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, share, bucket, rows) of the documents that pass the fixed rules.

    Values below 32 have a bucket each; above, each power of two has 16.
    """
    shares = F.expr("stack({}, {}) as (share, value)".format(len(SHARES), ", ".join(f"'{s}', {s}" for s in SHARES)))
    power = "(length(bin(value)) - 5)"
    return (
        measured.where("not base_failed")
        .select("lang", "source", shares)
        .withColumn("bucket", F.expr(f"if(value < 32, value, 16 * {power} + value div shiftleft(1L, {power}))"))
        .groupBy("lang", "source", "share", "bucket")
        .agg(F.count("*").alias("rows"))
    )


def merge(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches of all groups with equal ``keys``, added up."""
    return sketches.groupBy(*keys, "share", "bucket").agg(F.sum("rows").alias("rows"))


def fences(sketches: DataFrame, *keys: str) -> DataFrame:
    """One row per group: its documents and the fence of each share."""
    of_group = Window.partitionBy(*keys, "share")
    edge = F.expr("if(bucket < 32, bucket, (bucket % 16 + 16) * shiftleft(1L, int(bucket div 16 - 1)))")
    reached = sketches.select(
        *keys,
        "share",
        edge.alias("edge"),
        F.sum("rows").over(of_group).alias("docs"),
        F.sum("rows").over(of_group.orderBy("bucket")).alias("below"),
    )
    quartile = [F.min(F.when(4 * F.col("below") >= q * F.col("docs"), F.col("edge"))) for q in (1, 3)]
    by_share = reached.groupBy(*keys, "share", "docs").agg(quartile[0].alias("q1"), quartile[1].alias("q3"))
    spread = F.create_map(*[F.lit(x) for share, (_, least) in SHARES.items() for x in (share, least)])
    fence = F.col("q3") + FENCE * F.greatest(F.col("q3") - F.col("q1"), spread[F.col("share")])
    return by_share.groupBy(*keys, "docs").agg(
        *[F.max(F.when(F.col("share") == share, fence)).alias(f"fence_{share}") for share in SHARES]
    )


def thresholds(sketches: DataFrame) -> DataFrame:
    """The fences of each (lang, source): its own, its language's, or those of all."""
    own, lang, everything = (fences(merge(sketches, *k), *k) for k in (("lang", "source"), ("lang",), ()))
    lang = lang.select(F.col("lang").alias("_lang"), F.struct("docs", *FENCES).alias("_of_lang"))
    made = own.join(lang, own["lang"].eqNullSafe(lang["_lang"]), "left")
    of_all = everything.first()  # one row
    chosen = [
        F.when(F.col("docs") >= MIN_DOCS, F.col(f))
        .when(F.col("_of_lang.docs") >= MIN_DOCS, F.col(f"_of_lang.{f}"))
        .otherwise(F.lit(of_all[f] if of_all else None).cast("long"))
        .alias(f)
        for f in FENCES
    ]
    return made.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *chosen)


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with ``kept``: they pass the fixed rules and lie within their group's fences."""
    limits = limits.select("_lang", "_source", F.struct(*FENCES).alias("_fences"))
    named = {c: free_name(measured, c) for c in limits.columns}
    limits = size_bounded(limits.withColumnsRenamed(named), BROADCAST_GROUPS)
    same = F.col("lang").eqNullSafe(F.col(named["_lang"])) & F.col("source").eqNullSafe(F.col(named["_source"]))
    within = ~F.col("base_failed")
    for share in SHARES:
        within &= F.coalesce(F.col(share) <= F.col(f"{named['_fences']}.fence_{share}"), F.lit(False))
    return measured.join(limits, same, "left").withColumn("kept", within).drop(*named.values())


def quality(docs: DataFrame) -> DataFrame:
    """All rows with their counts, shares, ``base_failed`` and ``kept``.

    Texts are read twice, for the sketches and for the verdict, and never shuffled unless there are
    more than ``BROADCAST_GROUPS`` groups.
    """
    measured = measure(docs)
    return judge(measured, written(thresholds(written(sketch(measured)))))
