"""Keyed tables: merge a batch into a Parquet dataset, one newest row per key."""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from stratalake.functions.names import column, find_name, require_name
from stratalake.operators.cluster import clustered
from stratalake.operators.gather import gather
from stratalake.operators.latest import latest_of_repeated, latest_per_key, repeated_keys
from stratalake.operators.merge import Rule, kept_keys, known_keys, merge_newest, stored_after
from stratalake.operators.reconcile import grown, reconciled
from stratalake.sinks import staging, storage
from stratalake.sinks.ownership import Owner, owned

NEWEST_WINS = "newest_wins"
INCOMING_WINS = "incoming_wins"

# Keys are broadcast up to this many bytes, which a driver of 1 GB holds; beyond it they are
# joined by a shuffle.
BROADCAST_BYTES = 64 << 20

# From this many rows on, and this many columns to each key column, a batch is searched
# for repeated keys first.
LARGE_BATCH_ROWS = 10_000_000
COLUMNS_PER_KEY_COLUMN = 4

# Small files of a partition that are no larger than twice what the batch has for it are rewritten with it
# if they are more than FEW_FILES, so that it has few files of a size and a row is rewritten a few times only.
# All small files of a partition, or of an unpartitioned dataset, are if they are more than MANY_FILES. Larger ones stay.
FEW_FILES = 2
MANY_FILES = 32

# What a small file is. Well below what a compaction leaves, or it would be repeated every time.
SMALL_FILE_BYTES = 8 << 20


def upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: Sequence[str] = (),
    stale: str = NEWEST_WINS,
    options: Mapping | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    publish: str = staging.AUTO,
    rows: int | None = None,
    large_batch_rows: int | None = None,
    cluster: bool = False,
) -> tuple[StructType, list[str]]:
    """Merge ``batch`` into the dataset at ``path``; return its schema and the partitions written.

    New keys are inserted, known ones replaced. With ``newest_wins`` a stored row with a
    larger ``order`` stays, and a tie goes to the batch; with ``incoming_wins`` the batch
    always replaces. With ``partitions`` a key is unique within its partition, and only
    partitions the batch has rows for are read and rewritten.

    ``rows``, where the caller knows how many rows the batch has and that reading it again
    gives the same, lets a batch of ``large_batch_rows`` or more (ten million) be searched
    for repeated keys before it is shuffled. A batch that does not read the same twice
    should be given without ``rows``.

    With ``cluster`` rows are written in ranges of their keys, see :func:`~stratalake.operators.cluster.clustered`:
    files that a batch of a key range can't touch are then known by their statistics. This costs a
    shuffle of what is written.

    Structs of the batch may have fields that stored ones lack, and the other way round, at any depth.

    One run at a time may write a path, see :mod:`stratalake.sinks.ownership`.
    """
    with owned(batch.sparkSession, path) as owner:
        large = LARGE_BATCH_ROWS if large_batch_rows is None else large_batch_rows
        repeatable = rows is not None and rows >= large
        return _upsert(batch, path, keys, order, partitions, stale, options, broadcast_bytes, publish, repeatable, cluster, owner)


def _upsert(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    partitions: Sequence[str],
    stale: str,
    options: Mapping | None,
    broadcast_bytes: int,
    publish: str,
    large: bool,
    cluster: bool,
    owner: Owner,
) -> tuple[StructType, list[str]]:
    spark = batch.sparkSession
    batch, rule = _checked(batch, keys, order, partitions, stale)
    partitions = rule.partitions
    staging.recover(spark, path, options, publish, owner)
    file = storage.require_layout(spark, path, partitions)
    if file and partitions:
        # Partitions the batch does not touch are not read, but one dataset has one type for a column.
        _common_schema(spark.read.parquet(file).schema, batch.schema, widen=False)

    # what is staged for partitions that are new, or for the first load, is published as it is
    as_is = cluster and (bool(partitions) or not file)
    staged_at, staged, facts = _staged(batch, rule, path, options, broadcast_bytes, large, as_is, owner)
    if not facts["rows"]:
        return batch.schema, []

    target, files = _read_touched(spark, path, staged_at, staged, partitions) if file else (None, {})
    if target is None:
        written = staging.publish(spark, staged_at, path, partitions, options, publish, owner)
        staging.discard(spark, path, owner)
        return staged.schema, written

    common = _common_schema(target.schema, staged.schema, widen=not partitions)
    small = _small_files(files, storage.files_below(spark, staged_at, len(partitions)))
    if target.schema == common and {f.name for f in staged.schema} == set(common.names):
        written = _replace_files(target, grown(staged, common), files, small, rule, facts, path, options, broadcast_bytes, publish, cluster, owner)
        if written is not None:
            return target.schema, written
    merged, shuffled = _merge(grown(target, common), grown(staged, common), rule, facts, path, broadcast_bytes, owner)
    schema = merged.schema
    if cluster:
        merged = clustered(merged, rule.keys, partitions)
    elif shuffled or small:
        # A shuffle by key leaves rows of every partition in every task, and so a file each.
        merged = gather(merged, partitions)
    merged_at = staging.merge_stage(path, owner.suffix)
    staging.write_stage(merged, merged_at, partitions, options)
    written = staging.publish(spark, merged_at, path, partitions, options, publish, owner)
    staging.discard(spark, path, owner)
    return schema, written


def write_version(
    batch: DataFrame,
    path: str,
    stored_at: str | None,
    version: str,
    keys: Sequence[str],
    order: Sequence[str],
    owner: Owner,
    stale: str = NEWEST_WINS,
    options: Mapping | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows: int | None = None,
    large_batch_rows: int | None = None,
    cluster: bool = False,
) -> StructType | None:
    """Write the rows of ``stored_at``, merged with the batch, to the new directory ``version``; return their schema.

    None, and nothing written, for a batch without rows. Unpartitioned datasets only; what is stored is not changed.
    """
    spark = batch.sparkSession
    batch, rule = _checked(batch, keys, order, (), stale)
    staging.recover(spark, path, options, owner=owner)
    large = rows is not None and rows >= (LARGE_BATCH_ROWS if large_batch_rows is None else large_batch_rows)
    _, merged, facts = _staged(batch, rule, path, options, broadcast_bytes, large, False, owner)
    if not facts["rows"]:
        return None
    if stored_at is not None:
        target = staging.read_typed(spark, [stored_at], stored_at, {})
        common = _common_schema(target.schema, merged.schema, widen=True)
        merged, _ = _merge(grown(target, common), grown(merged, common), rule, facts, path, broadcast_bytes, owner)
    staging.write_stage(clustered(merged, rule.keys) if cluster else merged, version, (), options)
    staging.discard(spark, path, owner)
    return merged.schema


def _checked(batch: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: Sequence[str], stale: str) -> tuple[DataFrame, Rule]:
    if stale not in (NEWEST_WINS, INCOMING_WINS):
        raise ValueError(f"stale must be {NEWEST_WINS!r} or {INCOMING_WINS!r}, not {stale!r}")
    if not keys or not order:
        raise ValueError("an upsert needs key columns and order columns")
    keys, order, partitions = ([require_name(batch, c) for c in names] for names in (keys, order, partitions))
    return with_directory_nulls(batch, partitions), Rule(keys, order, partitions, stale == NEWEST_WINS)


def _staged(
    batch: DataFrame, rule: Rule, path: str, options: Mapping | None, broadcast_bytes: int, large: bool, cluster: bool, owner: Owner
) -> tuple[str, DataFrame, dict]:
    """The batch with one row per key, written beside the dataset: where, its rows and their measures."""
    spark, staged_at = batch.sparkSession, staging.batch_stage(path, owner.suffix)
    winners = _one_per_key(batch, rule, path, broadcast_bytes, large, owner)
    laid_out = clustered(winners, rule.keys, rule.partitions) if cluster else gather(winners, rule.partitions)
    staging.write_stage(laid_out, staged_at, rule.partitions, options)
    staged = staging.read_as(spark, [staged_at], staged_at, batch.schema)
    facts = _measure(staged, rule)
    if facts["null_keys"] or not facts["rows"]:
        staging.discard(spark, path, owner)
        if facts["null_keys"]:
            raise ValueError(f"the batch has rows with NULL in a key column, of {list(rule.keys)}")
    return staged_at, staged, facts


def _replace_files(
    target: DataFrame,
    staged: DataFrame,
    files: Mapping[str, int],
    small: set[str],
    rule: Rule,
    facts: Mapping,
    path: str,
    options: Mapping | None,
    broadcast_bytes: int,
    publish: str,
    cluster: bool,
    owner: Owner,
) -> list[str] | None:
    """Rewrite only the files that hold keys of the batch, and small ones if they are many; add new rows beside them.

    Which files those are comes from key columns alone. Returns the partitions written; None, and nothing
    done, where that is no gain or not possible: the batch's keys are too
    many to broadcast, all files hold some, or a rename does not move files in place.
    """
    spark = target.sparkSession
    if facts["key_bytes"] > broadcast_bytes or not staging.moves(spark, path, publish):
        return None
    root, depth = path.rstrip("/"), len(rule.partitions)
    names = {c: f"__f{i}" for i, c in enumerate(rule.match)}
    wanted = F.broadcast(staged.select(*[column(c).alias(n) for c, n in names.items()]))
    same = reduce(operator.and_, [column(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    stored = target.where(_within(target, rule, facts)).select(F.col("_metadata.file_path").alias("__file"), *map(column, rule.match))
    found = stored.join(wanted, same, "left_semi").select("__file").distinct().collect()
    touched = {storage.relative_name(spark, row[0], depth) for row in found}
    replaced = sorted(touched | small)
    if len(replaced) == len(files):
        return None
    merged = staged
    if replaced:
        part = staging.read_as(spark, [f"{root}/{name}" for name in replaced], root, target.schema)
        merged = merge_newest(part, staged, rule, facts["oldest"], broadcast_known=True)
    merged_at = staging.merge_stage(path, owner.suffix)
    merged = merged.select(*map(column, target.columns))
    if cluster:
        merged = clustered(merged, rule.keys, rule.partitions)
    elif rule.partitions:
        merged = gather(merged, rule.partitions)
    elif small:
        merged = merged.hint("rebalance")
    staging.write_stage(merged, merged_at, rule.partitions, options)
    written = staging.publish_files(spark, merged_at, path, replaced, depth, owner)
    staging.discard(spark, path, owner)
    return written if rule.partitions else []


def _within(target: DataFrame, rule: Rule, facts: Mapping) -> Column:
    """What the range of the batch's keys says about stored ones, for the statistics of files."""
    inside = F.lit(True)
    for name, (low, high) in facts["ranges"].items():
        kind = target.schema[name].dataType
        if name not in rule.partitions and isinstance(kind, _EXACT):
            inside &= column(name).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return inside


def _small_files(files: Mapping[str, int], added: Mapping[str, int]) -> set[str]:
    """The small files that are due to be rewritten as fewer, by the sizes of all and of what the batch adds."""
    by_directory: dict[str, list[str]] = {}
    for name, size in files.items():
        if size < SMALL_FILE_BYTES:
            by_directory.setdefault(name.rpartition("/")[0], []).append(name)
    sizes = Counter()
    for name, size in added.items():
        sizes[name.rpartition("/")[0]] += size
    due = set()
    for directory, small in by_directory.items():
        alike = [name for name in small if directory and files[name] <= 2 * sizes[directory]]
        for names, most in ((alike, FEW_FILES), (small, MANY_FILES)):
            due |= set(names) if len(names) > most else set()
    return due


def _one_per_key(batch: DataFrame, rule: Rule, path: str, broadcast_bytes: int, large: bool, owner: Owner) -> DataFrame:
    """The newest row of every key in the batch.

    Most batches have no key twice. In a large one whose keys are a small part of its
    columns, finding those that are costs a shuffle of the keys and spares one of the rows.
    """
    if not large or len(batch.columns) < COLUMNS_PER_KEY_COLUMN * len(rule.match):
        return latest_per_key(batch, rule.match, rule.order)
    repeated = _aside(repeated_keys(batch, rule.match), staging.repeated_stage(path, owner.suffix))
    size = _key_bytes(repeated)
    if size == 0:
        return batch
    if size > broadcast_bytes:
        return latest_per_key(batch, rule.match, rule.order)
    return latest_of_repeated(batch, rule.match, rule.order, repeated)


def _merge(
    target: DataFrame, staged: DataFrame, rule: Rule, facts: Mapping, path: str, broadcast_bytes: int, owner: Owner
) -> tuple[DataFrame, bool]:
    """The merged rows, and whether getting them shuffles the stored rows.

    Whatever is small enough to broadcast spares that shuffle: the batch's keys, those of
    them that are stored, or the stored keys that stay. Each is measured before it is used.
    """
    oldest = facts["oldest"]
    if rule.newest_wins and oldest is not None and stored_after(target, staged, rule, oldest).isEmpty():
        rule = replace(rule, newest_wins=False)
    if facts["key_bytes"] <= broadcast_bytes:
        return merge_newest(target, staged, rule, oldest, broadcast_known=True), False
    # A batch of half the table or more is likely the table again; the count reads footers.
    again = facts["rows"] > target.count() // 2
    known = staged
    for few in ("kept", "known") if again else ("known", "kept"):
        if few == "known":
            known = _aside(known_keys(target, staged, rule), staging.known_stage(path, owner.suffix))
            if _key_bytes(known) <= broadcast_bytes:
                return merge_newest(target, staged, rule, oldest, known, broadcast_known=True), False
        else:
            kept = _aside(kept_keys(target, known, rule), staging.kept_stage(path, owner.suffix))
            if _key_bytes(kept) <= broadcast_bytes:
                return merge_newest(target, staged, rule, oldest, known, kept=kept), False
    return merge_newest(target, staged, rule, oldest, known), True


def _aside(df: DataFrame, stage: str) -> DataFrame:
    """Write keys next to the dataset, to be measured and joined without finding them again."""
    staging.write_stage(df, stage, ())
    return staging.read_as(df.sparkSession, [stage], stage, df.schema)


# Order types that come back from text unchanged, for a filter that reaches the scan.
_PUSHABLE = (IntegralType, DecimalType, StringType, DateType, TimestampType, TimestampNTZType)


# Key types that come back from text as they were in any time zone.
_EXACT = (IntegralType, DecimalType, StringType, DateType, TimestampNTZType)


def with_directory_nulls(batch: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Empty text as a partition value is stored in the directory of NULL, so it is NULL."""
    for name in partitions:
        if isinstance(batch.schema[name].dataType, StringType):
            batch = batch.withColumn(name, F.nullif(column(name), F.lit("")))
    return batch


def _measure(staged: DataFrame, rule: Rule) -> dict:
    """Rows, NULL keys, the oldest order value, the size and ranges of the keys, in one pass over those columns."""
    key_null = reduce(operator.or_, [column(k).isNull() for k in rule.keys])
    first = column(rule.order[0])
    pushable = isinstance(staged.schema[rule.order[0]].dataType, _PUSHABLE)
    exact = [k for k in rule.keys if isinstance(staged.schema[k].dataType, _EXACT)]
    ends = [end(column(k)).cast("string").alias(f"{end.__name__}{i}") for i, k in enumerate(exact) for end in (F.min, F.max)]
    facts = staged.agg(
        F.count("*").alias("rows"),
        F.count_if(key_null).alias("null_keys"),
        F.count_if(first.isNull()).alias("null_orders"),
        (F.min(first).cast("string") if pushable else F.lit(None)).alias("oldest"),
        _total_width(staged, [*rule.match, *rule.order]).alias("key_bytes"),
        *ends,
    ).first()
    ranges = {k: (facts[f"min{i}"], facts[f"max{i}"]) for i, k in enumerate(exact)}
    return {**facts.asDict(), "ranges": ranges, "oldest": None if facts["null_orders"] else facts["oldest"]}


def _key_bytes(keys: DataFrame) -> int:
    return keys.agg(_total_width(keys, keys.columns)).first()[0]


def _total_width(df: DataFrame, names: Iterable[str]) -> Column:
    """Bytes these columns take in a join's hash table, rather too many than too few."""
    row = reduce(operator.add, [_width(df, c) for c in dict.fromkeys(names)]) + F.lit(64)
    return F.coalesce(F.sum(row), F.lit(0))


def _width(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(column(name).cast("string")), F.lit(0)) + F.lit(16)


def _read_touched(
    spark: SparkSession, path: str, staged_at: str, staged: DataFrame, partitions: list[str]
) -> tuple[DataFrame | None, dict[str, int]]:
    """The stored rows a batch can touch, and the files they are in with their sizes.

    Of a partitioned dataset only the directories the staged batch also has are listed
    and read. They are as many as the write will replace, so a list of them is small.
    """
    root = path.rstrip("/")
    if not partitions:
        return staging.read_typed(spark, [root], root, {}), storage.files_below(spark, root, 0)
    touched = list(storage.partition_directories(spark, staged_at, len(partitions)))
    there = storage.for_each(lambda directory: storage.exists(spark, f"{root}/{directory}"), touched)
    files = storage.files_in(spark, root, [d for d, stored in zip(touched, there, strict=True) if stored])
    directories = sorted({name.rpartition("/")[0] for name in files})
    if not directories:
        return None, {}
    types = {p: staged.schema[p].dataType for p in partitions}
    return staging.read_typed(spark, [f"{root}/{d}" for d in directories], root, types, merge=True), files


def _common_schema(stored: StructType, incoming: StructType, widen: bool) -> StructType:
    """The stored columns in types that hold both sides' values, then those only the batch has.

    Columns may come and go, and structs may gain fields, but another kind of value is refused. Only a
    dataset that is rewritten as a whole may ``widen`` its numbers.
    """
    clashes, fields = [], []
    for field in stored:
        name = find_name(incoming.names, field.name)
        kind = field.dataType if name is None else reconciled(field.dataType, incoming[name].dataType, widen)
        if kind is None:
            clashes.append(f"{field.name}: {field.dataType.simpleString()} and {incoming[name].dataType.simpleString()}")
        fields.append(StructField(field.name, kind or field.dataType))
    if clashes:
        raise ValueError(f"stored and incoming columns differ in type: {clashes}")
    return StructType(fields + [f for f in incoming if find_name(stored.names, f.name) is None])
