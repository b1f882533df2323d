"""Merging a batch into stored rows by key."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.names import column, find_name


@dataclass(frozen=True)
class Rule:
    """What makes rows the same, and which of them wins.

    A key is unique within its partition. With ``newest_wins`` a stored row stays if its
    ``order`` columns are larger than the batch's, NULL being lowest; without it the batch
    always replaces.
    """

    keys: Sequence[str]
    order: Sequence[str]
    partitions: Sequence[str] = ()
    newest_wins: bool = True

    @property
    def match(self) -> list[str]:
        return list(dict.fromkeys([*self.partitions, *self.keys]))

    @property
    def compared(self) -> list[str]:
        return list(dict.fromkeys([*self.match, *(self.order if self.newest_wins else ())]))


def merge_newest(
    target: DataFrame,
    batch: DataFrame,
    rule: Rule,
    oldest: str | None = None,
    known: DataFrame | None = None,
    broadcast_known: bool = False,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Stored rows the batch does not replace, and batch rows no newer stored row holds back.

    ``batch`` has one row per key. All joins are on keys alone, so with the batch's keys
    broadcast the stored rows are never shuffled, and without it Spark may split a skewed
    stored key.

    ``known`` stands for the batch in the joins: see :func:`known_keys`. ``kept``, the
    result of :func:`kept_keys`, is broadcast to pick the stored rows that stay. ``oldest``
    is the smallest order value in the batch, as text: see :func:`stored_after`.
    """
    known = batch if known is None else known
    if broadcast_known:
        known = F.broadcast(known.select(*map(column, rule.compared)))
    stored = _with_columns(target, batch, rule.compared)
    if kept is None:
        staying = _not_replaced(stored, known, rule)
    else:
        names = {c: f"__k{i}" for i, c in enumerate(rule.compared)}
        staying = stored.join(
            F.broadcast(_renamed(kept, names)),
            reduce(operator.and_, [column(c).eqNullSafe(F.col(k)) for c, k in names.items()]),
            "left_semi",
        )
    if not rule.newest_wins:
        return staying.unionByName(batch, allowMissingColumns=True)

    candidates = stored if oldest is None else stored_after(stored, batch, rule, oldest)
    incoming, names = _incoming(known, rule)
    held = {c: f"__h{i}" for i, c in enumerate(rule.match)}
    held_back = (
        candidates.select(*map(column, rule.compared))
        .join(incoming, _same_key(names, rule) & _stored_is_newer(names, rule))
        .select(*[F.col(names[c]).alias(h) for c, h in held.items()])
    )
    if broadcast_known:
        # No more rows than the keys that are broadcast already.
        held_back = F.broadcast(held_back.distinct())
    winning = batch.join(held_back, _same_key(held, rule), "left_anti")
    return staying.unionByName(winning, allowMissingColumns=True)


def known_keys(target: DataFrame, batch: DataFrame, rule: Rule) -> DataFrame:
    """Keys and order of the batch rows whose keys are stored.

    A large batch may be mostly new rows. Joining key columns alone tells, at a fraction
    of a shuffle of all columns.
    """
    names = {c: f"__t{i}" for i, c in enumerate(rule.match)}
    stored = _renamed(_with_columns(target, batch, rule.match), names)
    return batch.select(*map(column, rule.compared)).join(stored, _same_key(names, rule), "left_semi")


def kept_keys(target: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    """Keys and order of the stored rows the batch does not replace.

    A batch that holds the whole table again replaces nearly all of it, and then these few
    keys say what stays, again from key columns alone.
    """
    stored = _with_columns(target, known, rule.compared).select(*map(column, rule.compared))
    return _not_replaced(stored, known, rule)


def stored_after(target: DataFrame, batch: DataFrame, rule: Rule, oldest: str) -> DataFrame:
    """Stored rows that may be newer than the oldest row of the batch.

    The filter reaches the scan. Where batches come in the order of time, Parquet
    statistics alone tell that there are none.
    """
    first = rule.order[0]
    bound = F.lit(oldest).cast(batch.schema[first].dataType)
    stored = _with_columns(target, batch, rule.order)
    return stored.filter(column(first) >= bound if rule.order[1:] else column(first) > bound)


def _not_replaced(stored: DataFrame, known: DataFrame, rule: Rule) -> DataFrame:
    incoming, names = _incoming(known, rule)
    replaced = _same_key(names, rule)
    if rule.newest_wins:
        replaced = replaced & ~_stored_is_newer(names, rule)
    return stored.join(incoming, replaced, "left_anti")


def _incoming(known: DataFrame, rule: Rule) -> tuple[DataFrame, dict[str, str]]:
    names = {c: f"__b{i}" for i, c in enumerate(rule.compared)}
    return _renamed(known, names), names


def _renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*[column(c).alias(n) for c, n in names.items()])


def _same_key(names: Mapping[str, str], rule: Rule) -> Column:
    """Same key, in the same partition; a partition value may be NULL, a key may not."""
    same = [column(p).eqNullSafe(F.col(names[p])) for p in rule.partitions if p not in rule.keys]
    return reduce(operator.and_, same + [column(k) == F.col(names[k]) for k in rule.keys])


def _stored_is_newer(names: Mapping[str, str], rule: Rule) -> Column:
    return _rank(column(c) for c in rule.order) > _rank(F.col(names[c]) for c in rule.order)


def _rank(columns: Iterable[Column]) -> Column:
    """Order columns as one value; within a struct NULL counts as lowest."""
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])


def _with_columns(target: DataFrame, batch: DataFrame, needed: Sequence[str]) -> DataFrame:
    """Give stored rows the columns a merge compares, NULL where they never had them."""
    for name in needed:
        if find_name(target.columns, name) is None:
            target = target.withColumn(name, F.lit(None).cast(batch.schema[name].dataType))
    return target
