"""The raw step and the trusted step of a job."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from stratalake.layers import Layers, layer_path
from stratalake.operators.incremental import incremental_filter
from stratalake.operators.transforms import CHAIN, CastLosses, apply_transforms
from stratalake.plans.jobs import parse_batch_date, parse_incremental, validate_job
from stratalake.sinks.raw import save_raw
from stratalake.sinks.trusted import save_trusted
from stratalake.sinks.upsert import NEWEST_WINS
from stratalake.sources import read_source
from stratalake.sources.batches import read_batch
from stratalake.sources.jdbc import Credentials

_log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchResult:
    """What a trusted step did: where, for which date, and how many rows the batch had.

    ``cast_losses`` are (transform, column, values that became NULL) for each cast. They are ``exact``
    unless tasks ran more than once, as after the loss of an executor.
    """

    path: str
    batch_date: str
    rows: int
    cast_losses: tuple[tuple[str, str, int], ...] = ()
    exact: bool = True


def run_raw(
    spark: SparkSession,
    job: Mapping,
    layers: Layers,
    batch_date: str,
    incremental: bool = True,
    credentials: Credentials | None = None,
) -> str:
    """Read a job's source and store it as the batch of ``batch_date``; return the raw path."""
    validate_job(job)
    batch_date = parse_batch_date(batch_date)
    source, destination = job["source"], job["destination"]
    path = layer_path(layers, "raw", destination["path"])
    df = read_source(spark, source, layers, credentials)
    if incremental and "conditions" in source:
        df = incremental_filter(df, source["conditions"], batch_date)
    save_raw(df, path, batch_date, destination.get("raw", {}).get("database"), destination.get("table_name"))
    _log.info("stored batch %s in %s", batch_date, path)
    return path


def run_trusted(
    spark: SparkSession,
    job: Mapping,
    layers: Layers,
    batch_date: str,
    transform_mode: str = CHAIN,
    stale: str = NEWEST_WINS,
) -> BatchResult:
    """Clean the raw batch of ``batch_date`` and store it in the trusted layer.

    A batch that is missing or has no rows leaves the trusted layer as it is. Its rows
    are counted from Parquet footers, and the same count tells whether it is empty.
    """
    validate_job(job)
    batch_date = parse_batch_date(batch_date)
    destination = job["destination"]
    trusted = destination["trusted"]
    path = layer_path(layers, "trusted", destination["path"])
    raw_path = layer_path(layers, "raw", destination["path"])
    batch = read_batch(spark, raw_path, batch_date, destination.get("options"))
    rows = batch.count() if batch is not None else 0
    _log.info("batch %s of %s has %d rows", batch_date, raw_path, rows)
    if not rows:
        return BatchResult(path, batch_date, rows)
    losses = CastLosses()
    batch = apply_transforms(batch, trusted.get("transformations", []), transform_mode, losses)
    save_trusted(batch, path, trusted, destination.get("table_name"), stale, rows)
    return BatchResult(path, batch_date, rows, tuple(losses.counts()), losses.rows_seen() in (None, rows))


def run_job(
    spark: SparkSession,
    job: Mapping,
    layers: Layers,
    step: str,
    batch_date: str | None = None,
    incremental: str = "true",
    credentials: Credentials | None = None,
    transform_mode: str = CHAIN,
    stale: str = NEWEST_WINS,
) -> str | BatchResult:
    """Run one step of a job from its run arguments, given as text: ``raw``, or else trusted.

    Returns what the step does: the raw path, or the result of the trusted step.
    """
    batch_date = parse_batch_date(batch_date)
    if step == "raw":
        return run_raw(spark, job, layers, batch_date, parse_incremental(incremental), credentials)
    return run_trusted(spark, job, layers, batch_date, transform_mode, stale)
