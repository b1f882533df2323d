"""Several jobs at once, each on its own: one that fails or takes too long stops no other."""

from __future__ import annotations

import logging
import time
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Event
from uuid import uuid4

from pyspark.sql import SparkSession

from stratalake.layers import Layers
from stratalake.operators.transforms import CHAIN
from stratalake.plans.jobs import parse_batch_date
from stratalake.plans.steps import BatchResult, run_job
from stratalake.sinks.upsert import NEWEST_WINS
from stratalake.sources.jdbc import Credentials

_log = logging.getLogger(__name__)

# How often, in seconds, jobs that shall end are looked at.
_TICK = 0.2


class Stopped(RuntimeError):
    """A job was ended from outside: it took too long, or its caller gave up."""


@dataclass(frozen=True)
class JobOutcome:
    """What became of a job: what its steps returned, in order, and the error that ended it, if one did."""

    job_name: str
    results: tuple[str | BatchResult, ...]
    error: Exception | None
    seconds: float


def run_jobs(
    spark: SparkSession,
    jobs: Sequence[Mapping],
    layers: Layers,
    batch_date: str | None = None,
    steps: Sequence[str] = ("raw", "trusted"),
    at_once: int = 4,
    job_seconds: float | None = None,
    incremental: str = "true",
    credentials: Credentials | None = None,
    transform_mode: str = CHAIN,
    stale: str = NEWEST_WINS,
) -> list[JobOutcome]:
    """Run the steps of each job, ``at_once`` jobs side by side; one outcome for each, in their order.

    A job's Spark jobs carry a tag of its own and run in a scheduler pool of its name, so that jobs share the
    cluster evenly where ``spark.scheduler.mode`` is FAIR. A job whose step fails takes no further
    step and what it left running is cancelled by the tag, as that of a job that has run for ``job_seconds`` is;
    the others go on. All are cancelled if the caller is interrupted.

    Jobs need names of their own, and paths: two that write one dataset are refused before any begins.
    """
    if at_once < 1:
        raise ValueError(f"one job at once is the least, not {at_once!r}")
    batch_date = parse_batch_date(batch_date)
    for what, found in (("name", [j["job_name"] for j in jobs]), ("path", [j["destination"]["path"].strip("/") for j in jobs])):
        twice = sorted(value for value, n in Counter(found).items() if n > 1)
        if twice:
            raise ValueError(f"several jobs have the {what} {twice}")

    def work(run: _Run) -> JobOutcome:
        for step in steps:
            run.take(lambda: run_job(spark, run.job, layers, step, batch_date, incremental, credentials, transform_mode, stale))
        return run.outcome()

    runs = [_Run(spark, job) for job in jobs]
    with ThreadPoolExecutor(at_once, thread_name_prefix="job") as threads:
        started = [threads.submit(run.within, work) for run in runs]
        waiting = set(started)
        try:
            while waiting:
                _, waiting = wait(waiting, timeout=None if job_seconds is None else _TICK, return_when=FIRST_COMPLETED)
                for run in runs:
                    if job_seconds is not None and run.seconds() > job_seconds:
                        run.stop(f"job {run.name!r} took more than {job_seconds} seconds")
        except BaseException:
            while waiting:
                for run in runs:
                    run.stop("the caller gave up")
                _, waiting = wait(waiting, timeout=_TICK)
            raise
    return [future.result() for future in started]


class _Run:
    """A job on its way. Its Spark jobs are started by one thread, and stopped by another."""

    def __init__(self, spark: SparkSession, job: Mapping):
        self.context, self.job, self.name = spark.sparkContext, job, job["job_name"]
        self.tag = f"stratalake-{uuid4().hex}"
        self.results: list[str | BatchResult] = []
        self.began: float | None = None
        self.ended: float | None = None
        self.why: str | None = None
        self.stopping = Event()

    def seconds(self) -> float:
        """How long it has run; 0 before it begins."""
        return 0.0 if self.began is None else (self.ended or time.monotonic()) - self.began

    def within(self, work: Callable[[_Run], JobOutcome]) -> JobOutcome:
        """Do the work in this thread, under the job's tag and in its pool; threads serve several jobs."""
        self.began = time.monotonic()
        self.context.addJobTag(self.tag)
        self.context.setLocalProperty("spark.scheduler.pool", self.name)
        try:
            return work(self)
        except Exception as error:
            if self.stopping.is_set():
                error = Stopped(self.why)
            _log.warning("job %s ended: %s", self.name, error)
            return self.outcome(error)
        finally:
            self.ended = self.ended or time.monotonic()
            self.context.cancelJobsWithTag(self.tag)
            self.context.removeJobTag(self.tag)
            self.context.setLocalProperty("spark.scheduler.pool", None)

    def take(self, step: Callable[[], str | BatchResult]) -> None:
        if self.stopping.is_set():
            raise Stopped(self.why)
        self.results.append(step())

    def outcome(self, error: Exception | None = None) -> JobOutcome:
        self.ended = time.monotonic()
        return JobOutcome(self.name, tuple(self.results), error, self.seconds())

    def stop(self, why: str) -> None:
        """Take no further step, and cancel what runs; asked again until the job has ended, as a step starts several."""
        if self.ended is None:
            self.why = self.why or why
            self.stopping.set()
            self.context.cancelJobsWithTag(self.tag)
