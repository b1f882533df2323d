"""Job descriptions: loading, lookup and checks that need no data."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from stratalake.operators.incremental import COMPARISONS
from stratalake.operators.transforms import require_parameters, transform_named
from stratalake.sinks.trusted import INGEST_TYPES, UPSERT, as_list
from stratalake.sources import require_reader

_DATE_FORMAT = "%Y%m%d"


def load_jobs(spark: SparkSession, path: str) -> list[dict]:
    """Read JSON arrays of jobs from any file system Spark can read.

    ``path`` is a file, or a folder or pattern of several, whose jobs follow each other in
    the order of the files' names. A name that two jobs have is an error.
    """
    files = spark.read.text(path, wholetext=True).select("_metadata.file_path", "value").collect()
    jobs = []
    for file, text in sorted(files) or [(path, None)]:
        try:
            found = json.loads(text) if text else None
        except json.JSONDecodeError as error:
            raise ValueError(f"{file} is not JSON: {error}") from None
        if not isinstance(found, list):
            raise ValueError(f"{file} must hold a JSON array of jobs")
        jobs += found
    if len(files) > 1:
        names = Counter(job["job_name"] for job in jobs)
        twice = sorted(name for name, n in names.items() if n > 1)
        if twice:
            raise ValueError(f"{path} has several jobs named {twice}")
    return jobs


def require_whole(days: object) -> int:
    """The number of days of a condition."""
    try:
        return int(days)
    except (TypeError, ValueError):
        raise ValueError(f"days must be a whole number, not {days!r}") from None


def get_job(jobs: Sequence[Mapping], name: str) -> Mapping:
    """The first job called ``name``."""
    for job in jobs:
        if job["job_name"] == name:
            return job
    raise ValueError(f"no job named {name!r}")


def parse_batch_date(text: str | None = None) -> str:
    """A batch date as yyyyMMdd; today if none is given."""
    if text is None:
        return datetime.now().strftime(_DATE_FORMAT)
    return datetime.strptime(text, _DATE_FORMAT).strftime(_DATE_FORMAT)


def parse_incremental(text: str) -> bool:
    """Incremental unless the argument says false."""
    return text.upper() != "FALSE"


def validate_job(job: Mapping) -> None:
    """Fail on a job that could not run, before anything is read."""
    require_reader(job["source"]["type"])
    for condition in job["source"].get("conditions", []):
        if condition["compare"] not in COMPARISONS:
            raise ValueError(f"compare must be one of {list(COMPARISONS)}, not {condition['compare']!r}")
        require_whole(condition["days"])
    destination = job["destination"]
    for layer in ("raw", "trusted"):
        if "database" in destination.get(layer, {}) and "table_name" not in destination:
            raise ValueError(f"{layer} has a database, so the destination needs a table_name")
    trusted = destination.get("trusted")
    if trusted is None:
        return
    if trusted["ingest_type"] not in INGEST_TYPES:
        raise ValueError(f"ingest type must be one of {INGEST_TYPES}, not {trusted['ingest_type']!r}")
    if trusted["ingest_type"] == UPSERT:
        for field in ("key_column", "order_column"):
            if not as_list(trusted.get(field, [])):
                raise ValueError(f"an Upsert needs {field}")
    for entry in trusted.get("transformations", []):
        transform_named(entry["name"])
        require_parameters(entry["name"], entry["parameters"])
