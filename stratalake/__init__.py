"""Config-driven movement of tables through the layers of a data lake, on Spark."""

from stratalake.operators.incremental import incremental_filter
from stratalake.operators.latest import latest_per_key
from stratalake.operators.transforms import apply_transforms, register_transform
from stratalake.plans.jobs import get_job, load_jobs, parse_batch_date, parse_incremental, validate_job
from stratalake.plans.steps import BatchResult, run_job, run_raw, run_trusted
from stratalake.plans.together import JobOutcome, run_jobs
from stratalake.sinks.raw import save_raw
from stratalake.sinks.trusted import save_trusted
from stratalake.sinks.upsert import upsert
from stratalake.sources import read_source, register_reader, register_source
from stratalake.sources.batches import read_batch

__all__ = [
    "BatchResult",
    "JobOutcome",
    "apply_transforms",
    "get_job",
    "incremental_filter",
    "latest_per_key",
    "load_jobs",
    "parse_batch_date",
    "parse_incremental",
    "read_batch",
    "read_source",
    "register_reader",
    "register_source",
    "register_transform",
    "run_job",
    "run_jobs",
    "run_raw",
    "run_trusted",
    "save_raw",
    "save_trusted",
    "upsert",
    "validate_job",
]
