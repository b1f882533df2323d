"""Bringing rows together by partition before a write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stratalake.functions.names import quoted


def gather(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of a partition in few tasks, so that each task does not leave a file in each partition.

    Spark spreads a large partition over several tasks and puts small ones together, so a
    partition that holds most of the rows is no single task's work.
    """
    return df.hint("rebalance", *map(quoted, partitions)) if partitions else df
