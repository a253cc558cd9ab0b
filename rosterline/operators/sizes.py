"""Broadcasts that depend on a size that was looked at."""

from __future__ import annotations

from pyspark.sql import DataFrame

BROADCAST_BYTES = 16 << 20  # of the estimate, which comes from compressed files: in memory a table is several times that


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if the planner's estimate of its size is at most so many bytes; beyond that the planner and
    the runtime choose. The estimate comes from the sizes of files, so nothing is read or computed for it.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.hint("broadcast") if int(size) <= most else df
