"""Join helpers: broadcast only a side whose size is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side (bytes, by the plan's statistics) that is marked for broadcast.
# Beyond it the join is left to the planner: sort-merge or shuffle-hash, or an
# AQE broadcast once the side's real size has been measured.
MAX_BROADCAST_BYTES = 32 << 20


def plan_bytes(df: DataFrame) -> int:
    """Size estimate of the optimised plan: file sizes through projections and
    filters; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``dim`` marked for broadcast if its plan is estimated at ``max_bytes`` or
    less.  Streaming frames are returned unchanged."""
    if dim.isStreaming or plan_bytes(dim) > max_bytes:
        return dim
    return F.broadcast(dim)
