"""Broadcast only behind a proven size bound, decided while planning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Estimated bytes that a lookup side may have and still be shipped to every task.
DEFAULT_MAX_BYTES = 32 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``: file sizes carried through the plan; no job runs.

    Joins without statistics multiply the sizes of their sides and filters do
    not shrink them, so the estimate errs on the large side.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_bounded(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    return estimated_bytes(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if it is estimated at no more than ``max_bytes``, else ``df`` unchanged.

    A side that grows with the data falls back to the shuffle join that
    Catalyst and AQE choose instead of overflowing driver and executor memory.
    """
    return F.broadcast(df) if is_bounded(df, max_bytes) else df
