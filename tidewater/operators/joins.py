"""Join helpers: broadcast only behind a size check.

An explicit ``broadcast()`` hint overrides Spark's own size test, so it is
only put on a side whose optimizer estimate, inflated for Parquet
decompression, is under a limit.  Past the limit the hint is left off and the
planner picks a sort-merge join, which AQE may still turn into a broadcast at
run time from measured shuffle sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# compressed Parquet bytes -> in-memory row bytes; a deliberately high factor
INFLATION = 8
DEFAULT_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (None when it cannot be read)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # noqa: BLE001 - not available (e.g. Spark Connect)
        return None
    # Py4J hands a Scala BigInt over as a Python int; keep a fallback for a proxy
    return int(size) if isinstance(size, int) else int(size.toString())


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    limit = limit_bytes or DEFAULT_LIMIT
    est = estimated_bytes(df)
    if est is not None and est * INFLATION <= limit:
        return F.broadcast(df)
    return df
