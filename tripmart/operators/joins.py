"""Join helpers.  No broadcast is forced: the planner broadcasts a side below
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution decides again
on measured sizes, splitting hot keys otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# A batch counts as small below this estimate; that picks between two plans
# with the same rows.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer estimate of the plan's output size (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - estimate unavailable
        return -1


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right`` (JN-7).  Null keys
    never match, so they are kept, as with SQL ``NOT EXISTS`` on equality."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def semi_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right.select(*keys), list(keys), "left_semi")


def is_bounded(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    size = estimated_bytes(df)
    return 0 <= size <= limit_bytes
