"""Broadcast only what is known to be small, in bytes, without running a job.

Dimension-like inputs (area levels, label lists, variable maps) are bounded by
geography or by the questionnaire, not by the number of people. Still, we do
not trust that: a table read from files (through projections, filters and
renames) is hinted only if the optimiser's size in bytes, which comes from the
file sizes of that very plan, is within the limit. Literal tables have a size
the code fixes. Whatever is derived by a join or an aggregate has no proven
size before it runs: it gets no hint, and AQE broadcasts it if the bytes it
measured allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of files (or the optimiser's estimate of them after column pruning)
# we are willing to ship to every executor for a lookup table.
DEFAULT_MAX_BYTES = 16 << 20


def size_in_bytes(df: DataFrame) -> int:
    """The optimiser's size of ``df`` (plan statistics; no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """True if the optimiser knows ``df`` to be at most ``max_bytes``."""
    return size_in_bytes(df) <= max_bytes


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` if its size in bytes is known to be within the limit, else ``df``."""
    return F.broadcast(df) if fits(df, max_bytes) else df


def literal_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table built from literal rows in code (size fixed by the code)."""
    return F.broadcast(df)
