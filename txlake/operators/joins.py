"""Size-checked broadcast.

A side is broadcast only after its row count and its bytes are known to be
within bounds; beyond either the join is left to a shuffle join, where AQE's
skew-join handling splits oversized partitions of the large side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and bytes that may be broadcast to every executor.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 100 << 20


def row_bytes(columns: list[str]) -> Column:
    """Bytes of a row: its values as text, and 16 for each column."""
    parts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in columns]
    return reduce(lambda a, b: a + b, parts).cast("long")


def checked_broadcast(
    df: DataFrame,
    rows: int | None = None,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    size: int | None = None,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast hint when ``df`` is proven small, else ``df`` unchanged.

    ``rows`` and ``size`` are known row and byte counts (or upper bounds); what
    is not given is measured by one distributed aggregation (per-task partials,
    one row per task shuffled), never by a limit that funnels rows into one task.
    """
    if rows is None or size is None:
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df.columns)).alias("b")).first()
        rows, size = (r["n"] if rows is None else rows), (int(r["b"] or 0) if size is None else size)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
