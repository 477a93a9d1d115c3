"""Streams with bounded state: repeated events, late events, hourly windows.

State is kept for ``delay`` beyond the newest event time and then dropped, so it grows
with the events of that span, not with the stream.  Rows older than the watermark are
not lost: ``split_late`` style accounting is the engine's own, read from the query's
progress by ``late_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlake.streaming.events import parse_events

EVENT_TIME = "event_time"


def timed_events(messages: DataFrame) -> DataFrame:
    """Parsed events with their time as a timestamp; those without one can have no
    watermark and are left out (count them on a landed table)."""
    return parse_events(messages, event_time_column=EVENT_TIME).where(F.col(EVENT_TIME).isNotNull())


def dedup_events(messages: DataFrame, delay: str = "1 hour", key: str = "transaction_id") -> DataFrame:
    """Each event once: repeats of a key within ``delay`` of the first are dropped."""
    return timed_events(messages).withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark([key])


def windowed_by_region(messages: DataFrame, delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """(window_start, region, n_events, sum_price_cents): a window is emitted once,
    after the watermark has passed its end."""
    events = timed_events(messages).withWatermark(EVENT_TIME, delay)
    # cents add up exactly; each event is rounded on its own
    cents = F.round(F.col("price_mad") * 100).cast("long")
    return (
        events.groupBy(F.window(EVENT_TIME, width).alias("w"), "region")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(cents).alias("sum_price_cents"))
        .select(F.col("w.start").alias("window_start"), "region", "n_events", "sum_price_cents")
    )


def start_to_parquet(
    frame: DataFrame, path: str, checkpoint: str, available_now: bool = False, processing_time: str = "10 seconds"
) -> StreamingQuery:
    """Append the rows of a streaming frame to Parquet."""
    writer = frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def drain(frame: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what the source holds now and return the ended query."""
    query = start_to_parquet(frame, path, checkpoint, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, over the kept progress."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def state_rows(query: StreamingQuery) -> int:
    """Keys in the state store after the last micro-batch."""
    last = query.lastProgress
    return sum(op.numRowsTotal for op in last.stateOperators) if last else 0
