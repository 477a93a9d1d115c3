"""Stream events into the lake: parse, stamp, append Parquet, exactly once.

The checkpoint records which source offsets (or files) each micro-batch
covered, and the file sink's own log records committed batches, so a stop and
restart on the same checkpoint neither loses nor repeats an event.  The query is
stateless (no aggregation, no watermark), so it scales with the source's
partitions and has no state store to grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from txlake.streaming.events import parse_events, stamp_ingestion


def landing_plan(
    messages: DataFrame, corrupt_column: str | None = None, event_time_column: str | None = None
) -> DataFrame:
    events = parse_events(messages, corrupt_column=corrupt_column, event_time_column=event_time_column)
    return stamp_ingestion(events)


def start_stream_to_lake(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    processing_time: str | None = "10 seconds",
    available_now: bool = False,
    query_name: str | None = None,
    partition_by: list[str] | None = None,
    corrupt_column: str | None = None,
    event_time_column: str | None = None,
) -> StreamingQuery:
    """Start the landing query.  ``available_now`` processes what the source
    holds and stops (tests, backfills); otherwise a processing-time trigger.
    ``partition_by`` (e.g. ``["transaction_date"]``) lays the sink out in
    folders that later scans can prune; by default the sink is flat.
    ``corrupt_column`` keeps the text of payloads that did not parse;
    ``event_time_column`` adds the event time as a timestamp."""
    writer = (
        landing_plan(messages, corrupt_column, event_time_column)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(messages: DataFrame, path: str, checkpoint: str, timeout_s: float | None = None, **options) -> None:
    """Drain everything the source holds now, then stop.  There is no time limit
    unless ``timeout_s`` sets one; ``options`` go to ``start_stream_to_lake``."""
    q = start_stream_to_lake(messages, path, checkpoint, available_now=True, **options)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream to {path} did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def run_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    processing_time: str = "10 seconds",
    timeout_s: float | None = None,
    **options,
) -> StreamingQuery:
    """Run the landing query until it is stopped (or ``timeout_s`` passes).

    The first start reads from the source's starting position; every restart
    on the same checkpoint resumes after the last committed micro-batch.
    """
    q = start_stream_to_lake(messages, path, checkpoint, processing_time=processing_time, **options)
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    return q
