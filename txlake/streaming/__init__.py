"""Structured Streaming: broker messages -> parsed events -> Parquet lake."""

from txlake.streaming.events import parse_events, stamp_ingestion
from txlake.streaming.lake import landing_plan, run_available, run_stream, start_stream_to_lake

__all__ = ["landing_plan", "parse_events", "run_available", "run_stream", "stamp_ingestion", "start_stream_to_lake"]
