"""Command-line entry points for ``spark-submit``.

    spark-submit ... -m txlake batch --csv s3a://landing/tx.csv --lake s3a://lake/tx
    spark-submit ... -m txlake stream --kafka broker:9092 --topic tx \
        --sink s3a://lake/stream --checkpoint s3a://lake/_ckpt/stream
    spark-submit ... -m txlake stream --landing s3a://landing/events/ ...

The session comes from the submit configuration (cluster, object store,
connectors); only the recommended SQL settings are applied on top.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from txlake.session import RECOMMENDED_CONF


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("txlake").getOrCreate()
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict | None:
    parser = argparse.ArgumentParser(prog="txlake")
    sub = parser.add_subparsers(dest="command", required=True)

    batch = sub.add_parser("batch", help="CSV export -> raw zone -> clean -> star schema")
    batch.add_argument("--csv", required=True)
    batch.add_argument("--lake", required=True)
    batch.add_argument("--keep", choices=["min", "any"], default="min")
    batch.add_argument("--dedup-strategy", choices=["shuffle", "split"], default="shuffle")
    batch.add_argument("--keep-invalid", action="store_true", help="do not split off rows that break a NOT NULL rule")
    batch.add_argument("--week-start", choices=["monday", "sunday"], default="monday")

    stream = sub.add_parser("stream", help="events -> Parquet lake, exactly once")
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--landing", help="folder of JSON-lines files")
    stream.add_argument("--topic")
    stream.add_argument("--sink", required=True)
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--trigger", default="10 seconds")
    stream.add_argument("--partition-by", nargs="*", help="sink partition columns")
    stream.add_argument("--corrupt-column", help="keep the text of payloads that do not parse")
    stream.add_argument("--event-time-column", help="add the event time as a timestamp")
    stream.add_argument("--max-offsets-per-trigger", type=int)
    stream.add_argument("--timeout", type=float, help="seconds; none by default")
    stream.add_argument("--available-now", action="store_true", help="drain what is there, then stop")

    args = parser.parse_args(argv)
    spark = spark or _session()

    if args.command == "batch":
        from txlake.plans import run_batch

        res = run_batch(spark, args.csv, args.lake, keep=args.keep, week_start=args.week_start, dedup_strategy=args.dedup_strategy, split_rejects=not args.keep_invalid)
        summary = {
            "raw_rows": res.raw_rows,
            "clean_rows": res.clean_rows,
            "fact_rows": res.fact_rows,
            "reject_rows": res.reject_rows,
            "dim_rows": res.dim_rows,
        }
        print(json.dumps(summary))
        return summary

    from txlake.sources import kafka_stream, text_stream
    from txlake.streaming import run_available, run_stream

    if args.kafka:
        if not args.topic:
            parser.error("--kafka needs --topic")
        messages = kafka_stream(spark, args.kafka, args.topic, max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        messages = text_stream(spark, args.landing)
    options = {
        "partition_by": args.partition_by,
        "corrupt_column": args.corrupt_column,
        "event_time_column": args.event_time_column,
    }
    if args.available_now:
        run_available(messages, args.sink, args.checkpoint, timeout_s=args.timeout, **options)
    else:
        run_stream(messages, args.sink, args.checkpoint, processing_time=args.trigger, timeout_s=args.timeout, **options)
    return None


if __name__ == "__main__":
    main()
