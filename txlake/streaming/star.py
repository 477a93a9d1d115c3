"""Stream into the star: micro-batches land as fact rows with dimension keys.

Each micro-batch is one idempotent load.  Its events are cleaned to the warehouse's
types, members that the dimensions lack are keyed and appended, and its facts take the
folder ``batch_id=N`` of the fact table, overwriting what an earlier attempt at the same
batch left there.  So a batch that is run again, after a crash or by a replay, adds
nothing.  Rows that break a NOT NULL rule go to the rejects in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlake.operators import build_fact, dedup_by_key
from txlake.operators.fact import broken_rules
from txlake.schemas import PRICE_TYPE, RAW_COLUMNS, SURFACE_TYPE
from txlake.functions import city_clean, date_parse
from txlake.session import scratch_tables
from txlake.sources import materialize, write_table
from txlake.streaming.events import parse_events

BATCH = "batch_id"


def clean_events(events: DataFrame) -> DataFrame:
    """Parsed events as clean transactions: measures as the warehouse's decimals,
    values that do not fit as nulls, one row per id."""
    typed = events.select(*RAW_COLUMNS).withColumns(
        {
            "surface_m2": F.col("surface_m2").try_cast(SURFACE_TYPE),
            "price_mad": F.col("price_mad").try_cast(PRICE_TYPE),
            "city": city_clean("city"),
            "transaction_date": date_parse("transaction_date"),
        }
    )
    return dedup_by_key(typed, ["transaction_id"])


def load_batch(messages: DataFrame, batch_id: int, lake_root: str) -> None:
    """Land one micro-batch of broker messages under ``lake_root``."""
    from txlake.plans.incremental import extend_dimensions

    spark, root = messages.sparkSession, lake_root.rstrip("/")
    with scratch_tables(spark):
        clean = materialize(clean_events(parse_events(messages)), "stream_clean")
        dims = extend_dimensions(spark, root, clean)
        tagged = materialize(broken_rules(build_fact(clean, dims)), "stream_fact")
        accepted = tagged.where("broken_rules = ''").drop("broken_rules")
        write_table(accepted, f"{root}/fact_stream/{BATCH}={batch_id}")
        write_table(tagged.where("broken_rules <> ''"), f"{root}/fact_stream_rejects/{BATCH}={batch_id}")


def start_stream_to_star(
    messages: DataFrame, lake_root: str, checkpoint: str, available_now: bool = False, processing_time: str = "1 minute"
) -> StreamingQuery:
    """Start the query.  One query writes a star at a time."""

    def land(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, lake_root)

    writer = messages.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def run_available_to_star(messages: DataFrame, lake_root: str, checkpoint: str) -> None:
    """Drain what the source holds now, then stop."""
    query = start_stream_to_star(messages, lake_root, checkpoint, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_facts(spark: SparkSession, lake_root: str) -> DataFrame:
    """The facts landed so far; the batch number is a column to prune by."""
    return spark.read.parquet(f"{lake_root.rstrip('/')}/fact_stream")
