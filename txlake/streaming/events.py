"""Parsing broker messages into transaction events.

Permissive JSON parsing keeps every message: a malformed, empty or null
payload becomes a row of nulls (optionally with the raw text in a corrupt-record
column), a wrong-typed field nulls only that field, unknown fields are ignored.
The same plan runs on a streaming or a batch frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txlake.schemas import EVENT_SCHEMA


#: Layout of the event time (fixed).
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def parse_events(
    messages: DataFrame,
    schema: StructType = EVENT_SCHEMA,
    corrupt_column: str | None = None,
    event_time_column: str | None = None,
) -> DataFrame:
    """``value`` (binary or text JSON) -> one flat column per event field.

    ``corrupt_column`` holds the text of payloads that did not parse;
    ``event_time_column`` the event time as a timestamp, null if it is not one."""
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        schema = StructType(schema.fields + [StructField(corrupt_column, StringType(), True)])
        options["columnNameOfCorruptRecord"] = corrupt_column
    event = F.from_json(F.col("value").cast("string"), schema, options)
    fields = messages.select(event.alias("_event")).select(*[F.col("_event")[f.name].alias(f.name) for f in schema.fields])
    if event_time_column is None:
        return fields
    return fields.withColumn(event_time_column, F.try_to_timestamp("event_timestamp", F.lit(EVENT_TIME_FORMAT)))


def stamp_ingestion(events: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Processing-time stamp (one value per micro-batch)."""
    return events.withColumn(column, F.current_timestamp())
