"""Unbounded sources that yield a broker-style ``value`` column.

``kafka_stream`` is the production source: one topic, read from the earliest
offset on the first start (afterwards the checkpoint decides where to resume).
The Kafka connector jar is not bundled here; it is a cluster dependency.
``text_stream`` reads newline-delimited messages from a folder and yields the
same ``value`` column, so the downstream plan is identical -- it is the
stand-in the tests drive, and a valid landing-folder source in its own right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    try:
        return reader.load()
    except Exception as ex:
        if "kafka" in str(ex).lower() and "data source" in str(ex).lower():
            raise RuntimeError(
                "the Kafka source is not on this cluster's classpath; add the "
                "spark-sql-kafka connector package matching the Spark version"
            ) from ex
        raise


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
