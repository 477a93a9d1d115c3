"""JDBC sink and source for a relational warehouse.

The warehouse load appends only the natural-key columns of each dimension and
lets the database fill its identity keys; the fact build then reads the
dimensions back.  This library assigns surrogate keys in Spark instead (see
``txlake.operators.dimensions``), so the JDBC path is an optional export of
finished tables.  No JDBC driver ships with this repository; the caller adds
one to the cluster and passes the URL and credentials (nothing secret lives in
code).

Scale notes: a write opens one connection per partition, so small dimensions
are coalesced to one partition and the fact is written with ``num_partitions``
connections and a batch size.  A large read is split into ``num_partitions``
range queries on a numeric ``partition_column``; a dimension read is a single
query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    mode: str = "append",
    num_partitions: int | None = None,
    batch_size: int = 10_000,
) -> None:
    out = df.coalesce(num_partitions) if num_partitions else df
    (
        out.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .options(**properties)
        .mode(mode)
        .save()
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()
