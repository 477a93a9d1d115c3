"""File sources and sinks: the CSV export, the Parquet raw zone, lake tables.

* CSV is read with a declared all-text schema and a header row; quoted fields
  (prices such as "1,250,000") are honoured, an embedded quote is a doubled
  quote (as standard CSV writers produce), and an empty field reads as null.
  A CSV scan is row-at-a-time, so a pipeline scans it exactly once into the
  Parquet raw zone and works from there (vectorized, column-pruned,
  predicate push-down).
* The raw zone is a full overwrite of unmodified values, so a rerun replaces it.
* ``materialize`` writes an intermediate table into the shared folder named by
  ``spark.checkpoint.dir`` and reads it back: lineage is cut, the result is
  deterministic under executor loss, and later scans read only the columns
  they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txlake.schemas import RAW_SCHEMA
from txlake.session import shared_dir


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema=RAW_SCHEMA,
    header: bool = True,
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Scan a raw export: every column text, nothing inferred.

    A header row must name the columns in the schema's order, else the scan
    fails.  ``corrupt_column`` holds the text of rows with too few or too many
    fields (null for good rows).  ``multi_line`` reads line breaks inside quoted
    fields; such files cannot be split, so it is off by default."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE").option("multiLine", multi_line)
    reader = reader.option("escape", '"')  # standard CSV: an embedded quote is doubled
    reader = reader.option("enforceSchema", False)  # check the header against the schema
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(path)


def malformed_rows(spark: SparkSession, path: str, **options) -> DataFrame:
    """(n_rows, n_malformed) of an export.  The export is scanned once, into a
    table of the shared folder (Spark counts corrupt records of saved rows only)."""
    rows = materialize(read_raw_csv(spark, path, corrupt_column="_malformed", **options), "csv_rows")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count("_malformed").alias("n_malformed"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a CSV export with a header (standard quoting of embedded commas);
    blanks at the ends of values are kept."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_raw_zone(raw: DataFrame, path: str) -> None:
    """Raw zone: the values exactly as received, as Parquet, full overwrite."""
    raw.write.mode("overwrite").parquet(path)


def read_raw_zone(spark: SparkSession, path: str) -> DataFrame:
    """Raw replay: the raw zone is the input for re-cleaning, no re-extract."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    max_records_per_file: int | None = None,
) -> None:
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, if it is there."""
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``; the old one is set aside
    first and deleted last."""
    (new, files), (old, _) = _folder(spark, source), _folder(spark, target)
    aside, _ = _folder(spark, target.rstrip("/") + "_replaced")
    files.delete(aside, True)
    files.mkdirs(old.getParent())
    if files.exists(old) and not files.rename(old, aside):
        raise OSError(f"could not set {target} aside")
    if not files.rename(new, old):
        files.rename(aside, old)
        raise OSError(f"could not rename {source} to {target}")
    files.delete(aside, True)


def materialize(df: DataFrame, name: str, observation: Observation | None = None, *metrics: Column) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint dir, read it back.

    ``observation`` with ``metrics`` collects aggregates (counts, ...) during
    the same write, without a second pass.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    if observation is not None:
        df = df.observe(observation, *metrics)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
