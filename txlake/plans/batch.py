"""The batch pipeline: export -> raw zone -> clean -> dimensions -> fact.

Plan shape, per stage:

1. The CSV export is scanned exactly once, straight into the Parquet raw zone
   (the row count is taken on the way with an ``Observation``, no extra scan).
2. Everything after reads the raw zone: vectorized, column-pruned Parquet.
   Re-cleaning from the raw zone without re-extracting is the same code path
   (``raw_replay``).
3. The clean table is written to the lake once.  Dimensions and fact read it
   back, so the dedup runs once, lineage is cut, and a lost executor
   recomputes from files rather than from the whole pipeline.  On a large
   input the dedup shuffles only the key column and the rows whose key
   repeats (``dedup_by_key``).
4. All four dimensions come from one grouping-sets aggregation over the clean
   table (one scan, one pre-aggregated shuffle); their member counts are
   observed during that write and decide whether each is broadcast into the
   fact build.  Each is keyed 1..n and written.
5. The fact build is a map-only pipeline over the clean table: four broadcast
   hash joins and a projection -- the fact is never shuffled.

Tables are written with ``overwrite`` so a rerun replaces a load instead of
tripping over the keys of the previous one.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlake.operators import Dimension, Dimensions, build_dimensions, build_fact, clean_transactions
from txlake.operators.dimensions import SINGLE_TASK_ROWS
from txlake.operators.fact import YEAR_COLUMN, broken_rules
from txlake.operators.joins import row_bytes
from txlake.schemas import FACT_COLUMNS
from txlake.session import scratch_tables, size_session
from txlake.sources import (
    materialize,
    read_raw_csv,
    read_raw_zone,
    read_table,
    write_jdbc,
    write_table,
)
from txlake.sources.files import delete_path, path_exists, replace_path

#: Column of the raw tables with the text of a malformed row.
MALFORMED_TEXT = "malformed_text"


@dataclass
class StarSchema:
    raw: DataFrame | None
    clean: DataFrame | None
    dims: Dimensions
    fact: DataFrame


def build_star(raw: DataFrame, keep: str = "min", week_start: str = "monday", persist_clean: bool = True) -> StarSchema:
    """Clean, dimension and fact frames from a raw frame.

    With ``persist_clean`` the clean table is written once into the shared
    folder and read back before the dimensions and fact are derived from it.
    The keyed dimensions are written once, so no consumer numbers them again.
    """
    clean = clean_transactions(raw, keep=keep)
    if persist_clean:
        clean = materialize(clean, "clean")
    dims = build_dimensions(clean, week_start=week_start, store=True)
    return StarSchema(raw=raw, clean=clean, dims=dims, fact=build_fact(clean, dims))


@dataclass
class BatchResult:
    raw_rows: int
    clean_rows: int
    fact_rows: int
    reject_rows: int
    dim_rows: dict[str, int]
    paths: dict[str, str]
    malformed_rows: int = 0


TABLES = (
    "raw",
    "raw_malformed",
    "clean",
    "dim_date",
    "dim_property_type",
    "dim_location",
    "dim_registration_status",
    "fact_transactions",
    "fact_rejects",
)


def run_batch(
    spark: SparkSession,
    csv_path: str,
    lake_root: str,
    keep: str = "min",
    week_start: str = "monday",
    max_records_per_file: int = 5_000_000,
    dedup_strategy: str = "shuffle",
    split_rejects: bool = True,
    divert_malformed: bool = True,
    **csv_options,
) -> BatchResult:
    """Run the whole batch load into ``lake_root`` and return the stage counts.

    Partition sizes follow the bytes of the export.  All tables are written to a
    folder of this load and take the place of the old ones at the end, so a load that
    fails leaves the tables as they were.  Rows of the export with too few or too many
    fields go to ``raw_malformed`` with their text (``divert_malformed=False`` keeps
    them, missing fields null).  With ``split_rejects`` the fact rows that break a
    NOT NULL rule go to ``fact_rejects`` with the rules' names, else they stay in the
    fact.  ``csv_options`` go to ``read_raw_csv``."""
    size_session(spark, csv_path)
    root = lake_root.rstrip("/")
    load = f"{root}/_load/{uuid.uuid4().hex}"
    try:
        with scratch_tables(spark):
            result = _load_tables(
                spark, csv_path, load, keep, week_start, max_records_per_file, dedup_strategy, split_rejects, divert_malformed, csv_options
            )
        if not result.raw_rows:
            raise ValueError(f"no rows in {csv_path}; the tables under {root} are unchanged")
        for name in TABLES:
            if path_exists(spark, f"{load}/{name}"):
                replace_path(spark, f"{load}/{name}", f"{root}/{name}")
            else:  # a table of the load before, without rows in this one
                delete_path(spark, f"{root}/{name}")
    finally:
        delete_path(spark, load)
    result.paths = {name: f"{root}/{name}" for name in TABLES}
    return result


def _load_tables(
    spark, csv_path, load, keep, week_start, max_records_per_file, dedup_strategy, split_rejects, divert_malformed, csv_options
) -> BatchResult:
    paths = {name: f"{load}/{name}" for name in TABLES}
    counted = F.count(F.lit(1)).alias("rows")
    raw_obs = Observation()
    scanned = read_raw_csv(spark, csv_path, corrupt_column=MALFORMED_TEXT, **csv_options)
    # one scan: good and malformed rows side by side, read apart by folder
    bad = F.col(MALFORMED_TEXT).isNotNull()
    tagged = scanned.withColumn("malformed", bad if divert_malformed else F.lit(False))
    write_table(tagged.observe(raw_obs, counted, F.count_if(bad).alias("bad")), f"{load}/scan", partition_by=["malformed"])
    raw_rows, malformed = raw_obs.get["rows"], raw_obs.get["bad"]
    diverted = malformed if divert_malformed else 0
    if raw_rows == diverted:
        return BatchResult(0, 0, 0, 0, {}, paths, malformed)
    replace_path(spark, f"{load}/scan/malformed=false", paths["raw"])
    if diverted:
        replace_path(spark, f"{load}/scan/malformed=true", paths["raw_malformed"])
    raw = read_raw_zone(spark, paths["raw"])

    clean_obs = Observation()
    write_table(
        clean_transactions(raw, keep=keep, dedup_strategy=dedup_strategy).observe(clean_obs, counted),
        paths["clean"],
        max_records_per_file=max_records_per_file,
    )
    clean = read_table(spark, paths["clean"])

    built = build_dimensions(clean, week_start=week_start)
    stored = {}
    for name, dim in built.named().items():
        # a small dimension is one file; an oversized one keeps its partitions
        write_table(dim.df.coalesce(1) if dim.rows <= SINGLE_TASK_ROWS else dim.df, paths[name])
        stored[name] = Dimension(read_table(spark, paths[name]), dim.rows, dim.size)
    dims = Dimensions(**{name.removeprefix("dim_"): dim for name, dim in stored.items()})

    # the joins run once: rows of a year are brought together, a year is few files
    fact = build_fact(clean, dims, with_year=True)
    by_year = {"partition_by": [YEAR_COLUMN], "max_records_per_file": max_records_per_file}
    if not split_rejects:
        fact_obs = Observation()
        write_table(_by_year(fact.observe(fact_obs, counted)), paths["fact_transactions"], **by_year)
        return BatchResult(raw_rows, clean_obs.get["rows"], fact_obs.get["rows"], 0, {n: d.rows for n, d in stored.items()}, paths, malformed)
    fact_obs = Observation()
    tagged = broken_rules(fact).observe(fact_obs, counted, F.count_if(F.col("broken_rules") != "").alias("broken"))
    held = materialize(tagged, "fact_tagged")
    write_table(_by_year(held.where("broken_rules = ''").drop("broken_rules")), paths["fact_transactions"], **by_year)
    write_table(_by_year(held.where("broken_rules <> ''")), paths["fact_rejects"], **by_year)
    rejected = fact_obs.get["broken"]
    return BatchResult(
        raw_rows=raw_rows,
        clean_rows=clean_obs.get["rows"],
        fact_rows=fact_obs.get["rows"] - rejected,
        reject_rows=rejected,
        dim_rows={name: d.rows for name, d in stored.items()},
        paths=paths,
        malformed_rows=malformed,
    )


def _by_year(fact: DataFrame) -> DataFrame:
    return fact.hint("rebalance", YEAR_COLUMN).sortWithinPartitions(YEAR_COLUMN, "date_id")


def load_star(spark: SparkSession, lake_root: str, fact: DataFrame | None = None) -> StarSchema:
    """Open a star written by ``run_batch`` (dimension sizes are re-counted).  A star
    that a stream writes has no raw and clean tables: pass its ``fact``."""
    root = lake_root.rstrip("/")
    names = ["dim_date", "dim_property_type", "dim_location", "dim_registration_status"]
    tables = {name: read_table(spark, f"{root}/{name}") for name in names}
    # all four sizes in one job (four rows to the driver)
    counted = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df.columns)).alias("b")).select(F.lit(name).alias("t"), "n", "b")
            for name, df in tables.items()
        ],
    )
    size = {r.t: (r.n, r.b or 0) for r in counted.collect()}
    dims = Dimensions(
        date=Dimension(tables["dim_date"], *size["dim_date"]),
        property_type=Dimension(tables["dim_property_type"], *size["dim_property_type"]),
        location=Dimension(tables["dim_location"], *size["dim_location"]),
        registration_status=Dimension(tables["dim_registration_status"], *size["dim_registration_status"]),
    )
    if fact is not None:
        return StarSchema(raw=None, clean=None, dims=dims, fact=fact)
    return StarSchema(
        raw=read_raw_zone(spark, f"{root}/raw"),
        clean=read_table(spark, f"{root}/clean"),
        dims=dims,
        fact=read_table(spark, f"{root}/fact_transactions"),
    )


def export_to_warehouse(
    star: StarSchema,
    url: str,
    properties: dict[str, str],
    mode: str = "append",
    fact_connections: int = 32,
) -> None:
    """Append the finished star to a relational warehouse over JDBC.

    Keys were assigned in Spark, so every column is written (the database
    does not generate them).  A dimension takes one connection per
    ``SINGLE_TASK_ROWS`` rows; the fact is written by ``fact_connections`` parallel
    connections in batches.  A second append of the same load violates the
    warehouse keys, as a one-shot full load does.

    Pass a star opened with ``load_star``: the tables are then files, so
    limiting the fact to ``fact_connections`` partitions (``coalesce``, no
    shuffle) only limits database connections, not upstream computation.
    """
    by_name = {
        "dim_date": star.dims.date,
        "dim_property_type": star.dims.property_type,
        "dim_location": star.dims.location,
        "dim_registration_status": star.dims.registration_status,
    }
    for name, dim in by_name.items():
        connections = min(fact_connections, -(-max(dim.rows, 1) // SINGLE_TASK_ROWS))
        write_jdbc(dim.df, url, name, properties, mode=mode, num_partitions=connections)
    write_jdbc(star.fact.select(*FACT_COLUMNS), url, "fact_transactions", properties, mode=mode, num_partitions=fact_connections)
