"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)``, derives its input from the driver's
tables with Spark (``txlake.sources.fixtures``) and runs over all of it.  Some
queries write to the shared folder first (a CSV export, a raw zone, a stream
sink) because writing *is* the operator; they return a frame reading the
result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.functions import date_parts
from txlake.operators import (
    Dimensions,
    avg_price_by_region_type_quarter,
    build_dimensions,
    build_fact,
    clean_transactions,
    constraint_report,
    dedup_by_key,
    dedup_conflicts,
    defect_profile,
    defect_reconciliation,
    flatten,
    missing_surface_by_type,
    null_aware_measures,
    parse_failures,
    split_rejects,
    stage_counts,
    status_breakdown,
    with_surrogate_key,
)
from txlake.plans.batch import StarSchema, build_star
from txlake.schemas import EVENT_COLUMNS
from txlake.operators.fact import YEAR_COLUMN
from txlake.session import shared_dir
from txlake.sources import (
    event_messages,
    malformed_rows,
    raw_transactions,
    raw_transactions_dirty,
    read_table,
    read_raw_csv,
    read_raw_zone,
    write_csv,
    write_raw_zone,
    write_table,
)
from txlake.sources.streams import text_stream
from txlake.streaming import parse_events, run_available

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> StarSchema:
    return build_star(raw_transactions(spark, sf_dir))


# --- sources ----------------------------------------------------------------


def csv_scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the raw table as CSV into the shared folder, scan it back."""
    path = shared_dir(spark, "csv_export")
    write_csv(raw_transactions(spark, sf_dir), path)
    return read_raw_csv(spark, path)


def raw_zone_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV export -> raw zone (Parquet, values unchanged) -> read back."""
    raw_csv = csv_scan_raw(spark, sf_dir)
    path = shared_dir(spark, "raw_zone")
    write_raw_zone(raw_csv, path)
    return read_raw_zone(spark, path)


def raw_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean table rebuilt from the raw zone alone."""
    return clean_transactions(raw_zone_parquet(spark, sf_dir))


# --- cleaning ----------------------------------------------------------------


def dedup_by_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key(raw_transactions(spark, sf_dir), ["transaction_id"])


def dedup_by_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large-input dedup plan (repeated keys broadcast, unique rows not
    shuffled), forced on the whole table so the oracle gate covers it."""
    return dedup_by_key(raw_transactions(spark, sf_dir), ["transaction_id"], strategy="split")


def clean_transactions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(raw_transactions(spark, sf_dir))


def _clean_column(column: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return clean_transactions(raw_transactions(spark, sf_dir)).select("transaction_id", column)

    return q


# --- star schema -------------------------------------------------------------


def _dims(spark: SparkSession, sf_dir: str, week_start: str = "monday") -> Dimensions:
    # the member table is materialized by the build, so a dimension alone
    # needs no persisted clean table: clean feeds the one members pass only
    return build_dimensions(clean_transactions(raw_transactions(spark, sf_dir)), week_start=week_start)


def _dim(attr: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_dims(spark, sf_dir), attr).df

    return q


def dim_date_sunday_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_date with Spark's ``dayofweek`` numbering (Sunday = 1)."""
    return _dims(spark, sf_dir, week_start="sunday").date.df


def dim_date_distributed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_date keyed by the distributed numbering (range partitions plus
    per-partition offsets) that dimensions over the one-task bound use."""
    dim = _dims(spark, sf_dir).date
    members = dim.df.select("full_date")
    keyed = with_surrogate_key(members, "date_id", ["full_date"], rows=dim.rows, single_task_rows=256)
    parts = date_parts(F.col("full_date"), "monday")
    return keyed.select("date_id", "full_date", *[v.alias(name) for name, v in parts.items()])


def fact_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).fact


def fact_transactions_shuffle_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact by four sort-merge joins (the path for dimensions over the
    broadcast bounds), forced by a hint, as Spark would broadcast small ones."""
    s = _star(spark, sf_dir)
    return build_fact(s.clean, s.dims, max_broadcast_rows=0, join_hint="merge")


def star_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return flatten(s.fact, s.dims)


# --- reporting ---------------------------------------------------------------


def avg_price_region_type_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return avg_price_by_region_type_quarter(s.fact, s.dims)


def status_breakdown_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return status_breakdown(s.fact, s.dims)


def null_aware_measures_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return null_aware_measures(s.fact, s.dims)


# --- quality -----------------------------------------------------------------


def stage_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return stage_counts(s.raw, s.clean, s.fact)


def defect_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defect_profile(raw_transactions(spark, sf_dir))


def missing_surface_by_type_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_surface_by_type(raw_transactions(spark, sf_dir))


def parse_failures_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_failures(raw_transactions(spark, sf_dir))


def defect_reconciliation_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defect_reconciliation(raw_transactions(spark, sf_dir))


def constraint_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _star(spark, sf_dir)
    return constraint_report(s.fact, s.dims)


# --- the dirty export ----------------------------------------------------------


def clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_transactions(raw_transactions_dirty(spark, sf_dir))


def _dirty_star(spark: SparkSession, sf_dir: str) -> StarSchema:
    return build_star(raw_transactions_dirty(spark, sf_dir))


def fact_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows that keep every NOT NULL rule."""
    return split_rejects(_dirty_star(spark, sf_dir).fact)[0]


def fact_rejects_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows that break a NOT NULL rule, with the rules."""
    return split_rejects(_dirty_star(spark, sf_dir).fact)[1]


def constraint_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _dirty_star(spark, sf_dir)
    return constraint_report(s.fact, s.dims)


def _dirty_raw(report: Callable[[DataFrame], DataFrame]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(raw_transactions_dirty(spark, sf_dir))

    return q


def dedup_conflicts_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_conflicts(raw_transactions_dirty(spark, sf_dir), ["transaction_id"])


def csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export in which the rows of every 97th order lack their last field."""
    raw = raw_transactions(spark, sf_dir)
    field = lambda c: F.concat(F.lit('"'), F.coalesce(F.col(c), F.lit("")), F.lit('"'))
    broken = F.substring("listing_id", 4, 20).cast("long") % 97 == 0
    lines = F.concat_ws(",", *[field(c) for c in raw.columns[:-1]], F.when(~broken, field(raw.columns[-1])))
    path = shared_dir(spark, "csv_malformed")
    raw.select(lines.alias("value")).write.text(path)
    return malformed_rows(spark, path, header=False)


def avg_price_one_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship for 1997 over a fact stored by year: one folder is read."""
    s = _star(spark, sf_dir)
    path = shared_dir(spark, "fact_by_year")
    write_table(build_fact(s.clean, s.dims, with_year=True), path, partition_by=[YEAR_COLUMN])
    return avg_price_by_region_type_quarter(read_table(spark, path), s.dims, year=1997)


# --- streaming ---------------------------------------------------------------


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-style binary messages parsed with the event schema (batch plan)."""
    messages = event_messages(spark, sf_dir).select(F.col("value").cast("binary").alias("value"))
    return parse_events(messages)


def _landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """Write the event messages as JSON-lines files into a fresh landing folder."""
    path = shared_dir(spark, "landing")
    event_messages(spark, sf_dir).write.mode("overwrite").text(path)
    return path


def stream_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing folder -> parse -> stamp -> Parquet sink (availableNow)."""
    landing = _landing_folder(spark, sf_dir)
    sink = shared_dir(spark, "stream_sink")
    run_available(text_stream(spark, landing), sink, shared_dir(spark, "stream_ckpt"))
    return spark.read.parquet(sink).select(*EVENT_COLUMNS)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: half of the events arrive, then the other
    half, then nothing new -- every event must land exactly once."""
    src = shared_dir(spark, "stream_src")
    sink = shared_dir(spark, "stream_sink")
    ckpt = shared_dir(spark, "stream_ckpt")
    msgs = event_messages(spark, sf_dir)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    msgs.where(half == 0).write.mode("append").text(src)
    run_available(text_stream(spark, src), sink, ckpt)
    msgs.where(half == 1).write.mode("append").text(src)
    run_available(text_stream(spark, src), sink, ckpt)
    run_available(text_stream(spark, src), sink, ckpt)
    return spark.read.parquet(sink).select(*EVENT_COLUMNS)


QUERIES: dict[str, Query] = {
    "csv_scan_raw": csv_scan_raw,
    "raw_zone_parquet": raw_zone_parquet,
    "raw_replay": raw_replay,
    "dedup_by_key": dedup_by_key_q,
    "dedup_by_key_split": dedup_by_key_split,
    "price_clean": _clean_column("price_mad"),
    "surface_clean": _clean_column("surface_m2"),
    "city_clean": _clean_column("city"),
    "date_parse": _clean_column("transaction_date"),
    "clean_transactions": clean_transactions_q,
    "dim_date": _dim("date"),
    "dim_date_sunday_start": dim_date_sunday_start,
    "dim_date_distributed_keys": dim_date_distributed_keys,
    "dim_property_type": _dim("property_type"),
    "dim_location": _dim("location"),
    "dim_registration_status": _dim("registration_status"),
    "fact_transactions": fact_transactions,
    "fact_transactions_shuffle_joins": fact_transactions_shuffle_joins,
    "star_flatten": star_flatten,
    "avg_price_region_type_quarter": avg_price_region_type_quarter,
    "status_breakdown": status_breakdown_q,
    "null_aware_measures": null_aware_measures_q,
    "stage_counts": stage_counts_q,
    "defect_profile": defect_profile_q,
    "missing_surface_by_type": missing_surface_by_type_q,
    "parse_failures": parse_failures_q,
    "defect_reconciliation": defect_reconciliation_q,
    "constraint_report": constraint_report_q,
    "clean_dirty": clean_dirty,
    "fact_dirty": fact_dirty,
    "fact_rejects_dirty": fact_rejects_dirty,
    "constraint_report_dirty": constraint_report_dirty,
    "parse_failures_dirty": _dirty_raw(parse_failures),
    "defect_profile_dirty": _dirty_raw(defect_profile),
    "defect_reconciliation_dirty": _dirty_raw(defect_reconciliation),
    "dedup_conflicts_dirty": dedup_conflicts_dirty,
    "csv_malformed_rows": csv_malformed_rows,
    "avg_price_one_year": avg_price_one_year,
    "stream_parse": stream_parse,
    "stream_to_lake": stream_to_lake,
    "stream_restart": stream_restart,
}

FLAGSHIP = "avg_price_region_type_quarter"
