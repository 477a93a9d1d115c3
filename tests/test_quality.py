"""Defect profile, reconciliation, integrity rules and stage counts."""

from conftest import SF01
from pyspark.sql import functions as F

from txlake.operators import (
    Dimension,
    constraint_report,
    defect_profile,
    defect_reconciliation,
    stage_counts,
)
from txlake.plans import build_star
from txlake.sources import raw_transactions


def test_defect_profile_sf0_01(spark):
    raw = raw_transactions(spark, SF01)
    got = {r.defect: r.n_rows for r in defect_profile(raw).collect()}
    assert got == {"duplicate_rows": 149, "comma_prices": 1378, "missing_surface": 122, "missing_city": 287}


def test_reconciliation_and_counts(spark):
    star = build_star(raw_transactions(spark, SF01))
    rec = {r.defect: tuple(r)[1:] for r in defect_reconciliation(star.raw).collect()}
    assert rec["duplicate_rows"] == ("removed", 149, 149, 149)
    assert rec["comma_prices"][0] == "repaired" and rec["comma_prices"][2] == rec["comma_prices"][3]
    assert rec["missing_surface"] == ("kept_null", 122, 121, 121)
    assert rec["missing_city"] == ("kept_null", 287, 284, 284)
    counts = {r.stage: r.n_rows for r in stage_counts(star.raw, star.clean, star.fact).collect()}
    assert counts == {"raw": 15149, "clean": 15000, "fact": 15000}


def test_constraint_report_clean_then_broken(spark):
    star = build_star(raw_transactions(spark, SF01))
    report = {r.rule: r.violations for r in constraint_report(star.fact, star.dims).collect()}
    assert report and all(v == 0 for v in report.values())

    # break it: a duplicated fact row, an over-long id, a dangling key, a
    # repeated null-city member in dim_location
    bad_fact = star.fact.unionByName(star.fact.limit(1)).unionByName(
        star.fact.limit(1).withColumn("transaction_id", F.lit("X" * 25)).withColumn("location_id", F.lit(999))
    )
    loc = star.dims.location
    dup_null = loc.df.where(F.col("city").isNull()).limit(1).withColumn("location_id", F.lit(1000))
    star.dims.location = Dimension(loc.df.unionByName(dup_null), loc.rows + 1)
    broken = {r.rule: r.violations for r in constraint_report(bad_fact, star.dims).collect()}
    assert broken["fact_transactions.transaction_id:primary_key"] == 1
    assert broken["fact_transactions.transaction_id:max_length"] == 1
    assert broken["fact_transactions.location_id:foreign_key"] == 1
    assert broken["dim_location.region+city:unique"] == 1
    # a duplicated dimension key is reported, and does not multiply the facts
    loc = star.dims.location
    star.dims.location = Dimension(loc.df.unionByName(loc.df.limit(1)), loc.rows + 1)
    again = {r.rule: r.violations for r in constraint_report(star.fact, star.dims).collect()}
    assert again["dim_location.location_id:primary_key"] == 1
    assert again["fact_transactions.transaction_id:primary_key"] == 0


def test_empty_and_all_null_groups_give_null_not_errors(spark):
    """ANSI mode is on in Spark 4: averages and shares over nothing are null."""
    from txlake.operators import build_dimensions, build_fact, clean_transactions, null_aware_measures
    from txlake.schemas import RAW_SCHEMA

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = [("TX1", "L1", "land", "R", "C", None, "10", "registered", "o", "2024-01-01")]
    clean = clean_transactions(spark.createDataFrame(rows, RAW_SCHEMA))
    dims = build_dimensions(clean, persist=False)
    (m,) = null_aware_measures(build_fact(clean, dims), dims).collect()
    assert (m.n_rows, m.n_surface, m.avg_surface_m2, m.sum_surface_m2) == (1, 0, None, None)
    empty = spark.createDataFrame([], RAW_SCHEMA)
    shares = [r.share for r in defect_profile(empty).collect()]
    assert shares == [None, None, None, None]
    assert {r.defect: r.n_rows for r in defect_profile(empty).collect()}["duplicate_rows"] == 0


def test_parse_failures_counts_bad_values_not_missing_ones(spark):
    from txlake.operators import parse_failures
    from txlake.schemas import RAW_SCHEMA

    rows = [
        ("TX1", "L", "land", "R", "C", "", "1,000", "registered", "o", "2024-01-01"),  # missing surface: not a failure
        ("TX2", "L", "land", "R", "C", "abc", "bad", "registered", "o", "2024-02-31"),  # three failures
        ("TX3", "L", "land", "R", "C", "12345678901", "12345678901", "registered", "o", None),  # two overflows
    ]
    got = {r.field: r.n_failed for r in parse_failures(spark.createDataFrame(rows, RAW_SCHEMA)).collect()}
    assert got == {"price_mad": 2, "surface_m2": 2, "transaction_date": 1}
