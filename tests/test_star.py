"""Dimensions, surrogate keys, the fact build and star invariants."""

import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from txlake.operators import (
    build_dimensions,
    build_fact,
    clean_transactions,
    flatten,
    split_rejects,
    with_surrogate_key,
)
from txlake.plans import build_star
from txlake.sources import raw_transactions, raw_transactions_dirty


@pytest.fixture(scope="module")
def star01(spark):
    return build_star(raw_transactions(spark, SF01))


def test_dimension_sizes(star01):
    d = star01.dims
    assert (d.date.rows, d.property_type.rows, d.location.rows, d.registration_status.rows) == (2399, 4, 30, 3)
    assert d.location.df.where(F.col("city").isNull()).count() == 5


def test_keys_follow_natural_order_nulls_first(star01):
    loc = star01.dims.location.df.orderBy("location_id").collect()
    assert [r.location_id for r in loc] == list(range(1, 31))
    first_region = [r for r in loc if r.region == loc[0].region]
    assert first_region[0].city is None  # null city is the first member of its region
    types = [r.property_type_name for r in star01.dims.property_type.df.orderBy("property_type_id").collect()]
    assert types == sorted(types)


def test_star_invariants(star01):
    clean, fact = star01.clean, star01.fact
    assert clean.count() == clean.select("transaction_id").distinct().count() == 15000
    assert fact.count() == 15000
    nulls = fact.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in ("date_id", "property_type_id", "location_id", "registration_status_id")]
    ).first()
    assert list(nulls) == [0, 0, 0, 0]
    # the star joined back equals the clean table, and price totals are unchanged
    assert flatten(fact, star01.dims).exceptAll(clean).count() == 0
    assert clean.exceptAll(flatten(fact, star01.dims)).count() == 0
    s1 = clean.agg(F.sum("price_mad")).first()[0]
    s2 = fact.agg(F.sum("price_mad")).first()[0]
    assert s1 == s2


def test_null_safe_location_join_matters(spark, star01):
    clean, loc = star01.clean, star01.dims.location.df
    plain = clean.join(loc, (clean.region == loc.region) & (clean.city == loc.city), "left")
    assert plain.where(loc.location_id.isNull()).count() == 284  # what a plain '=' would lose
    assert star01.fact.where(F.col("location_id").isNull()).count() == 0


def test_distributed_keys_equal_single_task_keys(spark):
    clean = clean_transactions(raw_transactions(spark, SF001))
    members = clean.select(F.col("transaction_date").alias("full_date")).where("full_date is not null").distinct()
    n = members.count()
    one = with_surrogate_key(members, "date_id", ["full_date"], rows=n)
    many = with_surrogate_key(members, "date_id", ["full_date"], rows=n, single_task_rows=10)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert sorted(r.date_id for r in many.collect()) == list(range(1, n + 1))


def test_members_persisted_or_not_agree(spark):
    clean = clean_transactions(raw_transactions(spark, SF001))
    written = build_dimensions(clean).stored()
    lazy = build_dimensions(clean, persist=False)
    assert written.location.rows == lazy.location.rows and written.location.size == lazy.location.size > 0
    a, b = written.location.df.collect(), lazy.location.df.collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_fact_and_rejects_are_the_clean_table(spark):
    star = build_star(raw_transactions_dirty(spark, SF001))
    accepted, rejects = split_rejects(star.fact)
    assert rejects.count() > 0 and accepted.count() + rejects.count() == star.clean.count()
    rules = {r for row in rejects.select("broken_rules").distinct().collect() for r in row[0].split(",")}
    assert rules == {"transaction_id", "date_id", "location_id", "price_mad"}


def test_unresolved_keys_stay_null_not_dropped(spark):
    from txlake.schemas import RAW_SCHEMA

    rows = [
        ("TX1", "L1", "land", "R", "C", "1.0", "10", "registered", "o", "2024-01-01"),
        ("TX2", "L2", "land", None, "C", "1.0", "10", "registered", "o", "not-a-date"),
    ]
    clean = clean_transactions(spark.createDataFrame(rows, RAW_SCHEMA))
    dims = build_dimensions(clean, persist=False)
    fact = {r.transaction_id: r for r in build_fact(clean, dims).collect()}
    assert set(fact) == {"TX1", "TX2"}
    assert fact["TX2"].date_id is None and fact["TX2"].location_id is None
    assert fact["TX1"].date_id == 1 and fact["TX1"].location_id == 1


def test_fallback_paths_equal_fast_paths(spark):
    """Beyond the size bounds: shuffle joins instead of broadcasts, and the
    distributed numbering instead of one task -- same results."""
    clean = clean_transactions(raw_transactions(spark, SF001))
    dims = build_dimensions(clean, persist=False)
    fast = build_fact(clean, dims)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        slow = build_fact(clean, dims, max_broadcast_rows=0)
        slow.write.format("noop").mode("overwrite").save()
        plan = slow._jdf.queryExecution().executedPlan().toString()
        # the fixture's own inner joins may broadcast; the fact's left joins may not
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" in line]
        assert sorted(map(tuple, slow.collect()), key=str) == sorted(map(tuple, fast.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")

    loc_members = dims.location.df.drop("location_id")
    many = with_surrogate_key(loc_members, "location_id", ["region", "city"], rows=dims.location.rows, single_task_rows=3)
    assert sorted(map(tuple, many.collect()), key=str) == sorted(map(tuple, dims.location.df.collect()), key=str)
