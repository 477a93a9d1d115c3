"""Physical-plan checks: broadcast star joins, no Python in the hot path,
pushdown and pruning at the scan, no shuffle of the fact."""

import re

from conftest import SF001

from txlake.operators import avg_price_by_region_type_quarter, checked_broadcast
from txlake.plans import build_star
from txlake.sources import raw_transactions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_build_is_broadcast_only(spark):
    star = build_star(raw_transactions(spark, SF001))
    plan = _plan(star.fact)
    assert plan.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan  # the fact is never shuffled
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|PythonUDF)", plan)


def test_flagship_shuffles_only_group_rows(spark):
    star = build_star(raw_transactions(spark, SF001))
    report = avg_price_by_region_type_quarter(star.fact, star.dims)
    plan = _plan(report)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # one exchange on the grouping keys after a partial aggregate
    assert "HashAggregate" in plan and "partial_sum" in plan
    # the clean table scan reads only the columns the report needs
    scan = [line for line in plan.splitlines() if "FileScan parquet [" in line and "price_mad#" in line]
    assert scan
    for line in scan:
        cols = line.split("FileScan parquet [", 1)[1].split("]", 1)[0]
        assert "listing_id" not in cols and "transaction_id" not in cols and "source_office" not in cols


def test_checked_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in _plan(big.join(checked_broadcast(small, max_rows=100), big.k == small.id))
        assert "BroadcastHashJoin" not in _plan(big.join(checked_broadcast(small, max_rows=5), big.k == small.id))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _partial_before_exchange(plan: str) -> bool:
    """True when every hash exchange is fed directly by a (map-side) aggregate."""
    lines = plan.splitlines()
    ok = False
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = lines[i + 1] if i + 1 < len(lines) else ""
            if not re.search(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", below):
                return False
            ok = True
    return ok


def test_dedup_and_dimension_members_pre_aggregate(spark):
    from txlake.operators import clean_transactions, dedup_by_key
    from txlake.operators.dimensions import dimension_members

    raw = raw_transactions(spark, SF001)
    for df in (
        dedup_by_key(raw, ["transaction_id"], strategy="shuffle"),
        dedup_by_key(raw, ["transaction_id"], keep="any", strategy="shuffle"),
        dedup_by_key(raw, ["transaction_id"], strategy="split"),
        dimension_members(clean_transactions(raw)),
    ):
        assert _partial_before_exchange(df._jdf.queryExecution().executedPlan().toString())


def test_split_dedup_shuffles_only_repeated_keys(spark):
    from txlake.operators import dedup_by_key

    df = dedup_by_key(raw_transactions(spark, SF001), ["transaction_id"], strategy="split")
    plan = _plan(df)
    # the tagged rows are read by tag: unique keys pass through a scan alone
    assert "_repeated" in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # only the repeated rows


def test_hot_key_holding_a_third_of_rows(spark):
    """One id (and the null id) carry a third of all rows each: every row
    survives the cleaning rules, each key keeps exactly one row."""
    from pyspark.sql import functions as F

    from txlake.operators import clean_transactions, defect_profile

    base = raw_transactions(spark, SF001)
    n = base.count()
    hot = base.limit(n // 3).withColumn("transaction_id", F.lit("TX_HOT"))
    nulls = base.limit(n // 3).withColumn("transaction_id", F.lit(None).cast("string"))
    skewed = base.unionByName(hot).unionByName(nulls).repartition(16)
    for strategy in ("shuffle", "split"):
        clean = clean_transactions(skewed, dedup_strategy=strategy)
        assert clean.count() == 1500 + 2
        assert clean.where(F.col("transaction_id") == "TX_HOT").count() == 1
        assert clean.where(F.col("transaction_id").isNull()).count() == 1
    dup = {r.defect: r.n_rows for r in defect_profile(skewed).collect()}["duplicate_rows"]
    assert dup == skewed.count() - (1500 + 2)


def test_distinct_counts_shuffle_only_the_key(spark):
    """Exact distinct counts must not drag other aggregates' buffers through
    the key shuffle."""
    from txlake.operators import defect_profile

    plan = _plan(defect_profile(raw_transactions(spark, SF001)))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = lines[i + 1]
            assert "functions=[]" in below, below
