"""Dedup against the lake: exact, only the folders of the load are read, no exchange on the stored side."""

import glob

from pyspark.sql import functions as F

from txlake.operators.lake_dedup import BUCKET, candidate_ids, dedup_against_lake, id_bucket, merge_load, store_by_id
from txlake.session import shared_dir


def lake(spark, ids, buckets=8):
    path = shared_dir(spark, "t_by_id")
    store_by_id(spark.createDataFrame([(i, "old") for i in ids], "id string, note string"), path, "id", buckets)
    return path


def test_unseen_rows_either_way(spark):
    path = lake(spark, [f"k{i}" for i in range(500)] + [None])
    new = spark.createDataFrame([(f"k{i}", "new") for i in range(400, 700)] + [(None, "new")], "id string, note string")
    want = sorted(f"k{i}" for i in range(500, 700))
    for limits in ({}, {"max_rows": 0}):
        assert sorted(r.id for r in dedup_against_lake(new, path, "id", 8, **limits).collect()) == want
    assert merge_load(new, path, "id", 8) == 200 and merge_load(new, path, "id", 8) == 0
    assert spark.read.parquet(path).count() == 701
    assert dedup_against_lake(new.limit(0), path, "id", 8).count() == 0


def test_filter_misses_none_and_lets_few_pass(spark):
    old = spark.range(20_000).select(F.col("id").cast("string").alias("id"))
    new = spark.range(0, 40_000, 40).select(F.col("id").cast("string").alias("id"))
    found = {r.id for r in candidate_ids(old, new, "id", 1000).collect()}
    held = {str(i) for i in range(0, 20_000, 40)}
    assert held <= found and len(found) - len(held) < 0.05 * 20_000


def test_plan_reads_the_load_s_folders_without_exchange(spark):
    path = lake(spark, [f"k{i}" for i in range(300)], buckets=16)
    new = spark.createDataFrame([("k7", "new"), ("zz", "new")], "id string, note string")
    own = {r.b for r in new.select(id_bucket("id", 16).alias("b")).collect()}
    stored = spark.read.parquet(path).where(F.col(BUCKET).isin(list(own))).select("id")
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in stored.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} <= {str(b) for b in own}
    assert len(glob.glob(path.replace("file:", "") + f"/{BUCKET}=*")) == 16
    plan = candidate_ids(stored, new, "id", 2)._jdf.queryExecution().sparkPlan().toString()
    tree = candidate_ids(stored, new, "id", 2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    scan = [x for x in tree.splitlines() if "FileScan" in x]
    assert len(scan) == 1 and "PartitionFilters: [" in scan[0] and BUCKET in scan[0].split("PartitionFilters")[1]
    side = tree.splitlines()
    at = next(i for i, x in enumerate(side) if "FileScan" in x)
    depth = side[at].index("FileScan")
    above, level = [], depth
    for x in reversed(side[:at]):  # the nodes that the scan feeds
        column = len(x) - len(x.lstrip(" :+-"))
        if column < level:
            above.append(x)
            level = column
    assert not any("Exchange" in x for x in above), above
