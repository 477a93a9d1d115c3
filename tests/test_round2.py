"""Shared folders, copies that differ, forced joins, pruning, CSV and streams."""

import json

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from txlake.operators import build_fact, dedup_by_key, dedup_conflicts, defect_reconciliation
from txlake.operators.joins import checked_broadcast
from txlake.plans import QUERIES
from txlake.plans.batch import build_star
from txlake.schemas import RAW_SCHEMA
from txlake.session import _is_local, ensure_checkpoint_dir, shared_dir, size_session
from txlake.sources import malformed_rows, raw_transactions, read_raw_csv, text_stream, write_csv
from txlake.streaming import parse_events, run_available, run_stream


class FakeContext:
    def __init__(self, master):
        self.master = master
        self._jsc = None

    def getConf(self):
        return self

    def get(self, key, default=None):
        return default


class FakeSession:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.sparkContext, self.conf = FakeContext(master), self

    def get(self, key):
        raise KeyError(key)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://host"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(FakeSession(master))


def test_local_masters():
    assert _is_local(FakeSession("local")) and _is_local(FakeSession("local[8]"))


def test_session_is_sized_from_the_input(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        conf = size_session(spark, f"{SF001}/orders.parquet")
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


ROW = ("TX1", "L1", "land", "R", "Fes", "640.3", "10", "registered", "o", "2024-01-01")


@pytest.mark.parametrize("strategy", ["shuffle", "split"])
def test_dedup_keeps_the_fuller_copy(spark, strategy):
    poor = ("TX1", "L1", "land", "R", None, "1.0", "10", "registered", "o", "2024-01-01")
    rows = spark.createDataFrame([ROW, poor, ("TX2", *ROW[1:])], RAW_SCHEMA).repartition(2)
    kept = {r.transaction_id: r.city for r in dedup_by_key(rows, ["transaction_id"], strategy=strategy).collect()}
    assert kept == {"TX1": "Fes", "TX2": "Fes"}


def test_conflicts_and_null_ids_are_counted(spark):
    rows = [ROW, ROW, ("TX2", *ROW[1:]), ("TX2", "other", *ROW[2:]), (None, *ROW[1:]), (None, "other", *ROW[2:])]
    got = dedup_conflicts(spark.createDataFrame(rows, RAW_SCHEMA), ["transaction_id"]).first()
    assert tuple(got) == (6, 3, 2, 2)


def test_split_dedup_scans_its_input_twice(spark, tmp_path):
    """Once for the keys, once to tag and write; the result reads the tagged table."""
    path = str(tmp_path / "in")
    raw_transactions(spark, SF001).write.parquet(path)
    out = dedup_by_key(spark.read.parquet(path), ["transaction_id"], strategy="split")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    leaves = [leaf for leaf in out.inputFiles()]
    assert leaves and all("tagged_rows" in f for f in leaves), plan


def test_reconciliation_does_not_count_other_bad_prices(spark):
    rows = [(f"TX{i}", "L", "land", "R", "C", "1", p, "registered", "o", "2024-01-01") for i, p in enumerate([None, "bad", "", "5"])]
    rec = {r.defect: r for r in defect_reconciliation(spark.createDataFrame(rows, RAW_SCHEMA)).collect()}
    assert tuple(rec["comma_prices"])[2:] == (0, 0, 0)


def test_broadcast_needs_rows_and_bytes(spark):
    df = spark.range(10)
    hinted = lambda d: "hint" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(checked_broadcast(df))
    assert not hinted(checked_broadcast(df, rows=10, size=1 << 40))
    assert not hinted(checked_broadcast(df, rows=11, max_rows=10, size=1))


def test_shuffle_join_query_uses_sort_merge_joins(spark):
    plan = QUERIES["fact_transactions_shuffle_joins"](spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 4 and "BroadcastHashJoin" not in plan


def test_sort_merge_fact_with_a_hot_location(spark):
    """One location with a third of the rows."""
    raw = raw_transactions(spark, SF001)
    third = F.substring("listing_id", 4, 20).cast("long") % 3 == 0
    skewed = raw.withColumn("region", F.when(third, "R").otherwise(F.col("region"))).withColumn("city", F.when(~third, F.col("city")))
    star = build_star(skewed)
    merged = build_fact(star.clean, star.dims, max_broadcast_rows=0, join_hint="merge")
    assert merged.exceptAll(star.fact).count() == 0 and star.fact.exceptAll(merged).count() == 0


def test_no_window_after_the_star_is_built(spark):
    for name in ("avg_price_region_type_quarter", "status_breakdown", "null_aware_measures", "constraint_report"):
        assert "Window" not in QUERIES[name](spark, SF001)._jdf.queryExecution().sparkPlan().toString(), name


def test_year_report_prunes_the_fact(spark):
    plan = QUERIES["avg_price_one_year"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_year" in plan


def test_csv_keeps_blanks_and_checks_the_header(spark, tmp_path):
    rows = spark.createDataFrame([("TX1", "L1", "land", " R2", " ", "1", "2", "registered", "o", "2024-01-01")], RAW_SCHEMA)
    path = str(tmp_path / "csv")
    write_csv(rows, path)
    back = read_raw_csv(spark, path).first()
    assert (back.region, back.city) == (" R2", " ")
    swapped = str(tmp_path / "swapped")
    write_csv(rows.select("listing_id", "transaction_id", *rows.columns[2:]), swapped)
    with pytest.raises(Exception, match="header"):
        read_raw_csv(spark, swapped).collect()


def test_malformed_rows_and_line_breaks(spark, tmp_path):
    header = ",".join(RAW_SCHEMA.names)
    good = "TX1,L1,land,R,C,1,2,registered,o,2024-01-01"
    broken = 'TX2,L2,land,R,"a\nb",1,2,registered,o,2024-01-01'
    file = tmp_path / "x.csv"
    file.write_text(f"{header}\n{good}\n{broken}\n")
    assert tuple(malformed_rows(spark, str(file)).first()) == (3, 2)
    assert tuple(malformed_rows(spark, str(file), multi_line=True).first()) == (2, 0)


def test_stream_options(spark):
    event = {"transaction_id": "S1", "transaction_date": "2024-01-02", "event_timestamp": "2024-01-02T03:04:05.000006"}
    source, sink = shared_dir(spark, "t_options"), shared_dir(spark, "t_options_sink")
    lines = [json.dumps(event), "{broken", json.dumps(event | {"transaction_id": "S2", "event_timestamp": "soon"})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(source)
    options = {"corrupt_column": "bad", "event_time_column": "event_time", "partition_by": ["transaction_date"]}
    run_available(text_stream(spark, source), sink, shared_dir(spark, "t_options_ckpt"), **options)
    rows = {r.transaction_id: r for r in spark.read.parquet(sink).collect()}
    assert rows[None].bad == "{broken" and rows["S1"].bad is None
    assert rows["S1"].event_time.microsecond == 6 and rows["S2"].event_time is None
    # one stamp per micro-batch, never null
    assert len({r.ingested_at for r in rows.values()}) == 1 and rows["S1"].ingested_at is not None


def test_run_stream_until_its_time_is_over(spark):
    source, sink = shared_dir(spark, "t_run"), shared_dir(spark, "t_run_sink")
    spark.createDataFrame([('{"transaction_id": "S1"}',)], "value string").write.text(source)
    query = run_stream(text_stream(spark, source), sink, shared_dir(spark, "t_run_ckpt"), "1 second", timeout_s=20)
    try:
        assert spark.read.parquet(sink).count() == 1
    finally:
        query.stop()


def test_event_time_of_a_batch_frame(spark):
    rows = spark.createDataFrame([('{"event_timestamp": "2024-01-02T03:04:05.000000"}',)], "value string")
    assert parse_events(rows, event_time_column="t").first().t.year == 2024
