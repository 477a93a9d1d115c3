"""Later loads: keys stay, windows are replaced, reruns write nothing, failures leave tables alone."""

import glob
import os

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from txlake.operators import clean_transactions, flatten
from txlake.operators.dimensions import KEYS
from txlake.plans import extend_dimensions, load_star, reload_window, replace_partitions, run_batch
from txlake.plans import incremental, load_queries
from txlake.schemas import RAW_COLUMNS
from txlake.session import scale_conf, shared_dir
from txlake.sources import raw_transactions, write_csv


def local(path):
    return path.replace("file://", "").replace("file:", "")


def files(path):
    found = glob.glob(os.path.join(local(path), "**", "*.parquet"), recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in found}


def raw(spark, rows):
    """rows: (number, region, city, price, date)."""
    full = [(f"TX{k}", f"LST{k}", "villa", region, city, "100.0", price, "registered", "o1", date) for k, region, city, price, date in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in RAW_COLUMNS))


def lake_of(spark, df):
    csv, lake = shared_dir(spark, "t_csv"), shared_dir(spark, "t_lake")
    write_csv(df, csv)
    return lake, run_batch(spark, csv, lake)


def facts(spark, lake):
    star = load_star(spark, lake)
    return sorted((r.transaction_id, r.region, r.city, str(r.price_mad), str(r.transaction_date)) for r in flatten(star.fact, star.dims).collect())


BASE = [
    (1, "N", "a", "10", "2020-01-01"),
    (2, "N", "b", "20", "2020-05-01"),
    (3, "N", None, "30", "2021-01-01"),
    (4, "S", "c", "40", "2022-01-01"),
    (5, "S", "c", "bad", "2021-02-01"),
    (6, "S", "c", "60", "2023-01-01"),
]


def test_reload_moves_rejects_and_empties(spark):
    lake, result = lake_of(spark, raw(spark, BASE))
    assert (result.fact_rows, result.reject_rows) == (5, 1)
    fixed = [
        (3, "N", None, "bad", "2021-01-01"),  # accepted before, rejected now
        (5, "S", "c", "50", "2021-02-01"),  # rejected before, accepted now
        (6, "S", "new", "61", "2021-03-01"),  # was in 2023, which becomes empty
        (4, "S", "c", "41", "2020-07-01"),  # was in 2022, belongs to 2020
    ]
    done = reload_window(spark, lake, raw(spark, fixed), [2021])
    assert facts(spark, lake) == [
        ("TX1", "N", "a", "10.00", "2020-01-01"),
        ("TX2", "N", "b", "20.00", "2020-05-01"),
        ("TX4", "S", "c", "41.00", "2020-07-01"),
        ("TX5", "S", "c", "50.00", "2021-02-01"),
        ("TX6", "S", "new", "61.00", "2021-03-01"),
    ]
    assert sorted(done.fact.emptied) == [2022, 2023] and sorted(done.fact.written) == [2020, 2021]
    rejects = spark.read.parquet(f"{lake}/fact_rejects").collect()
    assert [(r.transaction_id, r.broken_rules) for r in rejects] == [("TX3", "price_mad")]

    before = files(lake)
    again = reload_window(spark, lake, raw(spark, fixed), [2021])
    assert again.fact.written == again.fact.emptied == again.rejects.written == again.rejects.emptied == []
    assert files(lake) == before  # not one file is written anew


def test_empty_correction_clears_the_window_only(spark):
    lake, _ = lake_of(spark, raw(spark, BASE))
    reload_window(spark, lake, raw(spark, []), [2021, 1999])
    assert [f[0] for f in facts(spark, lake)] == ["TX1", "TX2", "TX4", "TX6"]
    assert spark.read.schema("transaction_id string").parquet(f"{lake}/fact_rejects").count() == 0


def test_rows_without_key_or_partition(spark):
    path = shared_dir(spark, "t_parts")
    schema = "id string, v int, p int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    keys = lambda df: df.select("id")
    first = make([("a", 1, 1), (None, 2, None), (None, 2, None), ("b", 3, None), ("c", 4, 2)])
    replace_partitions(spark, path, first, keys(first), "id", "p", [])
    second = make([("a", 9, None), (None, 2, None)])
    for turn in range(2):
        done = replace_partitions(spark, path, second, keys(second), "id", "p", [])
        rows = sorted(map(tuple, spark.read.schema(schema).parquet(path).collect()), key=str)
        assert rows == sorted([("a", 9, None), (None, 2, None), ("b", 3, None), ("c", 4, 2)], key=str)
        assert (done.written, done.emptied) == (([None], [1]) if turn == 0 else ([], []))


def test_rows_that_stay_are_not_written_beside_the_table(spark, monkeypatch):
    path, schema = shared_dir(spark, "t_stay"), "id string, v int, p int"
    first = spark.createDataFrame([(f"k{i}", i, 1 if i < 5 else 2) for i in range(100)], schema)
    replace_partitions(spark, path, first, first.select("id"), "id", "p", [])
    beside, write = [], incremental.materialize

    def counted(*args):
        beside.append(write(*args))
        return beside[-1]

    monkeypatch.setattr(incremental, "materialize", counted)
    second = spark.createDataFrame([("k0", 7, 1), ("k9", 9, 1)], schema)  # k9 was in 2
    after = sorted([("k0", 7, 1), ("k9", 9, 1), *((f"k{i}", i, 2) for i in range(5, 100) if i != 9)])
    for turn in range(2):
        done = replace_partitions(spark, path, second, second.select("id"), "id", "p", [1])
        assert sorted(map(tuple, spark.read.schema(schema).parquet(path).collect())) == after
        assert sorted(done.written) == ([1, 2] if turn == 0 else []) and done.emptied == []
    assert [df.count() for df in beside] == [1, 0]  # of all rows outside the window the key of k9, once


def test_a_rebalanced_partition_has_several_files():
    conf = scale_conf(10**9, total_cores=12)
    assert 12 * int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) < 10**9 // 2
    large = scale_conf(10**14, total_cores=12)  # never above half a split
    assert int(large["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 128 << 20


def test_keys_stay_and_new_members_follow(spark):
    root = shared_dir(spark, "t_dims")
    one = extend_dimensions(spark, root, clean_transactions(raw(spark, [(1, "N", "b", "1", "2020-02-02"), (2, "N", None, "1", "2021-01-01")])))
    assert [tuple(r) for r in one.location.df.orderBy("location_id").collect()] == [(1, "N", None), (2, "N", "b")]
    rows = [(3, "A", None, "1", "2019-01-01"), (4, "N", None, "1", "2020-02-02"), (5, None, "x", "1", None), (6, "N", "a", "1", "2021-01-01")]
    for _ in range(2):
        two = extend_dimensions(spark, root, clean_transactions(raw(spark, rows)))
        assert [tuple(r) for r in two.location.df.orderBy("location_id").collect()] == [(1, "N", None), (2, "N", "b"), (3, "A", None), (4, "N", "a")]
        assert [(r.date_id, str(r.full_date), r.year) for r in two.date.df.orderBy("date_id").collect()] == [
            (1, "2020-02-02", 2020), (2, "2021-01-01", 2021), (3, "2019-01-01", 2019)
        ]
        assert (two.location.rows, two.date.rows, two.property_type.rows) == (4, 3, 1)


def test_reloaded_fact_has_valid_keys(spark):
    lake, _ = lake_of(spark, raw_transactions(spark, SF001))
    old = {tuple(r) for r in spark.read.parquet(f"{lake}/dim_location").collect()}
    correction = load_queries.corrected_1997(spark, SF001).withColumn("city", F.when(F.col("city") != "", F.concat("city", F.lit("-new"))))
    reload_window(spark, lake, correction, [1997])
    assert old < {tuple(r) for r in spark.read.parquet(f"{lake}/dim_location").collect()}
    fact = spark.read.parquet(f"{lake}/fact_transactions")
    for name, key in KEYS.items():
        assert fact.join(spark.read.parquet(f"{lake}/dim_{name}"), key, "left_anti").count() == 0


def test_malformed_rows_are_diverted_and_counted(spark):
    csv, lake = shared_dir(spark, "t_bad_csv"), shared_dir(spark, "t_bad_lake")
    good = "TX{0},LST{0},villa,N,a,100.0,10,registered,o1,2020-01-01"
    lines = [",".join(RAW_COLUMNS), good.format(1), "TX2,LST2,villa", good.format(3), good.format(4) + ",more"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(csv)
    result = run_batch(spark, csv, lake)
    assert (result.raw_rows, result.malformed_rows, result.clean_rows, result.fact_rows) == (4, 2, 2, 2)
    assert sorted(r.malformed_text for r in spark.read.parquet(f"{lake}/raw_malformed").collect()) == [lines[2], lines[4]]
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{lake}/raw").collect()) == ["TX1", "TX3"]
    kept = run_batch(spark, csv, lake, divert_malformed=False)
    assert (kept.raw_rows, kept.malformed_rows, kept.clean_rows, kept.reject_rows) == (4, 2, 4, 1)
    assert not os.path.exists(local(f"{lake}/raw_malformed"))


def test_failed_load_leaves_the_tables(spark, monkeypatch):
    lake, _ = lake_of(spark, raw(spark, BASE))
    before, old = files(lake), facts(spark, lake)
    csv = shared_dir(spark, "t_csv")
    write_csv(raw(spark, BASE[:2]), csv)
    from txlake.plans import batch

    def broken(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "build_fact", broken)
    with pytest.raises(RuntimeError):
        run_batch(spark, csv, lake)
    assert files(lake) == before and facts(spark, lake) == old


def test_year_is_few_files(spark):
    lake, _ = lake_of(spark, raw_transactions(spark, SF001))
    folders = glob.glob(local(f"{lake}/fact_transactions/transaction_year=*"))
    assert len(folders) == 7 and all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)
