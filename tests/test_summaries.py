"""Mergeable cells and sketches, exact quantiles, row verdicts and quarantine, drift, scratch tables."""

import glob
import os
import random

from conftest import SF001
from pyspark.sql import functions as F

from txlake.operators import RULES, constraint_report, star_join
from txlake.operators.cube import add_load, compact, exact_quantiles, merged_cells, price_cells, price_cube, price_distribution, stored_cells
from txlake.operators.drift import DriftColumns, drift, drift_bounds, load_profile
from txlake.operators.verdicts import compile_rules, quarantine, rule_verdicts
from txlake.plans import build_star, run_batch
from txlake.plans.load_queries import MORE_RULES
from txlake.session import ensure_checkpoint_dir, shared_dir
from txlake.sources import raw_transactions, raw_transactions_dirty, write_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merged_cells_equal_recomputation(spark):
    star = build_star(raw_transactions(spark, SF001))
    path = shared_dir(spark, "t_cells")
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    for load in range(3):
        add_load(price_cells(star.fact.where(part == load), star.dims), path, str(load))
    add_load(price_cells(star.fact.where(part == 1), star.dims), path, "1")  # the same load again
    whole = price_cells(star.fact, star.dims)
    exact = ["region", "property_type", "year", "quarter", "n_transactions", "n_prices", "sum_price_mad"]
    assert rows(merged_cells(stored_cells(spark, path)).select(exact)) == rows(whole.select(exact))
    cube = rows(price_cube(whole))
    assert rows(price_cube(stored_cells(spark, path))) == cube
    compact(spark, path, ["0", "1"], "0")
    assert sorted(os.path.basename(f) for f in glob.glob(path.replace("file:", "") + "/load=*")) == ["load=0", "load=2"]
    assert rows(price_cube(stored_cells(spark, path))) == cube


def test_sketch_error(spark):
    """Ranks of merged quantile sketches within 2 %, distinct counts within 5 %."""
    star = build_star(raw_transactions(spark, SF001))
    path = shared_dir(spark, "t_cells")
    for load in range(2):
        add_load(price_cells(star.fact.where(F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == load), star.dims), path, str(load))
    flat = star_join(star.fact, star.dims).select("property_type_name", "price_mad", "listing_id").collect()
    for r in price_distribution(stored_cells(spark, path), ["property_type"]).collect():
        prices = sorted(float(x.price_mad) for x in flat if x.property_type_name == r.property_type)
        assert r.n_prices == len(prices)
        assert abs(r.n_listings / len({x.listing_id for x in flat if x.property_type_name == r.property_type}) - 1) < 0.05
        for q in (25, 50, 75):
            rank = sum(p <= r[f"price_q{q}"] for p in prices) / len(prices)
            assert abs(rank - q / 100) < 0.02


def test_exact_quantiles(spark):
    rng = random.Random(1)
    big = 2**62
    data = [("hot", rng.randrange(-50, 50)) for _ in range(800)]
    data += [("wide", rng.choice([-1, 1]) * rng.randrange(big)) for _ in range(101)] + [("one", 7), ("tie", 3), ("tie", 3), (None, -9), (None, 4), ("none", None)]
    df = spark.createDataFrame(data, "g string, v long")
    ask = [(0, 1), (1, 3), (1, 2), (99, 100), (1, 1)]
    got = {(r.g, r.numerator, r.denominator): r.v for r in exact_quantiles(df, ["g"], "v", ask, digit_bits=16).collect()}
    want = {}
    for g in {g for g, v in data if v is not None}:
        values = sorted(v for k, v in data if k == g and v is not None)
        for a, b in ask:
            want[g, a, b] = values[max(1, -(-len(values) * a // b)) - 1]
    assert got == want
    assert exact_quantiles(df.limit(0), ["g"], "v", ask).count() == 0


def test_verdicts_sum_to_the_report(spark):
    star = build_star(raw_transactions_dirty(spark, SF001))
    sums = {r.rule: r.n for r in rule_verdicts(star.fact, star.dims).groupBy("rule").agg(F.sum("n_violations").alias("n")).collect()}
    report = {r.rule: r.violations for r in constraint_report(star.fact, star.dims).collect()}
    assert sums == {rule: n for rule, n in report.items() if n} and sums


def test_quarantine_takes_every_broken_row(spark):
    star = build_star(raw_transactions_dirty(spark, SF001))
    fact = star.fact.unionByName(star.fact.where("transaction_id like 'TX%0'").limit(3))  # repeated ids
    rules = RULES + compile_rules(MORE_RULES)
    passing, held = quarantine(fact, star.dims, rules)
    assert passing.columns == fact.columns and passing.count() + held.count() == fact.count()
    assert rule_verdicts(passing, star.dims, rules).where("table_name = 'fact_transactions'").count() == 0
    broken = {n for r in held.select("broken_rules").collect() for n in r.broken_rules}
    assert {"fact_transactions.transaction_id:primary_key", "fact_transactions.price_mad:not_null", "fact_transactions.price_mad:check"} <= broken
    assert all(r.broken_rules for r in held.select("broken_rules").collect())


def test_drift(spark):
    columns = DriftColumns({"v": F.col("v")}, ["t"])
    one = spark.createDataFrame([(i, "a") for i in range(100)], "v long, t string")
    two = spark.createDataFrame([(i + 50, "a" if i < 25 else None) for i in range(100)], "v long, t string")
    bounds = drift_bounds(one, columns)
    first = load_profile(one, columns, bounds)
    distance = lambda other: {r.column_name: r.distance for r in drift(first, load_profile(other, columns, bounds)).collect()}
    assert distance(one) == {"v": 0.0, "t": 0.0}
    assert distance(two) == {"v": 0.5, "t": 0.75}
    assert distance(one.limit(0)) == {"v": None, "t": None}


def test_batch_leaves_no_intermediate_tables(spark):
    csv, lake = shared_dir(spark, "t_csv"), shared_dir(spark, "t_lake")
    write_csv(raw_transactions(spark, SF001), csv)
    root = ensure_checkpoint_dir(spark).replace("file:", "") + "/txlake"
    tables = lambda: {f for f in glob.glob(f"{root}/*/*") if "/t_lake/" not in f}
    before = tables()
    result = run_batch(spark, csv, lake)
    assert tables() == before and result.fact_rows == 1500
    assert glob.glob(lake.replace("file:", "") + "/_load/*") == []
