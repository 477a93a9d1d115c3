"""Benchmark: run the registered queries on $BENCH_SF_DIR and print one JSON line.

Each query is executed in full through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  Times include the query's own
writes (CSV export, raw zone, clean table, stream sink) since those are part of
the operator.  ``value`` is the sum over all queries; ``flagship_sec`` is the
headline report alone; ``run_batch_sec`` times the batch pipeline end to end
(CSV export -> raw zone -> clean -> dimensions -> fact, all written), and
``flagship_over_stored_star_sec`` runs the headline report over those stored
tables, as a daily report would.

Before timing, the JVM is warmed once by the flagship on the smallest data set
(BENCH_WARMUP_DIR, default /root/testdata/sf0.001), not on the benchmarked one.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_QUERIES (comma list, default all; ``run_batch`` selects the pipeline
timing), BENCH_EVENT_LOG (folder for Spark's event log, optional).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txlake.plans import FLAGSHIP, QUERIES  # noqa: E402


def _pipeline(spark, sf_dir: str) -> dict:
    """The batch pipeline end to end (CSV export -> raw zone -> clean -> star),
    then the flagship report over the stored star."""
    from txlake.operators import avg_price_by_region_type_quarter
    from txlake.plans import load_star, run_batch
    from txlake.session import shared_dir
    from txlake.sources import raw_transactions, write_csv

    csv = shared_dir(spark, "bench_csv")
    write_csv(raw_transactions(spark, sf_dir), csv)  # input preparation, not timed
    t0 = time.perf_counter()
    res = run_batch(spark, csv, shared_dir(spark, "bench_lake"))
    sec = time.perf_counter() - t0

    t1 = time.perf_counter()
    star = load_star(spark, res.paths["raw"].rsplit("/", 1)[0])
    avg_price_by_region_type_quarter(star.fact, star.dims).write.format("noop").mode("overwrite").save()
    report_sec = time.perf_counter() - t1
    return {
        "run_batch_sec": round(sec, 3),
        "run_batch_raw_rows": res.raw_rows,
        "run_batch_rows_per_sec": round(res.raw_rows / sec),
        "flagship_over_stored_star_sec": round(report_sec, 3),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pyspark.sql import SparkSession

    from txlake.session import RECOMMENDED_CONF, ensure_checkpoint_dir

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)))
    )
    event_log = os.environ.get("BENCH_EVENT_LOG")
    if event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)

    # warm the JVM once (class loading, JIT, codegen caches) outside the
    # timings, on the smallest data set rather than the benchmarked one
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        QUERIES[FLAGSHIP](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as ex:  # report, keep benchmarking the rest
            errors[name] = repr(ex)[:300]
    # the batch pipeline end to end: CSV export -> raw zone -> clean -> star
    pipeline = {}
    if not wanted or "run_batch" in wanted:
        try:
            pipeline = _pipeline(spark, sf_dir)
        except Exception as ex:  # keep the one-line report
            errors["run_batch"] = repr(ex)[:300]

    out = {
        "metric": "total_query_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "flagship": FLAGSHIP,
        "flagship_sec": timings.get(FLAGSHIP),
        "sf": sf,
        "cpus": int(cpus),
        **pipeline,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
