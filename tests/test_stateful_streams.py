"""Streams into the star, deduplicated streams with bounded state, windows."""

import datetime as dt
import json

from conftest import SF001
from pyspark.sql import functions as F

from txlake.operators import flatten
from txlake.plans import load_star
from txlake.session import shared_dir
from txlake.sources import event_messages
from txlake.sources.streams import text_stream
from txlake.streaming.star import load_batch, run_available_to_star, stream_facts
from txlake.streaming.stateful import dedup_events, drain, late_rows, state_rows, windowed_by_region


def event(i, time, **more):
    fields = {"transaction_id": f"S{i}", "listing_id": f"L{i}", "property_type": "villa", "region": "N", "city": "a"}
    fields |= {"surface_m2": 50.0, "price_mad": 10.25, "registration_status": "registered", "source_office": "o"}
    stamp = {} if time is None else {"transaction_date": time.strftime("%Y-%m-%d"), "event_timestamp": time.strftime("%Y-%m-%dT%H:%M:%S.%f")}
    return json.dumps(fields | stamp | more)


def arrive(spark, folder, rows):
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(folder)


T0 = dt.datetime(2024, 3, 1, 12)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def test_replayed_batch_adds_nothing(spark):
    source, lake, ckpt = (shared_dir(spark, f"t_{x}") for x in ("src", "lake", "ckpt"))
    one = [event(1, T0), event(1, T0), event(2, T0, city=""), event(3, None), "broken", event(4, T0, price_mad=1e12)]
    arrive(spark, source, one)
    run_available_to_star(text_stream(spark, source), lake, ckpt)
    two = [event(5, hours(30), region="S", city=None), event(6, T0)]
    arrive(spark, source, two)
    run_available_to_star(text_stream(spark, source), lake, ckpt)
    run_available_to_star(text_stream(spark, source), lake, ckpt)  # nothing new

    def state():
        star = load_star(spark, lake, fact=stream_facts(spark, lake))
        rows = sorted((r.transaction_id, r.region, r.city) for r in flatten(star.fact, star.dims).collect())
        return rows, {n: sorted(map(tuple, d.df.collect())) for n, d in star.dims.named().items()}

    rows, dims = state()
    assert rows == [("S1", "N", "a"), ("S2", "N", None), ("S5", "S", None), ("S6", "N", "a")]
    assert sorted(dims["dim_location"]) == [(1, "N", None), (2, "N", "a"), (3, "S", None)]
    batch = spark.createDataFrame([(r,) for r in one], "value string")
    load_batch(batch, 0, lake)  # the first micro-batch once more
    assert state() == (rows, dims)
    rejects = spark.read.parquet(f"{lake}/fact_stream_rejects").collect()
    assert {r.transaction_id: r.broken_rules for r in rejects if r.transaction_id} == {"S3": "date_id", "S4": "price_mad"}


def test_dedup_counts_late_rows_and_bounds_state(spark):
    source, sink, ckpt = (shared_dir(spark, f"t_{x}") for x in ("src", "sink", "ckpt"))
    arrive(spark, source, [event(i, hours(i)) for i in range(100)] + [event(i, hours(i)) for i in range(50)] + [event(999, None)])
    one = drain(dedup_events(text_stream(spark, source), "10 hours"), sink, ckpt)
    assert late_rows(one) == 0 and state_rows(one) < 25  # keys older than the delay are gone
    # repeats inside the delay, one new late event, one late repeat
    arrive(spark, source, [event(95, hours(95)), event(98, hours(98)), event(500, hours(3)), event(4, hours(4)), event(100, hours(100))])
    two = drain(dedup_events(text_stream(spark, source), "10 hours"), sink, ckpt)
    assert late_rows(two) == 2
    got = sorted(r.transaction_id for r in spark.read.parquet(sink).collect())
    assert got == sorted(f"S{i}" for i in range(101))


def test_windows_are_emitted_once_when_passed(spark):
    source, sink, ckpt = (shared_dir(spark, f"t_{x}") for x in ("src", "sink", "ckpt"))
    arrive(spark, source, [event(1, hours(0.2)), event(2, hours(0.9)), event(3, hours(1.5), region="S"), event(4, hours(2.1))])
    drain(windowed_by_region(text_stream(spark, source)), sink, ckpt)
    first = [tuple(r) for r in spark.read.parquet(sink).collect()]
    assert first == [(T0, "N", 2, 2050)]  # the watermark stands at 13:06
    arrive(spark, source, [event(5, hours(1.6)), event(6, hours(0.5)), event(7, hours(9))])
    drain(windowed_by_region(text_stream(spark, source)), sink, ckpt)
    got = sorted((r.window_start, r.region, r.n_events) for r in spark.read.parquet(sink).collect())
    assert got == [(T0, "N", 2), (hours(1), "N", 1), (hours(1), "S", 1), (hours(2), "N", 1)]


def test_stream_equals_batch_clean(spark):
    """The star of a stream holds the measures of its events, as decimals."""
    lake = shared_dir(spark, "t_lake")
    load_batch(event_messages(spark, SF001), 0, lake)
    facts = stream_facts(spark, lake)
    assert facts.agg(F.sum("price_mad")).first()[0] is not None
    assert dict(facts.dtypes)["price_mad"] == "decimal(12,2)" and "batch_id" in facts.columns
