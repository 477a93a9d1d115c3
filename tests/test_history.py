"""Validity intervals and the as-of join against plain loops; plans without range joins."""

import datetime as dt
import random

from txlake.operators import history
from txlake.operators.history import DAY, as_of_join, validity_intervals

D0 = dt.datetime(2020, 1, 1)


def plain_intervals(changes):
    out = []
    for key in {k for k, _, _ in changes}:
        at = {}
        for k, t, s in changes:
            if k == key and t is not None:
                at[t] = min(at.get(t, s), s, key=lambda x: (x is not None, x or ""))
        runs = []
        for t in sorted(at):
            if not runs or runs[-1][1] != at[t]:
                runs.append((t, at[t]))
        out += [(key, s, t, runs[i + 1][0] if i + 1 < len(runs) else None) for i, (t, s) in enumerate(runs)]
    return out


def frames(spark, changes, probes):
    c = spark.createDataFrame(changes, "k string, t timestamp, s string")
    return c, spark.createDataFrame(probes, "k string, at timestamp, note string")


def make(seed):
    rng = random.Random(seed)
    time = lambda: D0 + dt.timedelta(hours=rng.randrange(24 * 400))
    # one key has a third of the changes; some have none, some no time
    keys = ["hot"] * 5 + [f"k{i}" for i in range(9)] + [None]
    changes = [(rng.choice(keys), time(), rng.choice(["a", "b", None])) for _ in range(300)]
    changes += [("k1", None, "a"), ("k2", D0, "a"), ("k2", D0, "b"), changes[0], changes[0]]
    probes = [(rng.choice(keys + ["other"]), time(), f"n{i}") for i in range(200)]
    probes += [("hot", None, "no time"), ("k2", D0, "at the change"), probes[0]]
    return changes, probes


def test_intervals_and_as_of(spark):
    for seed, bucket in ((1, 30 * DAY), (2, DAY), (3, 3000 * DAY)):
        changes, probes = make(seed)
        c, p = frames(spark, changes, probes)
        intervals = validity_intervals(c, ["k"], "t", ["s"], bucket=bucket)
        want = plain_intervals(changes)
        assert sorted(map(str, [tuple(r) for r in intervals.collect()])) == sorted(map(str, want))

        def held(key, at):
            found = [s for k, s, a, b in want if k == key and at is not None and a <= at and (b is None or at < b)]
            return found[0] if found else None

        got = as_of_join(p, intervals, ["k"], "at", ["s"], bucket=bucket).collect()
        assert sorted(map(str, [tuple(r) for r in got])) == sorted(str((k, t, n, held(k, t))) for k, t, n in probes)


def test_gaps_are_null(spark):
    p = spark.createDataFrame([("k", D0 + dt.timedelta(days=d), str(d)) for d in (0, 5, 15, 100)], "k string, at timestamp, note string")
    rows = [("k", "a", D0, D0 + dt.timedelta(days=10)), ("k", "b", D0 + dt.timedelta(days=90), None)]
    intervals = spark.createDataFrame(rows, "k string, s string, valid_from timestamp, valid_to timestamp")
    got = {r.note: r.s for r in as_of_join(p, intervals, ["k"], "at", ["s"], bucket=20 * DAY).collect()}
    assert got == {"0": "a", "5": "a", "15": None, "100": "b"}


def test_empty_tables_and_plan(spark):
    c, p = frames(spark, [], [("k", D0, "x")])
    intervals = validity_intervals(c, ["k"], "t", ["s"])
    joined = as_of_join(p, intervals, ["k"], "at", ["s"])
    assert [tuple(r) for r in joined.collect()] == [("k", D0, "x", None)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert as_of_join(p.limit(0), intervals, ["k"], "at", ["s"]).count() == 0


def test_hot_key_is_spread(spark):
    """Windows over changes are keyed by bucket, too; those by key alone see one row a bucket."""
    c, _ = frames(spark, [("hot", D0 + dt.timedelta(hours=h), "ab"[h % 2]) for h in range(2000)], [("x", D0, "")])
    plan = validity_intervals(c, ["k"], "t", ["s"], bucket=DAY)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 6 and sum("_bucket" in w.rsplit("[", 2)[1] for w in windows) == 3


def test_keys_with_few_rows_take_one_window_and_hot_ones_buckets(spark, monkeypatch):
    """Rows of other keys are shuffled once, without a self-join; both ways give the same."""
    changes, probes = make(4)
    c, p = frames(spark, changes, probes)
    want = plain_intervals(changes)

    def held(key, at):
        found = [s for k, s, a, b in want if k == key and at is not None and a <= at and (b is None or at < b)]
        return found[0] if found else None

    few = validity_intervals(c, ["k"], "t", ["s"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    for rows, slots in ((1000, 0), (60, 1), (1, 11)):
        monkeypatch.setattr(history, "HOT_ROWS", rows)
        hot = history.hot_keys(["k"], c)
        assert len(hot.slots) == slots and hot.others == (slots < 11)
        intervals = validity_intervals(c, ["k"], "t", ["s"], bucket=20 * DAY)
        assert sorted(map(str, [tuple(r) for r in intervals.collect()])) == sorted(map(str, want))
        got = as_of_join(p, intervals, ["k"], "at", ["s"], bucket=20 * DAY).collect()
        assert sorted(map(str, [tuple(r) for r in got])) == sorted(str((k, t, n, held(k, t))) for k, t, n in probes)
