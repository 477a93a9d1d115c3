"""History of attributes: validity intervals, and the state at a point in time.

Keys are told apart by their number of rows.  Rows are counted by a hash of the key
(``SLOTS`` groups, one light pass); the keys of a group with many more rows than others
are hot.  The rows of all other keys are shuffled once, by key, and one window looks at
neighbours.

Hot keys are done by time buckets, so that one key with a third of all changes is spread
over many tasks.  Inside a (key, bucket) a window looks at neighbours; what lies beyond
a bucket comes from one row for each (key, bucket), passed on by a window over the
buckets of a key.  A key's rows in one bucket meet in one task, so choose ``bucket``
(seconds) such that the largest key has a bounded number of rows in it.  The joins are
equality joins on (key, bucket); nothing is compared range by range.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400
#: Groups of keys by hash, of which rows are counted.
SLOTS = 16_384
#: Keys of a group are hot from this many rows on, and from HOT_SHARE times the mean.
HOT_ROWS, HOT_SHARE = 1_000, 8


@dataclass
class Hot:
    """Groups of keys that hold hot keys, and whether there are rows of others."""

    slots: list[int] = field(default_factory=list)
    others: bool = True


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS))


def hot_keys(keys: list[str], *frames: DataFrame) -> Hot:
    """The hot keys of all ``frames`` together: at most SLOTS rows reach the driver."""
    counts = None
    for df in frames:
        n = df.select(_slot(keys).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
        counts = n if counts is None else counts.unionByName(n)
    found = {r["slot"]: r["n"] for r in counts.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
    least = max(HOT_ROWS, HOT_SHARE * sum(found.values()) / SLOTS)
    slots = sorted(s for s, n in found.items() if n >= least)
    return Hot(slots, len(slots) < len(found) or not found)


def _each_way(keys: list[str], hot: Hot, plain: Callable, bucketed: Callable, *frames: DataFrame) -> DataFrame:
    """``plain`` for the rows of most keys, ``bucketed`` for those of hot ones."""
    if not hot.slots:
        return plain(*frames)
    if not hot.others:
        return bucketed(*frames)
    is_hot = _slot(keys).isin(hot.slots)
    return plain(*[f.where(~is_hot) for f in frames]).unionByName(bucketed(*[f.where(is_hot) for f in frames]))


def _bucket(time: str, seconds: int) -> Column:
    return F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / seconds).alias("_bucket")


def _equal(keys: list[str], a: str, b: str) -> Column:
    same = F.col(f"{a}._bucket") == F.col(f"{b}._bucket")
    for k in keys:
        same = same & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return same


def validity_intervals(
    changes: DataFrame, keys: list[str], time: str, attributes: list[str], bucket: int = 90 * DAY, hot: Hot | None = None
) -> DataFrame:
    """(*keys, *attributes, valid_from, valid_to): one row for each run of equal
    attributes, from its first change up to the next run (exclusive; null: open).

    Changes without a time are left out.  Of several changes of a key at one time the
    smallest combination of attributes (nulls first) counts.  Repeated rows and changes
    to what holds already make no new row.  ``hot``: the hot keys, if they are known."""
    hot = hot_keys(keys, changes) if hot is None else hot
    return _each_way(
        keys,
        hot,
        lambda c: _intervals(c, keys, time, attributes),
        lambda c: _bucketed_intervals(c, keys, time, attributes, bucket),
        changes,
    )


def _intervals(changes: DataFrame, keys: list[str], time: str, attributes: list[str]) -> DataFrame:
    rows = changes.where(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_time"), F.struct(*attributes).alias("_state"))
    # all windows share one shuffle and one order
    ordered = Window.partitionBy(*keys).orderBy("_time", "_state")
    each = rows.select("*", F.lag("_time").over(ordered).alias("_prev")).where("_prev is null or _prev <> _time").drop("_prev")
    seen = each.select("*", F.lag(F.struct("_state")).over(ordered).alias("_prev"))
    changed = seen.where(F.col("_prev").isNull() | ~F.col("_prev._state").eqNullSafe(F.col("_state"))).drop("_prev")
    return changed.select(
        *keys,
        *[F.col(f"_state.{a}").alias(a) for a in attributes],
        F.col("_time").alias("valid_from"),
        F.lead("_time").over(ordered).alias("valid_to"),
    )


def _bucketed_intervals(changes: DataFrame, keys: list[str], time: str, attributes: list[str], bucket: int) -> DataFrame:
    state = F.struct(*attributes)
    each = (
        changes.where(F.col(time).isNotNull())
        .groupBy(*keys, F.col(time).alias("_time"))
        .agg(F.min(state).alias("_state"))
        .withColumn("_bucket", _bucket("_time", bucket))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_time")
    across = Window.partitionBy(*keys).orderBy("_bucket")
    point = F.struct("_time", "_state")

    # what held before: the row before, or the last one of the bucket before
    before = each.groupBy(*keys, "_bucket").agg(F.max_by("_state", "_time").alias("_last"))
    before = before.select(*keys, "_bucket", F.lag(F.struct("_last")).over(across).alias("_carry"))
    seen = each.select("*", F.lag(point).over(inside).alias("_prev")).alias("l").join(before.alias("r"), _equal(keys, "l", "r"))
    known = F.coalesce(F.col("l._prev").isNotNull() | F.col("r._carry").isNotNull(), F.lit(False))
    held = F.when(F.col("l._prev").isNotNull(), F.col("l._prev._state")).otherwise(F.col("r._carry._last"))
    changed = seen.where(~known | ~held.eqNullSafe(F.col("l._state"))).select("l.*").drop("_prev")

    # where it ends: the next change, or the first one of the next bucket
    after = changed.groupBy(*keys, "_bucket").agg(F.min("_time").alias("_first"))
    after = after.select(*keys, "_bucket", F.lead("_first").over(across).alias("_carry"))
    ends = changed.select("*", F.lead("_time").over(inside).alias("_next")).alias("l").join(after.alias("r"), _equal(keys, "l", "r"))
    return ends.select(
        *[F.col(f"l.{k}") for k in keys],
        *[F.col(f"l._state.{a}").alias(a) for a in attributes],
        F.col("l._time").alias("valid_from"),
        F.coalesce("l._next", "r._carry").alias("valid_to"),
    )


def as_of_join(
    probes: DataFrame,
    intervals: DataFrame,
    keys: list[str],
    time: str,
    attributes: list[str],
    bucket: int = 90 * DAY,
    hot: Hot | None = None,
) -> DataFrame:
    """Every row of ``probes`` with the ``attributes`` that held for its key at ``time``
    (from ``valid_from``, before ``valid_to``); null where none did or the time is null.

    ``intervals`` of a key must not overlap.  Columns of ``probes`` keep their names;
    the attributes must have others.  ``hot``: the hot keys of both, if they are known."""
    columns = probes.columns
    state = F.struct(*attributes, "valid_to")
    none = F.lit(None)
    starts = intervals.where("valid_from is not null").select(
        *keys, F.col("valid_from").cast("timestamp").alias("_time"), state.alias("_state"), F.lit(0).alias("_probe"), none.alias("_row")
    )
    wanted = probes.select(
        *keys, F.col(time).cast("timestamp").alias("_time"), none.alias("_state"), F.lit(1).alias("_probe"), F.struct(*columns).alias("_row")
    )
    # rows without a time are set aside: they have no bucket, and need no state
    timeless = wanted.where("_time is null").select("_row", *[F.lit(None).cast(intervals.schema[a].dataType).alias(a) for a in attributes])
    hot = hot_keys(keys, starts, wanted) if hot is None else hot
    held = _each_way(
        keys,
        hot,
        lambda a, b: _held(a, b, keys),
        lambda a, b: _bucketed_held(a, b, keys, bucket),
        starts,
        wanted.where("_time is not null"),
    )
    valid = F.col("_s.valid_to").isNull() | (F.col("_time") < F.col("_s.valid_to").cast("timestamp"))
    timed = held.select("_row", *[F.when(valid, F.col(f"_s.{a}")).alias(a) for a in attributes])
    return timed.unionByName(timeless).select("_row.*", *attributes)


def _held(starts: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """(_row, _time, _s) of the probes: the state that began last."""
    before = Window.partitionBy(*keys).orderBy("_time", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    found = starts.unionByName(wanted).select("*", F.last("_state", ignorenulls=True).over(before).alias("_s"))
    return found.where("_probe = 1").select("_row", "_time", "_s")


def _bucketed_held(starts: DataFrame, wanted: DataFrame, keys: list[str], bucket: int) -> DataFrame:
    both = starts.unionByName(wanted).withColumn("_bucket", _bucket("_time", bucket))
    last = both.groupBy(*keys, "_bucket").agg(
        F.max_by("_state", F.when(F.col("_probe") == 0, F.col("_time"))).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(across).alias("_carry"))

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_time", "_probe").rowsBetween(Window.unboundedPreceding, 0)
    found = both.select("*", F.last("_state", ignorenulls=True).over(inside).alias("_found")).where("_probe = 1")
    joined = found.alias("l").join(carry.alias("r"), _equal(keys, "l", "r"), "left")
    return joined.select(F.col("l._row").alias("_row"), F.col("l._time").alias("_time"), F.coalesce("l._found", "r._carry").alias("_s"))
