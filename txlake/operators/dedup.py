"""Keyed deduplication: one row per business key.

``keep="min"`` (default) keeps the smallest row per key, column by column, where
a null counts as larger than any value: of two copies the one that fills a field
wins over the one that leaves it empty.  The choice is deterministic, so a
recomputation after a lost executor picks the same row and dimensions and facts
stay consistent.  ``keep="any"`` is ``dropDuplicates``: an arbitrary row per key
(exact copies make the choice irrelevant).  Null keys form one group (one row
survives); ``dedup_conflicts`` counts what a dedup drops that was no exact copy.

Two physical strategies, same rows with ``keep="min"``:

* ``shuffle`` (default): one aggregation on the key, pre-aggregated per map task.
  Every row crosses the shuffle.
* ``split``: for inputs whose duplicates are rare.  The keys that occur more than
  once are found first -- a shuffle of the key column only, pre-aggregated per
  map task -- and written.  When their measured rows and bytes are within the
  broadcast bounds, every row is tagged against them and written once,
  partitioned by the tag: rows with a unique key are read back as they are, and
  only rows with a repeated key go through the keyed aggregation.  The input is
  scanned twice (keys, then all columns).  Beyond the bounds, ``shuffle`` is
  used.  It saves shuffling and sorting the table: the keyed ``min`` over
  string-valued rows cannot use a hash aggregate (its buffers must be
  fixed-width), so Spark plans it as a sort aggregate.

In either strategy, a key holding a large share of all rows (a hot duplicated id,
or many null ids) is collapsed to one row per map task before any shuffle, so no
task receives the hot group.  A ``row_number`` window would ship every copy to
one task and is deliberately not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from txlake.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, row_bytes


def _keyed_aggregate(df: DataFrame, keys: list[str], keep: str) -> DataFrame:
    if keep == "any":
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    nulls_last = F.struct(*[F.struct(F.isnull(c).alias("n"), F.col(c).alias("v")).alias(c) for c in rest])
    return (
        df.groupBy(*keys)
        .agg(F.min(nulls_last).alias("_kept"))
        .select(*keys, *[F.col(f"_kept.{c}.v").alias(c) for c in rest])
        .select(*df.columns)
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur on more than one row (null keys included)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1).drop("count")


def dedup_conflicts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: what a dedup on ``keys`` drops.

    n_rows, n_keys (groups; all null keys are one), n_conflicting_keys (keys with
    rows that differ) and n_null_key_rows.  A pre-aggregated pass: a key's rows
    differ when the smallest and the largest hash of its rows do."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
    null_key = reduce(lambda a, b: a & b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("lo"), F.max(row).alias("hi"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("lo") != F.col("hi")).alias("n_conflicting_keys"),
            F.coalesce(F.sum(F.when(null_key, F.col("n"))), F.lit(0)).alias("n_null_key_rows"),
        )
    )


def dedup_by_key(
    df: DataFrame,
    keys: list[str],
    keep: str = "min",
    strategy: str = "shuffle",
    max_repeated_keys: int = DEFAULT_BROADCAST_ROWS,
    max_repeated_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    if keep not in ("min", "any"):
        raise ValueError(f"keep must be 'min' or 'any', not {keep!r}")
    if strategy == "shuffle":
        return _keyed_aggregate(df, keys, keep)
    if strategy != "split":
        raise ValueError(f"strategy must be 'split' or 'shuffle', not {strategy!r}")

    from txlake.session import shared_dir
    from txlake.sources.files import materialize, write_table

    obs = Observation()
    measured = [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(keys)).alias("b")]
    dup = materialize(repeated_keys(df, keys), "repeated_keys", obs, *measured)
    if obs.get["n"] > max_repeated_keys or (obs.get["b"] or 0) > max_repeated_bytes:
        return _keyed_aggregate(df, keys, keep)

    renamed = dup.select(*[F.col(k).alias(f"_dup_{k}") for k in keys], F.lit(True).alias("_repeated"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_dup_{k}")) for k in keys])
    tagged = df.join(F.broadcast(renamed), same_key, "left").select(
        *df.columns, F.coalesce("_repeated", F.lit(False)).alias("_repeated")
    )
    path = shared_dir(df.sparkSession, "tagged_rows")
    write_table(tagged, path, partition_by=["_repeated"])
    schema = df.select(*df.columns, F.lit(True).alias("_repeated")).schema
    rows = df.sparkSession.read.schema(schema).parquet(path)
    part = lambda tag: rows.where(F.col("_repeated") == tag).select(*df.columns)
    return part(False).unionByName(_keyed_aggregate(part(True), keys, keep))
