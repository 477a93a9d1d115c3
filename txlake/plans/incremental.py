"""Loads after the first: keys that stay, and windows that are replaced.

* ``extend_dimension``: members that a stored dimension lacks (a null-safe anti-join)
  are numbered after its largest key and appended; stored keys never change.
* ``replace_partitions``: a corrected export takes the place of a window of a table
  stored by partition, and of its own rows wherever they were stored before, as a
  corrected row may have moved to another partition.  Only partitions whose content
  changes are written, by dynamic partition overwrite.
* ``reload_window``: both, for the fact and its rejects.

A rerun of the same load finds its members stored and its partitions unchanged, so it
writes nothing; a load that died half-way is repaired by running it again.  One load
runs at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlake.operators import Dimension, Dimensions, build_fact, checked_broadcast, clean_transactions
from txlake.operators.dimensions import (
    KEYS,
    NATURAL,
    SINGLE_TASK_ROWS,
    counted_members,
    date_columns,
    members_of,
    with_surrogate_key,
)
from txlake.operators.fact import YEAR_COLUMN, broken_rules
from txlake.operators.joins import row_bytes
from txlake.session import scratch_tables
from txlake.sources import materialize, read_table, write_table
from txlake.sources.files import delete_path, path_exists

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def extend_dimension(
    spark: SparkSession, path: str, members: DataFrame, key: str, natural: list[str], week_start: str = "monday"
) -> Dimension:
    """The dimension stored at ``path`` (created if there is none) with the ``members``
    (natural keys, each once) that it lacks appended."""
    first = not path_exists(spark, path)
    new = members.select(*natural)
    last, rows, size = 0, 0, 0
    if not first:
        stored = read_table(spark, path)
        known = stored.agg(
            F.max(key).alias("last"), F.count(F.lit(1)).alias("n"), F.sum(row_bytes(stored.columns)).alias("b")
        ).first()
        last, rows, size = known["last"] or 0, known["n"], known["b"] or 0
        side = checked_broadcast(stored.select(*[F.col(c).alias(f"_{c}") for c in natural]), rows=rows, size=size)
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in natural])
        new = new.join(side, same, "left_anti")
    obs = Observation()
    counted = [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(natural) + 64).alias("b")]
    new = materialize(new, "new_members", obs, *counted)  # what is appended does not depend on the append
    n = obs.get["n"]
    if n or first:
        keyed = with_surrogate_key(new, key, natural, rows=n).withColumn(key, (F.col(key) + last).cast("int"))
        if key == KEYS["date"]:
            keyed = date_columns(keyed, week_start)
        write_table(keyed.coalesce(1) if n <= SINGLE_TASK_ROWS else keyed, path, mode="append")
    return Dimension(read_table(spark, path), rows + n, size + (obs.get["b"] or 0))


def extend_dimensions(spark: SparkSession, root: str, clean: DataFrame, week_start: str = "monday") -> Dimensions:
    """The four dimensions under ``root`` with the members of ``clean`` appended."""
    members, _ = counted_members(clean)
    return Dimensions(
        **{
            name: extend_dimension(spark, f"{root}/dim_{name}", members_of(members, name), key, NATURAL[name], week_start)
            for name, key in KEYS.items()
        }
    )


def _content(df: DataFrame, partition: str) -> dict:
    """{partition: (rows, sum and xor of row hashes)}; one row for each partition."""
    cols = sorted(c for c in df.columns if c != partition)
    row = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols]
    found = df.groupBy(partition).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias("s"),
        F.bit_xor(F.xxhash64(F.lit(7), *row)).alias("x"),
    )
    return {r[partition]: (r["n"], r["s"], r["x"]) for r in found.collect()}


def _in(partition: str, values) -> Column:
    listed = F.col(partition).isin([v for v in values if v is not None]) if any(v is not None for v in values) else F.lit(False)
    found = F.coalesce(listed, F.lit(False))
    return found | F.col(partition).isNull() if None in values else found


@dataclass
class Replaced:
    """Partitions that were written, that became empty, and that hold what they held."""

    written: list = field(default_factory=list)
    emptied: list = field(default_factory=list)
    unchanged: list = field(default_factory=list)


def _moved(spark: SparkSession, stored: DataFrame, known_by: Column, listed: DataFrame, key: str, partition: str):
    """(rows of ``stored`` that are ``listed``, as written (partition, _known), and their bound for a broadcast);
    None if nothing is stored.  Rows with a key are found by the key column alone."""
    if stored.isEmpty():
        return None
    bound = listed.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(["_known"])).alias("b")).first()
    gone = checked_broadcast(listed.distinct(), rows=bound["n"], size=bound["b"] or 0)
    named = stored.where(F.col(key).isNotNull()).select(partition, F.concat(F.lit("k"), F.col(key)).alias("_known"))
    unnamed = stored.where(F.col(key).isNull()).select(partition, known_by.alias("_known"))
    obs = Observation()
    counted = [F.count(F.lit(1)).alias("n"), F.sum(row_bytes(["_known"])).alias("b")]
    found = materialize(named.union(unnamed).join(gone, "_known", "left_semi"), "moved_rows", obs, *counted)
    return found, {"rows": obs.get["n"], "size": obs.get["b"] or 0}


def _counts(df: DataFrame, partition: str) -> dict:
    return {r[partition]: r["count"] for r in df.groupBy(partition).count().collect()}


def replace_partitions(
    spark: SparkSession, path: str, rows: DataFrame, keys: DataFrame, key: str, partition: str, window: list
) -> Replaced:
    """Put ``rows`` into the table at ``path``, which is stored by ``partition``.

    Stored rows go when their partition is in ``window`` or their ``key`` is among
    ``keys`` (a column of that name; the keys of ``rows``, and of rows that left the
    table).  Rows without a key are known by all their columns.  ``rows`` and ``keys``
    are read several times: pass written tables.

    Outside the window one scan of the keys finds the rows that go.  They are few, so
    they, not all ``keys``, are joined with whole rows; and only rows that go and rows
    that come are compared, as those that stay are the same before and after."""
    if not path_exists(spark, path):
        write_table(rows.hint("rebalance", partition), path, partition_by=[partition])
        return Replaced(written=sorted(_content(rows, partition), key=str))
    columns = sorted(rows.columns)
    names = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    known_by = F.coalesce(F.concat(F.lit("k"), F.col(key)), F.concat(F.lit("r"), F.sha2(names, 256)))
    # a table without rows has no file to take a schema from
    stored = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
    listed = keys.where(F.col(key).isNotNull()).select(F.concat(F.lit("k"), F.col(key)).alias("_known"))
    listed = listed.union(rows.where(F.col(key).isNull()).select(known_by.alias("_known")))
    found = _moved(spark, stored.where(~_in(partition, window)), known_by, listed, key, partition)
    moved = list(_counts(found[0], partition)) if found else []

    def outside(partitions: list, join: str) -> DataFrame:
        """Rows of ``partitions`` outside the window that stay (``left_anti``) or go (``left_semi``)."""
        part = stored.where(_in(partition, partitions))
        leaving = checked_broadcast(found[0].select("_known"), **found[1])
        return part.withColumn("_known", known_by).join(leaving, "_known", join).select(*rows.columns)

    gone = stored.where(_in(partition, window))
    gone = gone.unionByName(outside(moved, "left_semi")) if moved else gone
    old, new = _content(gone, partition), _content(rows, partition)
    touched = list({*window, *moved, *new})
    result = Replaced(unchanged=[p for p in touched if old.get(p) == new.get(p)])
    changed = [p for p in touched if p not in result.unchanged]
    left = [p for p in changed if p not in new]  # rows go, none come
    held = _counts(stored.where(_in(partition, left)), partition) if left else {}
    result.emptied = [p for p in left if held[p] == old[p][0]]
    result.written = [p for p in changed if p not in result.emptied]
    if result.written:
        after = rows.where(_in(partition, result.written))
        others = [p for p in result.written if p not in window]
        if others:
            stay = outside(others, "left_anti") if moved else stored.where(_in(partition, others))
            after = stay.unionByName(after)
        # rows of a partition together, large ones in several files; a dynamic overwrite
        # moves its files into place when all are written, so it may read the same table
        writer = after.hint("rebalance", partition).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for p in result.emptied:  # an overwrite leaves partitions without new rows alone
        delete_path(spark, f"{path}/{partition}={NULL_PARTITION if p is None else p}")
    return result


@dataclass
class ReloadResult:
    clean_rows: int
    dim_rows: dict[str, int]
    fact: Replaced
    rejects: Replaced


def reload_window(
    spark: SparkSession, lake_root: str, raw: DataFrame, years: list[int], keep: str = "min", week_start: str = "monday"
) -> ReloadResult:
    """Replace the facts of ``years`` by a corrected export of these years.

    Rows of the export that are dated in other years (or not at all) replace their
    earlier versions there.  A row that was accepted and is rejected now leaves the
    fact, and the other way round."""
    with scratch_tables(spark):
        return _reload(spark, lake_root.rstrip("/"), raw, years, keep, week_start)


def _reload(spark: SparkSession, root: str, raw: DataFrame, years: list[int], keep: str, week_start: str) -> ReloadResult:
    obs = Observation()
    clean = materialize(clean_transactions(raw, keep=keep), "reload_clean", obs, F.count(F.lit(1)).alias("n"))
    dims = extend_dimensions(spark, root, clean, week_start)
    # the joins run once; both tables are read from their result
    tagged = materialize(broken_rules(build_fact(clean, dims, with_year=True)), "reload_fact")
    accepted = tagged.where("broken_rules = ''").drop("broken_rules")
    rejected = tagged.where("broken_rules <> ''")
    keys = tagged.select("transaction_id")
    args = (keys, "transaction_id", YEAR_COLUMN, years)
    return ReloadResult(
        clean_rows=obs.get["n"],
        dim_rows={f"dim_{name}": getattr(dims, name).rows for name in KEYS},
        fact=replace_partitions(spark, f"{root}/fact_transactions", accepted, *args),
        rejects=replace_partitions(spark, f"{root}/fact_rejects", rejected, *args),
    )
