"""Dimension builds with deterministic surrogate keys.

Each dimension is the distinct set of its natural key in the clean table
(partial aggregation before the shuffle, so the shuffle carries at most one row
per member per map task).  Members with a null NOT NULL natural key (an
unparsable date, a missing region, ...) are not members: the facts that carry
them keep a null foreign key and the constraint report counts them.

Surrogate keys are ``1..n`` in natural-key order, nulls first (the only
nullable key part is ``city``).  The dimension's size is counted first:

* up to ``single_task_rows`` members, a ``row_number`` over the ordered
  members -- one small task;
* above that, a distributed numbering: range-partition and sort the members,
  checkpoint them into the shared folder so partitions and order are fixed,
  number rows inside each partition and add the row count of all earlier
  partitions (a table with one row per partition, broadcast).

No path gathers an unbounded dimension into one task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from txlake.functions import date_parts
from txlake.operators.joins import DEFAULT_BROADCAST_ROWS, checked_broadcast, row_bytes
from txlake.session import ensure_checkpoint_dir

SINGLE_TASK_ROWS = 1_000_000
_LOW_33_BITS = (1 << 33) - 1


def _ordering(cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def with_surrogate_key(
    members: DataFrame,
    key: str,
    order_cols: list[str],
    rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Prepend ``key`` = 1..n over ``members`` ordered by ``order_cols``.

    ``order_cols`` must identify a member (they are the natural key).
    """
    n = rows if rows is not None else members.count()
    order = _ordering(order_cols)
    if n <= single_task_rows:
        numbered = members.withColumn(key, F.row_number().over(Window.orderBy(*order)))
        return numbered.select(key, *members.columns)

    ensure_checkpoint_dir(members.sparkSession)
    parts = -(-n // single_task_rows) * 4  # from the member count alone
    ordered = members.repartitionByRange(parts, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).withColumn(
        "_pid", F.shiftright("_mid", 33)
    )
    offsets = (
        tagged.groupBy("_pid")
        .count()
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("count").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
        .drop("count")
    )
    numbered = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        key, (F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOW_33_BITS)) + 1).cast("int")
    )
    return numbered.select(key, *members.columns)


@dataclass
class Dimension:
    """A dimension table with its member count and bytes (the proven broadcast
    bounds)."""

    df: DataFrame
    rows: int
    size: int | None = None

    def for_join(self, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
        return checked_broadcast(self.df, rows=self.rows, max_rows=max_rows, size=self.size)

    def stored(self, name: str) -> Dimension:
        """The keyed table written once, so no consumer numbers it again."""
        from txlake.sources.files import materialize

        df = self.df.coalesce(1) if self.rows <= SINGLE_TASK_ROWS else self.df
        return Dimension(materialize(df, name), self.rows, self.size)


@dataclass
class Dimensions:
    date: Dimension
    property_type: Dimension
    location: Dimension
    registration_status: Dimension

    def stored(self) -> Dimensions:
        return Dimensions(
            date=self.date.stored("dim_date"),
            property_type=self.property_type.stored("dim_property_type"),
            location=self.location.stored("dim_location"),
            registration_status=self.registration_status.stored("dim_registration_status"),
        )

    def named(self) -> dict[str, Dimension]:
        return {
            "dim_date": self.date,
            "dim_property_type": self.property_type,
            "dim_location": self.location,
            "dim_registration_status": self.registration_status,
        }

    def tables(self) -> dict[str, DataFrame]:
        return {name: dim.df for name, dim in self.named().items()}


# Natural-key columns of the clean table feeding each dimension, in the order
# of the grouping sets below.
_SOURCE_COLUMNS = ["transaction_date", "property_type", "region", "city", "registration_status"]
_GROUPING_SETS = {
    "date": ["transaction_date"],
    "property_type": ["property_type"],
    "location": ["region", "city"],
    "registration_status": ["registration_status"],
}


def _grouping_id(grouped: list[str]) -> int:
    """``grouping_id()`` of a set: bit i (from the left) is 1 when column i is
    not grouped."""
    n = len(_SOURCE_COLUMNS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_SOURCE_COLUMNS) if c not in grouped)


def dimension_members(clean: DataFrame) -> DataFrame:
    """All members of all four dimensions from ONE scan and ONE shuffle.

    A grouping-sets aggregation expands each clean row once per dimension and
    pre-aggregates per map task, so the shuffle carries at most one row per
    member per task.  ``_gid`` tells which dimension a row belongs to (a null
    city inside the location set is a real member, told apart from "not
    grouped" by ``_gid``).
    """
    return clean.groupingSets(list(_GROUPING_SETS.values()), *_SOURCE_COLUMNS).agg(
        F.grouping_id().alias("_gid")
    )


#: Natural key column that a member must have, and the names of a dimension's columns.
_NOT_NULL = {
    "date": "transaction_date",
    "property_type": "property_type",
    "location": "region",
    "registration_status": "registration_status",
}
_RENAMES = {"transaction_date": "full_date", "property_type": "property_type_name", "registration_status": "status_name"}
KEYS = {
    "date": "date_id",
    "property_type": "property_type_id",
    "location": "location_id",
    "registration_status": "registration_status_id",
}
NATURAL = {
    "date": ["full_date"],
    "property_type": ["property_type_name"],
    "location": ["region", "city"],
    "registration_status": ["status_name"],
}


def _names(name: str) -> list[tuple[str, str]]:
    return [(c, c if name == "location" else _RENAMES[c]) for c in _GROUPING_SETS[name]]


def date_columns(dim_date: DataFrame, week_start: str = "monday") -> DataFrame:
    """A date dimension of key and date, with its date parts."""
    parts = date_parts(F.col("full_date"), week_start)
    return dim_date.select("date_id", "full_date", *[v.alias(k) for k, v in parts.items()])


def counted_members(clean: DataFrame, persist: bool = True) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """The members of all dimensions and (rows, bytes) of each.  With ``persist`` they
    are written once to the shared folder and counted by that write."""
    from txlake.sources.files import materialize

    members = dimension_members(clean)
    gids = {name: _grouping_id(cols) for name, cols in _GROUPING_SETS.items()}
    per_dim = [F.count_if(F.col("_gid") == gid).alias(str(gid)) for gid in gids.values()]
    per_dim += [
        # the key and date parts come on top of the natural key
        F.sum(F.when(F.col("_gid") == gid, row_bytes(_GROUPING_SETS[name]) + 64)).alias(f"b{gid}")
        for name, gid in gids.items()
    ]
    if persist:
        obs = Observation()
        members = materialize(members, "dim_members", obs, *per_dim)
        counts = dict(obs.get)  # filled by the write, no extra scan
    else:
        counts = members.agg(*per_dim).first().asDict()
    # counts include a possible null member; that only over-states the bound.
    return members, {name: (counts.get(str(gid)) or 0, counts.get(f"b{gid}") or 0) for name, gid in gids.items()}


def members_of(members: DataFrame, name: str) -> DataFrame:
    """The natural keys of one dimension, under the dimension's column names."""
    cols = [F.col(c).alias(to) for c, to in _names(name)]
    own = (F.col("_gid") == _grouping_id(_GROUPING_SETS[name])) & F.col(_NOT_NULL[name]).isNotNull()
    return members.where(own).select(*cols)


def build_dimensions(
    clean: DataFrame, week_start: str = "monday", persist: bool = True, store: bool = False
) -> Dimensions:
    """The four dimensions, keyed, with their member counts.

    With ``persist`` the member table (the sum of the four dimension sizes) is
    written once to the shared folder, so counting and keying read a small
    file instead of re-aggregating the clean table.  With ``store`` the keyed
    dimensions are written too, so no consumer numbers them again: while each is
    within ``SINGLE_TASK_ROWS``, by one window over all members and one write.
    """
    from txlake.session import shared_dir
    from txlake.sources.files import write_table

    members, sizes = counted_members(clean, persist)
    keyed: dict[str, DataFrame] = {}
    if store and all(rows <= SINGLE_TASK_ROWS for rows, _ in sizes.values()):
        valid = [(F.col("_gid") == _grouping_id(_GROUPING_SETS[n])) & F.col(_NOT_NULL[n]).isNotNull() for n in KEYS]
        place = F.row_number().over(Window.partitionBy("_gid").orderBy(*_ordering(_SOURCE_COLUMNS)))
        path = shared_dir(clean.sparkSession, "dimensions")
        numbered = members.where(reduce(lambda a, b: a | b, valid)).withColumn("_key", place)
        write_table(numbered, path, partition_by=["_gid"])
        # no member, no file: the declared schema stands for an empty folder
        stored = clean.sparkSession.read.schema(numbered.schema).parquet(path)
        for name, key in KEYS.items():
            keyed[name] = stored.where(F.col("_gid") == _grouping_id(_GROUPING_SETS[name])).select(
                F.col("_key").alias(key), *[F.col(c).alias(to) for c, to in _names(name)]
            )
    else:
        for name, key in KEYS.items():
            keyed[name] = with_surrogate_key(members_of(members, name), key, NATURAL[name], rows=sizes[name][0])
    keyed["date"] = date_columns(keyed["date"], week_start)
    dims = Dimensions(**{name: Dimension(df, *sizes[name]) for name, df in keyed.items()})
    return dims.stored() if store and any(rows > SINGLE_TASK_ROWS for rows, _ in sizes.values()) else dims
