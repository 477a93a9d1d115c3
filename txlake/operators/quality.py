"""Data-quality reports: defect profile, reconciliation, integrity rules, counts.

The warehouse enforced its integrity rules (primary keys, UNIQUE, NOT NULL,
foreign keys, column lengths, SMALLINT ranges) by failing a load.  Here the
same rules are declared as data (``Rule``) and evaluated by Spark as one
aggregation per table -- a report of violations per rule, so a bad load is
detected without aborting it.  Foreign keys are checked in the same pass over
the fact through broadcast joins to the (size-checked) dimension keys.

Plain counts are conditional aggregates in one pass that shuffle one row per
task.  On unbounded tables (raw, clean, fact) each exact distinct count
(duplicate keys, primary keys) is its own distinct-only aggregation: its
shuffle carries the counted column and nothing else (in one combined
aggregation Spark would carry every other aggregate's buffer through the key
shuffle), and it is pre-aggregated per map task, so a hot key cannot overload
a task.  The one-row results are combined without a join.  Dimensions, bounded
by their counted sizes, are checked in a single aggregation each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.dimensions import Dimensions
from txlake.operators.joins import DEFAULT_BROADCAST_ROWS, checked_broadcast
from txlake.schemas import SMALLINT_MAX, SMALLINT_MIN, VARCHAR_LIMITS


def _is_missing(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def _key_groups(df: DataFrame, key: str, alias: str = "key_groups") -> DataFrame:
    """One row: the number of groups a keyed dedup forms (a null key is one
    group).  A distinct-only aggregation, so its shuffle carries the key column
    and nothing else."""
    return df.agg(F.count_distinct(F.struct(F.col(key))).alias(alias))


def _combine(frames: list[DataFrame], names: list[str]) -> DataFrame:
    """Merge one-row frames of bigint columns (distinct names) into one row,
    without a join: each becomes (name, value) rows, and one aggregation over
    those few rows pivots them back."""
    parts = []
    for f in frames:
        pairs = ", ".join(f"'{c}', `{c}`" for c in f.columns)
        parts.append(f.select(F.expr(f"stack({len(f.columns)}, {pairs}) as (name, value)")))
    long = reduce(DataFrame.unionByName, parts)
    return long.agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def _long_format(one_row: DataFrame, names: list[str], name_col: str, value_col: str, keep: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return one_row.select(*keep, F.expr(f"stack({len(names)}, {pairs}) as ({name_col}, {value_col})"))


# The four documented defects of the raw export, in the order
# they are documented, with what cleaning does to each.
DEFECTS = ["duplicate_rows", "comma_prices", "missing_surface", "missing_city"]
HANDLING = {
    "duplicate_rows": "removed",
    "comma_prices": "repaired",
    "missing_surface": "kept_null",
    "missing_city": "kept_null",
}


def defect_profile(raw: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Count and share of each documented defect in a raw table (one pass).

    Columns: defect, n_rows, total_rows, share.
    """
    flags = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("price_mad").contains(",")).alias("comma_prices"),
        F.count_if(_is_missing("surface_m2")).alias("missing_surface"),
        F.count_if(_is_missing("city")).alias("missing_city"),
    )
    names = ["total_rows", "comma_prices", "missing_surface", "missing_city", "key_groups"]
    one = _combine([flags, _key_groups(raw, key)], names).withColumn(
        "duplicate_rows", F.col("total_rows") - F.col("key_groups")
    )
    return _long_format(one, DEFECTS, "defect", "n_rows", ["total_rows"]).select(
        "defect",
        "n_rows",
        "total_rows",
        F.try_divide(F.col("n_rows").cast("double"), F.col("total_rows").cast("double")).alias("share"),
    )


def missing_surface_by_type(raw: DataFrame) -> DataFrame:
    """Missing surface per property type (the defect is documented for land).

    Columns: property_type, n_rows, n_missing_surface, share.
    """
    return (
        raw.groupBy("property_type")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(_is_missing("surface_m2")).alias("n_missing_surface"),
        )
        .withColumn("share", F.try_divide(F.col("n_missing_surface").cast("double"), F.col("n_rows").cast("double")))
    )


# The typed cleaning rules whose failures are counted.
PARSED_FIELDS = ["price_mad", "surface_m2", "transaction_date"]


def parse_failures(raw: DataFrame) -> DataFrame:
    """Non-empty raw values that a typed rule could not parse (one pass).

    Cleaning turns unparsable or overflowing text into null, where the
    warehouse would have rejected the load; this report keeps those rows
    visible instead of letting them pass as missing values.
    Columns: field, n_failed.
    """
    from txlake.functions import date_parse, price_clean, surface_clean

    rules = {"price_mad": price_clean, "surface_m2": surface_clean, "transaction_date": date_parse}
    present = {c: F.col(c).isNotNull() & (F.col(c) != "") for c in PARSED_FIELDS}
    one = raw.agg(*[F.count_if(present[c] & rules[c](c).isNull()).alias(c) for c in PARSED_FIELDS])
    return _long_format(one, PARSED_FIELDS, "field", "n_failed", [])


def defect_reconciliation(raw: DataFrame, key: str = "transaction_id") -> DataFrame:
    """What cleaning did with each documented defect.

    Columns: defect, handling, raw_rows (rows with the defect), n_ids (ids with
    it; a null id is one) and n_handled: rows removed as duplicates, ids whose
    comma price parsed, ids whose missing value is kept null.  One
    pre-aggregated pass by id; nothing can be negative.
    """
    from txlake.functions import price_clean

    comma = F.coalesce(F.col("price_mad").contains(","), F.lit(False))
    parsed = comma & price_clean("price_mad").isNotNull()
    flags = {"comma": comma, "parsed": parsed, "surface": _is_missing("surface_m2"), "city": _is_missing("city")}
    per_id = raw.groupBy(F.struct(key).alias("id")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(f).alias(name) for name, f in flags.items()]
    )
    rows = lambda c: F.coalesce(F.sum(c), F.lit(0))
    ids = lambda c: F.count_if(F.col(c) > 0)
    surplus = F.col("n") - 1
    cells = {
        "duplicate_rows": (rows(surplus), F.count_if(surplus > 0), rows(surplus)),
        "comma_prices": (rows("comma"), ids("comma"), ids("parsed")),
        "missing_surface": (rows("surface"), ids("surface"), ids("surface")),
        "missing_city": (rows("city"), ids("city"), ids("city")),
    }
    one = per_id.agg(*[c.cast("long").alias(f"{d}_{k}") for d in DEFECTS for k, c in enumerate(cells[d])])
    stacked = ", ".join(f"'{d}', '{HANDLING[d]}', {d}_0, {d}_1, {d}_2" for d in DEFECTS)
    return one.select(F.expr(f"stack({len(DEFECTS)}, {stacked}) as (defect, handling, raw_rows, n_ids, n_handled)"))


def stage_counts(raw: DataFrame, clean: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts at the three pipeline stages."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")
        for stage, df in (("raw", raw), ("clean", clean), ("fact", fact))
    ]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------------------
# Integrity rules
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One integrity rule on a star table.

    kind: primary_key (duplicated non-null key values), not_null, unique
    (null-safe, over one or more columns), max_length (param = limit),
    smallint (value outside SMALLINT), foreign_key (param = dimension key's
    table; a non-null key with no dimension row).
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    param: object = None

    @property
    def name(self) -> str:
        return f"{self.table}.{'+'.join(self.columns)}:{self.kind}"


def _rules() -> list[Rule]:
    # fixed values: the rules that the warehouse declares
    R = Rule
    rules = [
        R("fact_transactions", "primary_key", ("transaction_id",)),
        *[
            R("fact_transactions", "not_null", (c,))
            for c in (
                "transaction_id",
                "listing_id",
                "date_id",
                "property_type_id",
                "location_id",
                "registration_status_id",
                "source_office",
                "price_mad",
            )
        ],
        R("fact_transactions", "foreign_key", ("date_id",), "dim_date"),
        R("fact_transactions", "foreign_key", ("property_type_id",), "dim_property_type"),
        R("fact_transactions", "foreign_key", ("location_id",), "dim_location"),
        R("fact_transactions", "foreign_key", ("registration_status_id",), "dim_registration_status"),
        R("dim_date", "primary_key", ("date_id",)),
        R("dim_date", "not_null", ("date_id",)),
        R("dim_date", "not_null", ("full_date",)),
        R("dim_date", "unique", ("full_date",)),
        *[R("dim_date", "not_null", (c,)) for c in ("year", "quarter", "month", "day_of_week")],
        *[R("dim_date", "smallint", (c,)) for c in ("year", "quarter", "month", "day_of_week")],
        R("dim_property_type", "primary_key", ("property_type_id",)),
        R("dim_property_type", "not_null", ("property_type_id",)),
        R("dim_property_type", "not_null", ("property_type_name",)),
        R("dim_property_type", "unique", ("property_type_name",)),
        R("dim_location", "primary_key", ("location_id",)),
        R("dim_location", "not_null", ("location_id",)),
        R("dim_location", "not_null", ("region",)),
        R("dim_location", "unique", ("region", "city")),
        R("dim_registration_status", "primary_key", ("registration_status_id",)),
        R("dim_registration_status", "not_null", ("registration_status_id",)),
        R("dim_registration_status", "not_null", ("status_name",)),
        R("dim_registration_status", "unique", ("status_name",)),
    ]
    for qualified, limit in VARCHAR_LIMITS.items():
        tbl, col = qualified.split(".")
        rules.append(R(tbl, "max_length", (col,), limit))
    return rules


RULES: list[Rule] = _rules()

DIM_KEYS = {
    "dim_date": "date_id",
    "dim_property_type": "property_type_id",
    "dim_location": "location_id",
    "dim_registration_status": "registration_status_id",
}


_DISTINCT_KINDS = ("primary_key", "unique")


def _counted(rule: Rule) -> Column:
    """Rows a distinct rule counts: non-null keys, or every row for a
    multi-column (null-safe) uniqueness rule."""
    return F.count(F.col(rule.columns[0])) if len(rule.columns) == 1 else F.count(F.lit(1))


def _distinct_values(rule: Rule) -> Column:
    cols = [F.col(c) for c in rule.columns]
    # null-safe for several columns: (r, null) twice is a duplicate member
    return F.count_distinct(cols[0]) if len(cols) == 1 else F.count_distinct(F.struct(*cols))


def broken(rule: Rule) -> Column:
    """Whether a row breaks a row rule (false, never null)."""
    c = F.col(rule.columns[0])
    tests = {
        "not_null": lambda: c.isNull(),
        "max_length": lambda: F.length(c) > F.lit(rule.param),
        "smallint": lambda: (c < SMALLINT_MIN) | (c > SMALLINT_MAX),
        "foreign_key": lambda: c.isNotNull() & F.col(f"_has_{rule.param}").isNull(),
        "check": lambda: ~F.expr(rule.param),
        "one_of": lambda: ~c.isin(*rule.param),
    }
    if rule.kind not in tests:
        raise ValueError(f"unknown rule kind {rule.kind!r}")
    return F.coalesce(tests[rule.kind](), F.lit(False))


def _rule_agg(rule: Rule) -> Column:
    return F.count_if(broken(rule))


def constraint_report(
    fact: DataFrame,
    dims: Dimensions,
    rules: list[Rule] | None = None,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Violations per rule: columns rule, table_name, kind, violations.  The fact is
    written once, as several aggregations read it."""
    from txlake.sources.files import materialize

    rules = RULES if rules is None else rules
    fact = materialize(fact, "report_fact")
    tables = {"fact_transactions": fact, **dims.tables()}
    dimension = {
        "dim_date": dims.date,
        "dim_property_type": dims.property_type,
        "dim_location": dims.location,
        "dim_registration_status": dims.registration_status,
    }
    reports = []
    for tname, base in tables.items():
        trules = [r for r in rules if r.table == tname]
        if not trules:
            continue
        df = base
        for r in trules:
            if r.kind == "foreign_key":
                # one broadcast join per key, all in the same pass over the fact;
                # keys are de-duplicated so a broken dimension cannot multiply facts
                dim = dimension[r.param]
                keys = (
                    dim.df.select(F.col(DIM_KEYS[r.param]).alias(r.columns[0]))
                    .distinct()
                    .withColumn(f"_has_{r.param}", F.lit(True))
                )
                df = df.join(checked_broadcast(keys, rows=dim.rows, max_rows=max_broadcast_rows, size=dim.size), r.columns[0], "left")
        plain = [
            (_counted(r) if r.kind in _DISTINCT_KINDS else _rule_agg(r)).cast("long").alias(f"r{i}")
            for i, r in enumerate(trules)
        ]
        distinct = [(f"d{i}", _distinct_values(r)) for i, r in enumerate(trules) if r.kind in _DISTINCT_KINDS]
        names = [f"r{i}" for i in range(len(trules))] + [n for n, _ in distinct]
        if tname == "fact_transactions":
            # the unbounded table: plain counts in one pass (one row per task
            # shuffled), each exact distinct count in its own aggregation over
            # the base table, whose shuffle carries only the counted column
            one = _combine([df.agg(*plain), *[base.agg(d.alias(n)) for n, d in distinct]], names)
        else:
            # a dimension, bounded by its counted size: one aggregation
            one = df.agg(*plain, *[d.alias(n) for n, d in distinct])
        values = [
            (F.col(f"r{i}") - F.col(f"d{i}")) if r.kind in _DISTINCT_KINDS else F.col(f"r{i}")
            for i, r in enumerate(trules)
        ]
        one = one.select(*[v.alias(f"v{i}") for i, v in enumerate(values)])
        pairs = ", ".join(f"'{r.name}', v{i}" for i, r in enumerate(trules))
        reports.append(one.select(F.expr(f"stack({len(trules)}, {pairs}) as (rule, violations)")))
    kinds = fact.sparkSession.createDataFrame(
        [(r.name, r.table, r.kind) for r in rules], "rule string, table_name string, kind string"
    )
    return reduce(DataFrame.unionByName, reports).join(F.broadcast(kinds), "rule").select(
        "rule", "table_name", "kind", "violations"
    )
