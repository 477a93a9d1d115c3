"""Rules as data, with a verdict for every row that breaks one.

A rule table (table, kind, columns, param) is compiled to columns.  One pass over a
table tests all its row rules; rules on distinct values come from one pre-aggregated
count of their columns each, whose shuffle carries those columns and the row key only.
``quarantine`` splits the fact by all rules.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.operators.dedup import repeated_keys
from txlake.operators.dimensions import Dimensions
from txlake.operators.joins import checked_broadcast
from txlake.operators.quality import DIM_KEYS, RULES, Rule, broken
from txlake.sources.files import materialize

ROW_KEYS = {"fact_transactions": "transaction_id", **DIM_KEYS}
DISTINCT = ("primary_key", "unique")


def compile_rules(rows: Iterable[tuple]) -> list[Rule]:
    """Rules from rows of (table, kind, columns, param): columns are joined by ``+``;
    a ``check`` has a SQL condition that must not be false as its param, ``one_of`` a
    list of values joined by ``|``, ``max_length`` a number, ``foreign_key`` a table."""
    out = []
    for table, kind, columns, param in rows:
        if kind == "max_length":
            param = int(param)
        elif kind == "one_of":
            param = tuple(param.split("|"))
        out.append(Rule(table, kind, tuple(columns.split("+")), param))
    return out


def _with_keys(df: DataFrame, rules: list[Rule], dims: Dimensions) -> DataFrame:
    """``df`` with a mark for each dimension its foreign keys are found in."""
    for r in rules:
        if r.kind == "foreign_key":
            dim = dims.named()[r.param]
            keys = dim.df.select(F.col(DIM_KEYS[r.param]).alias(r.columns[0])).distinct().withColumn(f"_has_{r.param}", F.lit(True))
            df = df.join(checked_broadcast(keys, rows=dim.rows, size=dim.size), r.columns[0], "left")
    return df


def _names(rules: list[Rule]) -> Column:
    """Names of the row rules that a row breaks."""
    tests = [F.when(broken(r), F.lit(r.name)) for r in rules if r.kind not in DISTINCT]
    return F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")


def rule_verdicts(fact: DataFrame, dims: Dimensions, rules: list[Rule] | None = None) -> DataFrame:
    """(table_name, row_key, rule, n_violations): one row for each row key and rule it
    breaks.  Of the rows with one value of a distinct rule all but one are violations,
    under the smallest of their row keys.  Sums by rule are the constraint report."""
    rules = RULES if rules is None else rules
    tables = {"fact_transactions": fact, **dims.tables()}
    if any(r.kind in DISTINCT for r in rules if r.table == "fact_transactions"):
        tables["fact_transactions"] = materialize(fact, "verdict_fact")  # read once for each distinct rule
    found = []
    for name, df in tables.items():
        own = [r for r in rules if r.table == name]
        if not own:
            continue
        key = F.col(ROW_KEYS[name]).cast("string").alias("row_key")
        rows = _with_keys(df, own, dims).select(key, F.explode(_names(own)).alias("rule"))
        found.append(rows.groupBy("row_key", "rule").agg(F.count(F.lit(1)).alias("n_violations")).withColumn("table_name", F.lit(name)))
        for r in own:
            if r.kind in DISTINCT:
                # a null is no value of a single column; a combination may hold nulls
                values = df.where(F.col(r.columns[0]).isNotNull()) if len(r.columns) == 1 else df
                groups = values.groupBy(*[F.col(c).alias(f"_{c}") for c in r.columns])
                counts = groups.agg(F.min(F.col(ROW_KEYS[name]).cast("string")).alias("row_key"), F.count(F.lit(1)).alias("_n"))
                found.append(
                    counts.where("_n > 1").select(
                        "row_key", F.lit(r.name).alias("rule"), (F.col("_n") - 1).alias("n_violations"), F.lit(name).alias("table_name")
                    )
                )
    every = reduce(DataFrame.unionByName, found)
    return every.select("table_name", "row_key", "rule", "n_violations")


def quarantine(fact: DataFrame, dims: Dimensions, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(passing, quarantined): the fact split by all its rules; quarantined rows have
    the names of the rules they break.  All rows that share a value of a distinct rule
    are quarantined.  The fact is tested once and written with its verdicts."""
    own = [r for r in (RULES if rules is None else rules) if r.table == "fact_transactions"]
    tested = _with_keys(fact, own, dims).select(*fact.columns, _names(own).alias("broken_rules"))
    for i, r in enumerate(r for r in own if r.kind in DISTINCT):
        repeats = materialize(repeated_keys(fact, list(r.columns)), "quarantine_keys")
        if len(r.columns) == 1:
            repeats = repeats.where(F.col(r.columns[0]).isNotNull())
        side = repeats.select(*[F.col(c).alias(f"_q{c}") for c in r.columns], F.lit(True).alias(f"_rep{i}"))
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_q{c}")) for c in r.columns])
        name = F.when(F.col(f"_rep{i}"), F.array(F.lit(r.name))).otherwise(F.array().cast("array<string>"))
        tested = tested.join(checked_broadcast(side), same, "left").select(
            *fact.columns, F.concat(name, "broken_rules").alias("broken_rules")
        )
    held = materialize(tested, "quarantine")
    return held.where(F.size("broken_rules") == 0).drop("broken_rules"), held.where(F.size("broken_rules") > 0)
