"""Compare a Spark result with DuckDB SQL over the same parquet tables:
row count, column names, and the multiset of row values."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, _dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, _dt.date):
        return ("d", v.isoformat())
    if isinstance(v, Decimal):
        return ("n", str(v.normalize()) if v == v else "nan")
    if isinstance(v, float):
        return ("f", repr(v))
    if v is None:
        return ("", "")
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("i", str(v))
    return ("s", str(v))


def compare(spark_df, sql: str, con) -> dict:
    cols = spark_df.columns
    rows = spark_df.collect()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    out = {"rows_spark": len(rows), "rows_oracle": len(drows)}
    out["columns_match"] = sorted(cols) == sorted(dcols)
    if not out["columns_match"]:
        out["columns"] = (cols, dcols)
        out["match"] = False
        return out
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in drows)
    out["match"] = a == b
    if not out["match"]:
        diff_a = [x for x in a if x not in set(b)][:3]
        diff_b = [x for x in b if x not in set(a)][:3]
        out["sample_spark_only"] = diff_a
        out["sample_oracle_only"] = diff_b
    out["types_spark"] = [f.dataType.simpleString() for f in spark_df.schema.fields]
    out["types_oracle"] = [str(t) for t in rel.types]
    return out
