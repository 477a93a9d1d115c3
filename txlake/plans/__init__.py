"""End-to-end plans: the batch pipeline, the registered queries and their
reference SQL."""

from txlake.plans.batch import BatchResult, StarSchema, build_star, export_to_warehouse, load_star, run_batch
from txlake.plans import load_oracle, load_queries, oracle, queries
from txlake.plans.incremental import ReloadResult, extend_dimension, extend_dimensions, reload_window, replace_partitions
from txlake.plans.queries import FLAGSHIP

QUERIES = queries.QUERIES | load_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql() | load_oracle.oracle_sql()



__all__ = [
    "FLAGSHIP",
    "QUERIES",
    "BatchResult",
    "ReloadResult",
    "StarSchema",
    "build_star",
    "export_to_warehouse",
    "extend_dimension",
    "extend_dimensions",
    "load_star",
    "oracle_sql",
    "reload_window",
    "replace_partitions",
    "run_batch",
]
