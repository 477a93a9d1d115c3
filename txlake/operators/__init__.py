"""DataFrame -> DataFrame operators: cleaning, dedup, dimensions, fact, star
joins, reports and data-quality checks."""

from txlake.operators.clean import clean_columns, clean_transactions
from txlake.operators.dedup import dedup_by_key, dedup_conflicts
from txlake.operators.dimensions import (
    Dimension,
    Dimensions,
    build_dimensions,
    with_surrogate_key,
)
from txlake.operators.fact import build_fact, split_rejects
from txlake.operators.joins import checked_broadcast
from txlake.operators.quality import (
    RULES,
    Rule,
    constraint_report,
    defect_profile,
    defect_reconciliation,
    missing_surface_by_type,
    parse_failures,
    stage_counts,
)
from txlake.operators.reports import avg_price_by_region_type_quarter, null_aware_measures, status_breakdown
from txlake.operators.star import flatten, star_join

__all__ = [
    "RULES",
    "Dimension",
    "Dimensions",
    "Rule",
    "avg_price_by_region_type_quarter",
    "build_dimensions",
    "build_fact",
    "checked_broadcast",
    "clean_columns",
    "clean_transactions",
    "constraint_report",
    "dedup_by_key",
    "dedup_conflicts",
    "defect_profile",
    "defect_reconciliation",
    "flatten",
    "missing_surface_by_type",
    "null_aware_measures",
    "parse_failures",
    "split_rejects",
    "stage_counts",
    "star_join",
    "status_breakdown",
    "with_surrogate_key",
]
