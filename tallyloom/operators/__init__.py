"""Lazy DataFrame-to-DataFrame operators. None of them starts a job."""

from tallyloom.operators.aggregate import aggregate, reaggregate, with_estimates
from tallyloom.operators.batches import latest_batch
from tallyloom.operators.columns import (
    any_null,
    clean,
    contract,
    preview,
    quoted,
    snake_case,
    snake_case_columns,
    stamp,
    trim_strings,
)
from tallyloom.operators.joins import enrich_left, lookup
from tallyloom.operators.quality import (
    audit,
    dedupe,
    duplicate_keys,
    duplicate_summary,
    fill_missing,
    join_growth,
)
from tallyloom.operators.reports import ROLLUPS, all_rollups, reports, rollup

__all__ = [
    "ROLLUPS",
    "aggregate",
    "all_rollups",
    "any_null",
    "audit",
    "clean",
    "contract",
    "dedupe",
    "duplicate_keys",
    "duplicate_summary",
    "enrich_left",
    "fill_missing",
    "join_growth",
    "latest_batch",
    "lookup",
    "preview",
    "quoted",
    "reaggregate",
    "reports",
    "rollup",
    "snake_case",
    "snake_case_columns",
    "stamp",
    "trim_strings",
    "with_estimates",
]
