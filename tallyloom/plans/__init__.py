"""The layers of the mart: lazy plans, and runners that check and publish them."""

from tallyloom.plans.aggregated import run_aggregated
from tallyloom.plans.enriched import complete, enrich, prepare, run_enriched
from tallyloom.plans.layers import EmptyTableError, LayerError, Layout, LoadReport
from tallyloom.plans.raw import land, land_checked, run_raw
from tallyloom.plans.reporting import report_tables

__all__ = [
    "EmptyTableError",
    "LayerError",
    "Layout",
    "LoadReport",
    "complete",
    "enrich",
    "land",
    "land_checked",
    "prepare",
    "report_tables",
    "run_aggregated",
    "run_enriched",
    "run_raw",
]
