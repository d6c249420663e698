"""Reports over the stored aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators import reports
from tallyloom.plans.layers import Layout
from tallyloom.sinks import qualified, register_view


def report_tables(
    spark: SparkSession, table: str, layout: Layout, view: str | None = None
) -> dict[str, DataFrame]:
    """Every report by name; ``view`` also opens the aggregate to plain SQL."""
    stored = spark.table(qualified(layout.aggregated, table))
    register_view(stored, view or f"v_{table}")
    return reports(stored)
