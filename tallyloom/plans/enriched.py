"""Enriched layer: clean, deduplicate, join, complete.

The order of steps carries meaning. Joins come before nulls are filled, so that
a missing key matches nothing; audits count nulls before they are filled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import (
    any_null,
    clean,
    contract,
    dedupe,
    duplicate_summary,
    enrich_left,
    fill_missing,
    latest_batch,
    quoted,
    snake_case_columns,
    trim_strings,
)
from tallyloom.plans.layers import (
    EmptyTableError,
    LayerError,
    Layout,
    LoadReport,
    warn_about_nulls,
)
from tallyloom.sinks import (
    add_run,
    add_staged,
    create_database,
    discard,
    publish,
    qualified,
    stage,
    staged_without,
)
from tallyloom.specs import EnrichSpec

# Fixed value: the column that records when a row was processed.
PROCESSED_COLUMN = "enriched_at"

#: Marks, in the files of a staged version only, rows that lack a critical value.
LACKS_COLUMN = "_lacks_critical"


def standardise(source: DataFrame, spec: EnrichSpec) -> DataFrame:
    """The newest batch under snake_case names, trimmed and cleaned: one projection."""
    if spec.batch_column:
        source = latest_batch(source, spec.batch_column)
    return clean(trim_strings(snake_case_columns(source)), spec.clean)


def prepare(
    source: DataFrame, spec: EnrichSpec, dimensions: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Standardised, one row per key, joined. Missing values are still null."""
    rows = dedupe(standardise(source, spec), spec.key)
    return enrich_left(rows, dimensions or {}, spec.joins, spec.join_tasks)


def complete(prepared: DataFrame, spec: EnrichSpec, at: datetime | None = None) -> DataFrame:
    """Fill what is missing and keep the contract columns."""
    filled = fill_missing(prepared, spec.key, spec.keep_null)
    return contract(filled, spec.columns, PROCESSED_COLUMN, at)


def enrich(
    source: DataFrame,
    spec: EnrichSpec,
    dimensions: Mapping[str, DataFrame] | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """The whole enrichment of one table as one lazy plan."""
    return complete(prepare(source, spec, dimensions), spec, at)


def _marked(prepared: DataFrame, spec: EnrichSpec, at: datetime | None) -> DataFrame:
    """The completed rows, each with a mark that tells whether a critical value was missing."""
    marked = prepared.withColumn(LACKS_COLUMN, any_null(spec.critical or spec.key))
    rows = complete(marked, replace(spec, columns=(*spec.columns, LACKS_COLUMN)), at)
    others = [name for name in rows.columns if name != LACKS_COLUMN]
    return rows.select(*map(quoted, others), LACKS_COLUMN)


def load_enriched(
    spark: SparkSession,
    spec: EnrichSpec,
    layout: Layout,
    at: datetime | None = None,
    run: str | None = None,
) -> LoadReport:
    """Run one enrichment: a single job writes the table, and its files are audited.

    What was missing before nulls were filled is marked in the staged files and counted
    from that one column. So the counts are those of the files that were committed,
    however often a lost executor made a task repeat, and the plan runs once. The table
    that is published does not have the mark.

    An appending sink adds the rows of this load to those stored; the report is
    about this load. With ``run``, the rows of an earlier load under the same name go.
    """
    source = spark.table(qualified(layout.raw, spec.source))
    dimensions = {
        join.table: spark.table(qualified(layout.enriched, join.table)) for join in spec.joins
    }
    prepared = prepare(source, spec, dimensions)
    staged = stage(_marked(prepared, spec, at), spec.sink, layout.enriched, spec.table)
    counts = spark.table(staged).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(LACKS_COLUMN).alias("null_rows")
    ).first()
    rows = counts.row_count
    if not rows:
        discard(spark, staged)
        raise EmptyTableError(spec.table)
    staged = staged_without(spark, staged, spec.sink, layout.enriched, spec.table, [LACKS_COLUMN])
    if spec.sink.mode == "append" and run is not None:
        add_run(spark, staged, spec.sink, run, layout.enriched, spec.table)
    elif spec.sink.mode == "append":
        add_staged(spark, staged, spec.sink, layout.enriched, spec.table)
    else:
        publish(spark, staged, layout.enriched, spec.table)
    warn_about_nulls(spec.table, spec.critical or spec.key, counts.null_rows)

    duplicates = fan_out = None
    if spec.count_duplicates:
        keys = duplicate_summary(standardise(source, spec), spec.key).first()
        duplicates, fan_out = keys.dropped, rows - keys.key_count
    return LoadReport(spec.table, rows, counts.null_rows, duplicates, fan_out)


def run_enriched(
    spark: SparkSession,
    specs: Sequence[EnrichSpec],
    layout: Layout,
    at: datetime | None = None,
    run: str | None = None,
) -> list[LoadReport]:
    """Enrich tables in order, dimensions first; the first failure stops the layer.

    ``run`` names this run in tables that are appended to: repeated, it replaces its rows.
    """
    create_database(spark, layout.enriched, layout.location_of(layout.enriched))
    done: list[LoadReport] = []
    for spec in specs:
        try:
            done.append(load_enriched(spark, spec, layout, at, run))
        except Exception as error:
            raise LayerError("enriched", {spec.table: error}) from error
    return done
