"""Aggregated layer: stored totals that every report reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import SparkSession

from tallyloom.operators import aggregate
from tallyloom.plans.layers import LayerError, Layout, LoadReport
from tallyloom.sinks import add_run, add_staged, create_database, publish, qualified, stage
from tallyloom.specs import AggregateSpec


def run_aggregated(
    spark: SparkSession,
    specs: Sequence[AggregateSpec],
    layout: Layout,
    run: str | None = None,
) -> list[LoadReport]:
    """Rebuild every aggregate in full; failures are collected and raised at the end.

    The rows of each file are sorted by the spec's order, so that files can be
    skipped by their ranges. There is no global sort: reading a table back promises
    no order, and reports sort the little they show. An appending sink adds this
    run's rows to those stored; with ``run``, in the place of those that an earlier
    run of that name has stored.
    """
    create_database(spark, layout.aggregated, layout.location_of(layout.aggregated))
    done: list[LoadReport] = []
    failed: dict[str, Exception] = {}
    for spec in specs:
        try:
            source = spark.table(qualified(layout.enriched, spec.source))
            result = aggregate(source, spec, ordered=False)
            sink = spec.sink
            if spec.order_by and not sink.sort_by:
                sink = replace(sink, sort_by=spec.order_by)
            staged = stage(result, sink, layout.aggregated, spec.table)
            rows = spark.table(staged).count()
            if sink.mode == "append" and run is not None:
                add_run(spark, staged, sink, run, layout.aggregated, spec.table)
            elif sink.mode == "append":
                add_staged(spark, staged, sink, layout.aggregated, spec.table)
            else:
                publish(spark, staged, layout.aggregated, spec.table)
            done.append(LoadReport(spec.table, rows, 0))
        except Exception as error:
            failed[spec.table] = error
    if failed:
        raise LayerError("aggregated", failed)
    return done
