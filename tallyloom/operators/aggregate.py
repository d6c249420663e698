"""Spec-driven aggregation and safe re-aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import exact, inexact, total
from tallyloom.operators.columns import quoted
from tallyloom.specs import AggregateSpec, Metric

# Metric names, names of stored measures, decimals of a stored total.
SUM, COUNT, DISTINCT, SKETCH = "sum", "count", "countDistinct", "distinctSketch"
TOTAL_PREFIX = "total_"
COUNT_SUFFIX = "_count"
DISTINCT_SUFFIX = "_distinct_count"
SKETCH_SUFFIX = "_distinct_sketch"
ESTIMATE_SUFFIX = "_distinct_estimate"
TOTAL_DIGITS = 2

#: Hashes that a distinct sketch keeps, as a power of two. Up to 2 ** 12 values are counted exactly,
#: as each is kept by 63 bits; beyond, the standard error of an estimate is about
#: 1 / sqrt(2 ** 12), 1.6 %. A sketch takes 32 KB at most.
SKETCH_BITS = 12


def _alias(metric: Metric) -> str:
    if metric.function == SUM:
        return TOTAL_PREFIX + metric.column
    suffixes = {COUNT: COUNT_SUFFIX, DISTINCT: DISTINCT_SUFFIX, SKETCH: SKETCH_SUFFIX}
    return metric.column + suffixes[metric.function]


def _parts(frame: DataFrame, name: str, scale: int | None) -> tuple[Column, Column | None]:
    """The exact and the inexact part of a summed column, if it can have one."""
    kind = frame.schema[name].dataType
    return exact(quoted(name), kind, scale), inexact(quoted(name), kind, scale)


def _total(parts: tuple[Column, Column | None]) -> Column:
    whole, rest = parts
    return total(F.sum(whole), None if rest is None else F.sum(rest), TOTAL_DIGITS)


def _check(metrics: Sequence[Metric]) -> None:
    for metric in metrics:
        if metric.function not in (SUM, COUNT, DISTINCT, SKETCH):
            raise ValueError(
                f"unknown metric {metric.function!r} for column {metric.column!r}: "
                f"use {SUM}, {COUNT}, {DISTINCT} or {SKETCH}"
            )
    names = [_alias(metric) for metric in metrics]
    if len(set(names)) < len(names):
        raise ValueError(f"the same measure is asked for twice: {names}")


def aggregate(frame: DataFrame, spec: AggregateSpec, ordered: bool = True) -> DataFrame:
    """Group by the dimensions of ``spec`` and compute its metrics.

    Every step combines rows within a task before it shuffles. An unknown metric
    fails here, as the plan is built.
    """
    _check(spec.metrics)
    counted = {metric.column for metric in spec.metrics if metric.function == DISTINCT}
    sketched = {metric.column for metric in spec.metrics if metric.function == SKETCH}
    if len(counted) == 1 and sketched <= counted and not counted & set(spec.group_by):
        grouped = _through_pairs(frame, spec, counted.pop())
    else:
        grouped = _direct(frame, spec)
    return grouped.orderBy(*map(quoted, spec.order_by)) if ordered and spec.order_by else grouped


def _direct(frame: DataFrame, spec: AggregateSpec) -> DataFrame:
    def measure(metric: Metric) -> Column:
        if metric.function == SUM:
            return _total(_parts(frame, metric.column, metric.scale))
        if metric.function == COUNT:
            return F.count(quoted(metric.column))
        if metric.function == SKETCH:
            return F.theta_sketch_agg(quoted(metric.column), SKETCH_BITS)
        return F.count_distinct(quoted(metric.column))

    return frame.groupBy(*map(quoted, spec.group_by)).agg(
        *(measure(metric).alias(_alias(metric)) for metric in spec.metrics)
    )


def _through_pairs(frame: DataFrame, spec: AggregateSpec, counted: str) -> DataFrame:
    """One distinct count: reduce to (group, value) pairs, then to groups.

    Pairs of a group that holds a third of the rows are spread over all tasks;
    what then meets in the group's task is one partial row per task. Where rows
    arrive partitioned by ``counted``, pairs need no shuffle at all.
    """
    per_pair, per_group = [], []
    for place, metric in enumerate(spec.metrics):
        partial = f"_m{place}"
        if metric.function == SUM:
            whole, rest = _parts(frame, metric.column, metric.scale)
            per_pair.append(F.sum(whole).alias(partial))
            if rest is not None:
                per_pair.append(F.sum(rest).alias(f"_r{place}"))
            measure = _total((F.col(partial), None if rest is None else F.col(f"_r{place}")))
        elif metric.function == COUNT:
            per_pair.append(F.count(quoted(metric.column)).alias(partial))
            measure = F.coalesce(F.sum(partial), F.lit(0))
        elif metric.function == SKETCH:
            measure = F.theta_sketch_agg("_counted", SKETCH_BITS)
        else:
            measure = F.count("_counted")
        per_group.append(measure.alias(_alias(metric)))
    groups = [quoted(name) for name in spec.group_by]
    value = quoted(counted).alias("_counted")
    if per_pair:
        pairs = frame.groupBy(*groups, value).agg(*per_pair)
    else:
        pairs = frame.select(*groups, value).distinct()
    return pairs.groupBy(*groups).agg(*per_group)


def reaggregate(frame: DataFrame, group_by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Coarser totals and counts from stored ones, without reading the base table.

    Distinct counts of finer groups overlap and cannot be added, so asking for
    one is an error. Distinct sketches can be united: their estimates answer for
    coarser groups without the base table.
    """
    for name in measures:
        if name.endswith(DISTINCT_SUFFIX):
            raise ValueError(f"a distinct count cannot be re-aggregated: {name}")
        if not (name.startswith(TOTAL_PREFIX) or name.endswith((COUNT_SUFFIX, SKETCH_SUFFIX))):
            raise ValueError(f"not a stored total, count or sketch: {name}")
    return frame.groupBy(*map(quoted, group_by)).agg(*(resum(frame, name) for name in measures))


def resum(frame: DataFrame, name: str) -> Column:
    """The sum of one stored total or count, or the union of a stored sketch."""
    if name.endswith(SKETCH_SUFFIX):
        return F.theta_union_agg(quoted(name), SKETCH_BITS).alias(name)
    if name.startswith(TOTAL_PREFIX):
        return _total(_parts(frame, name, TOTAL_DIGITS)).alias(name)
    return F.sum(quoted(name)).alias(name)


def with_estimates(frame: DataFrame) -> DataFrame:
    """Every distinct sketch read as the distinct count it estimates."""
    columns = []
    for name in frame.columns:
        if name.endswith(SKETCH_SUFFIX):
            estimate = name.removesuffix(SKETCH_SUFFIX) + ESTIMATE_SUFFIX
            columns.append(F.theta_sketch_estimate(quoted(name)).alias(estimate))
        else:
            columns.append(quoted(name))
    return frame.select(*columns)
