"""Layered sales data mart as lazy Spark DataFrame operators."""

from tallyloom.specs import (
    AggregateSpec,
    CleanRules,
    EnrichSpec,
    JoinSpec,
    Metric,
    SinkSpec,
    SourceSpec,
)

__all__ = [
    "AggregateSpec",
    "CleanRules",
    "EnrichSpec",
    "JoinSpec",
    "Metric",
    "SinkSpec",
    "SourceSpec",
]
