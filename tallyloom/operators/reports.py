"""The profit rollups, read from the stored aggregate."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import reaggregate, resum


class Rollup(NamedTuple):
    """Dimensions of a report and its order; a leading ``-`` means descending."""

    dimensions: tuple[str, ...]
    order_by: tuple[str, ...]


MEASURE = "total_profit"

# Dimensions and order of each report. The id breaks ties.
ROLLUPS: Mapping[str, Rollup] = MappingProxyType(
    {
        "profit_by_year": Rollup(("order_year",), ("order_year",)),
        "profit_by_year_category": Rollup(
            ("order_year", "category"), ("order_year", "category")
        ),
        "profit_by_customer": Rollup(
            ("customer_id", "customer_name"), ("-total_profit", "customer_id", "customer_name")
        ),
        "profit_by_customer_year": Rollup(
            ("customer_id", "customer_name", "order_year"),
            ("customer_name", "customer_id", "order_year"),
        ),
    }
)


def sort_key(name: str) -> Column:
    return F.desc(name[1:]) if name.startswith("-") else F.asc(name)


def rollup(frame: DataFrame, name: str) -> DataFrame:
    """One report over the stored aggregate, sorted."""
    dimensions, order_by = ROLLUPS[name]
    return reaggregate(frame, dimensions, [MEASURE]).orderBy(*map(sort_key, order_by))


def reports(frame: DataFrame) -> dict[str, DataFrame]:
    """All reports, each a lazy frame."""
    return {name: rollup(frame, name) for name in ROLLUPS}


def all_rollups(frame: DataFrame) -> DataFrame:
    """Every report from one scan of the aggregate, told apart by ``rollup``.

    Dimensions that a report does not use are null in its rows.
    """
    used = {name for report in ROLLUPS.values() for name in report.dimensions}
    dimensions = [name for name in frame.columns if name in used]
    sets = [[F.col(name) for name in report.dimensions] for report in ROLLUPS.values()]
    # grouping_id has one bit per dimension, set where the dimension is left out.
    level = F.lit(None).cast("string")
    for name, report in ROLLUPS.items():
        bits = sum(
            1 << (len(dimensions) - 1 - place)
            for place, dimension in enumerate(dimensions)
            if dimension not in report.dimensions
        )
        level = F.when(F.grouping_id() == bits, name).otherwise(level)
    return frame.groupingSets(sets, *(F.col(name) for name in dimensions)).agg(
        level.alias("rollup"), resum(frame, MEASURE)
    )
