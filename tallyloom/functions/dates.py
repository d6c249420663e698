"""Date parsing that yields null, never an error, for text that is no date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(value: Column, pattern: str) -> Column:
    return F.try_to_date(value, pattern)


def year_of(value: Column) -> Column:
    return F.year(value)
