"""Renames, projections, predicates and rule-driven cleaning.

Each operator adds one projection however many columns it touches, so plans
stay small and everything collapses into the scan's stage.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyloom.functions import (
    clean_name,
    normalise_phone,
    pad_postal,
    parse_date,
    round_half_up,
    validate_email,
    year_of,
)
from tallyloom.specs import CleanRules

_CAMEL_BOUNDARY = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WORD_BREAK = re.compile(r"[-.\s_]+")
_NOT_WORD = re.compile(r"[^a-z0-9]")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    escaped = name.replace("`", "``")
    return F.col(f"`{escaped}`")


def snake_case(name: str) -> str:
    """``Sub-Category`` -> ``sub_category``, ``OrderDate`` -> ``order_date``."""
    words = _WORD_BREAK.split(_CAMEL_BOUNDARY.sub("_", name).lower())
    kept = (_NOT_WORD.sub("", word) for word in words)
    return "_".join(word for word in kept if word)


def snake_case_columns(frame: DataFrame) -> DataFrame:
    """Rename every column; refuse names that vanish or meet another name."""
    renamed = [snake_case(name) for name in frame.columns]
    counts = Counter(renamed)
    clashes = sorted(
        name for name, target in zip(frame.columns, renamed) if not target or counts[target] > 1
    )
    if clashes:
        raise ValueError(f"columns cannot be told apart in snake_case: {clashes}")
    return frame.toDF(*renamed)


def trim_strings(frame: DataFrame) -> DataFrame:
    """Strip spaces from both ends of every string column."""
    return frame.select(
        *(
            F.trim(quoted(item.name)).alias(item.name)
            if isinstance(item.dataType, StringType)
            else quoted(item.name)
            for item in frame.schema
        )
    )


def clean(frame: DataFrame, rules: CleanRules) -> DataFrame:
    """Apply all cleaning rules in one projection.

    Rules for columns the frame lacks are skipped. A year is derived from the
    parsed form of its date, and only for a date that the rules parse.
    """
    values = {name: quoted(name) for name in frame.columns}

    def rewrite(names: Iterable[str], change) -> None:
        for name in names:
            if name in values:
                values[name] = change(name, values[name])

    rewrite(rules.names, lambda _, value: clean_name(value))
    rewrite(rules.emails, lambda _, value: validate_email(value))
    rewrite(rules.phones, lambda _, value: normalise_phone(value))
    rewrite(rules.dates, lambda name, value: parse_date(value, rules.dates[name]))
    for year, date in rules.years.items():
        if date in rules.dates and date in values:
            values[year] = year_of(values[date])
    rewrite(rules.postal_codes, lambda _, value: pad_postal(value))
    rewrite(rules.rounding, lambda name, value: round_half_up(value, rules.rounding[name]))
    return frame.select(*(value.alias(name) for name, value in values.items()))


def stamp(frame: DataFrame, column: str, at: datetime | None = None) -> DataFrame:
    """Add a processing time: the query's own, or a given one for exact re-runs."""
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return frame.withColumn(column, moment)


def contract(
    frame: DataFrame,
    columns: Sequence[str],
    stamp_column: str | None = None,
    at: datetime | None = None,
) -> DataFrame:
    """Exactly these columns in this order, then the processing time if asked for."""
    selected = frame.select(*(quoted(name) for name in columns))
    return selected if stamp_column is None else stamp(selected, stamp_column, at)


def any_null(columns: str | Sequence[str]) -> Column:
    """True where at least one of the columns is null; false for no columns."""
    names = [columns] if isinstance(columns, str) else columns
    return reduce(lambda found, name: found | quoted(name).isNull(), names, F.lit(False))


def preview(frame: DataFrame, rows: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first rows in a stated order, planned as a top-k without a full sort."""
    return frame.orderBy(*order_by).limit(rows)
