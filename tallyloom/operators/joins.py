"""Left joins that never lose a fact row.

No join carries a hint. Spark broadcasts a dimension only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles
both sides; adaptive execution then splits the partitions of a hot key. It can
do so only for rows that are exchanged for the join, so a dimension that already
lies partitioned by the key, because it was grouped or joined by it, is exchanged
once more.

Facts that are too large to be exchanged for every lookup can be dealt to a grid of
tasks instead, once for all lookups; see ``lookup_all``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType

from tallyloom.operators.columns import any_null, quoted
from tallyloom.operators.quality import dedupe
from tallyloom.specs import JoinSpec


def key_columns(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _fan_out(dimension: DataFrame, on: list[str]) -> DataFrame:
    return dimension


def _unique(dimension: DataFrame, on: list[str]) -> DataFrame:
    return dedupe(dimension, on)


def _error(needed: DataFrame, on: list[str]) -> DataFrame:
    """One row per key, or a failure naming a repeated key once the plan runs."""
    keys = [quoted(name) for name in on]
    per_key = needed.groupBy(*keys).agg(
        F.min(F.struct(*(quoted(name) for name in needed.columns))).alias("_row"),
        F.count(F.lit(1)).alias("_copies"),
    )
    repeated = F.raise_error(
        F.concat(
            F.lit(f"dimension key {', '.join(on)} occurs more than once: "),
            F.concat_ws(", ", *(key.cast("string") for key in keys)),
        )
    )
    checked = F.when(F.col("_copies") == 1, F.col("_row")).otherwise(repeated)
    return per_key.select(checked.alias("_row")).select("_row.*")


# Fixed value: the column that holds a row's task while it is looked up.
_CELL = "_cell"

_DUPLICATE_RULES = {"fanout": _fan_out, "unique": _unique, "error": _error}


def _exchanged(name: str) -> Column:
    """The column's own value in a form whose partitioning is not known to be the column's."""
    return F.element_at(F.array(quoted(name)), 1).alias(name)


def _keyed(
    frame: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    columns: Sequence[str],
    on_duplicate: str,
) -> DataFrame:
    """What ``frame`` looks up: rows without a null key, repeated keys dealt with as asked."""
    if on_duplicate not in _DUPLICATE_RULES:
        raise ValueError(
            f"on_duplicate must be one of {sorted(_DUPLICATE_RULES)}, not {on_duplicate!r}"
        )
    present = sorted(set(columns) & set(frame.columns))
    if present:
        raise ValueError(f"columns already present before the join on {', '.join(keys)}: {present}")
    needed = dimension.select(*map(quoted, keys), *map(quoted, columns))
    for key in keys:
        needed = needed.where(quoted(key).isNotNull())
    return _DUPLICATE_RULES[on_duplicate](needed, keys)


def lookup(
    frame: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    columns: Sequence[str],
    on_duplicate: str = "fanout",
    colocated: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``columns`` of ``dimension`` to every row of ``frame``, null where unmatched.

    ``on`` is one key column or several; a row with a null in any matches nothing.
    ``colocated`` joins where the dimension lies, as for tables bucketed by the key;
    it saves the exchanges but leaves a hot key in one task. ``partitions`` deals both
    sides by the keys to that many tasks, which adaptive execution neither merges nor
    splits: it bounds what a task holds where more work on the same keys follows.
    """
    keys = key_columns(on)
    keyed = _keyed(frame, dimension, keys, columns, on_duplicate)
    if not colocated:
        keyed = keyed.select(*map(_exchanged, keys), *map(quoted, columns))
    if partitions:
        frame = frame.repartition(partitions, *map(quoted, keys))
        keyed = keyed.repartition(partitions, *map(quoted, keys))
    return frame.join(keyed, keys, "left")


def enrich_left(
    frame: DataFrame,
    dimensions: Mapping[str, DataFrame],
    joins: Sequence[JoinSpec],
    tasks: int | None = None,
) -> DataFrame:
    """The left joins of a spec, in order; with ``tasks``, by ``lookup_all`` where it can be used."""
    if tasks and can_deal(frame, dimensions, joins):
        return lookup_all(frame, dimensions, joins, tasks)
    for join in joins:
        frame = lookup(
            frame, dimensions[join.table], join.on, join.columns, join.on_duplicate, join.colocated
        )
    return frame


def can_deal(
    frame: DataFrame, dimensions: Mapping[str, DataFrame], joins: Sequence[JoinSpec]
) -> bool:
    """Whether ``lookup_all`` answers these joins: several, by keys of ``frame`` that hash alike.

    Equal values of two types, or of a collation, can have different hashes.
    """
    facts = {item.name: item.dataType for item in frame.schema}
    used = [*facts, *(name for join in joins for name in join.columns)]
    if len(joins) < 2 or any(name.startswith(_CELL) for name in used):
        return False
    for join in joins:
        found = {item.name: item.dataType for item in dimensions[join.table].schema}
        for key in key_columns(join.on):
            if not _hashes_alike(facts.get(key)) or found.get(key) != facts[key]:
                return False
    return True


def _hashes_alike(kind: DataType | None) -> bool:
    return isinstance(kind, (IntegralType, DateType)) or kind == StringType()


def lookup_all(
    frame: DataFrame,
    dimensions: Mapping[str, DataFrame],
    joins: Sequence[JoinSpec],
    tasks: int,
) -> DataFrame:
    """All lookups after a single exchange of the facts, for dimensions that are far smaller.

    The tasks form a grid with one axis per lookup. A fact goes to the one cell that the hashes
    of its keys name; a dimension row goes to all cells of its place on its own axis. So facts
    are sent once instead of once per lookup, and dimension rows as often as the other axes are
    long, about the square root of ``tasks`` for two lookups. A key that holds a third of the facts
    is dealt over the other axes, facts with a null key over their own axis too. Facts that have all
    their keys in common meet in one task, which adaptive execution does not split.
    """
    sides = [1] * len(joins)
    while prod(sides) < tasks:
        sides[sides.index(min(sides))] += 1

    whole = [item.name for item in frame.schema if _hashes_alike(item.dataType)]
    places = []
    for axis, join in enumerate(joins):
        keys = key_columns(join.on)
        own, any_other = _place(keys, axis, sides), _place(whole, axis, sides)
        places.append(F.when(any_null(keys), any_other).otherwise(own))
    frame = _dealt(frame.withColumn(_CELL, _cell(places, sides)), sides)

    for axis, join in enumerate(joins):
        keys = key_columns(join.on)
        keyed = _keyed(frame, dimensions[join.table], keys, join.columns, join.on_duplicate)
        places = []
        for other, side in enumerate(sides):
            if other == axis:
                places.append(_place(keys, axis, sides))
            else:
                keyed = keyed.withColumn(f"{_CELL}{other}", F.explode(F.sequence(F.lit(0), F.lit(side - 1))))
                places.append(F.col(f"{_CELL}{other}"))
        keyed = keyed.select(_cell(places, sides).alias(_CELL), *map(quoted, keys), *map(quoted, join.columns))
        frame = frame.join(_dealt(keyed, sides), [_CELL, *keys], "left")
    return frame.drop(_CELL)


def _place(names: Sequence[str], axis: int, sides: Sequence[int]) -> Column:
    """Where the values lie on an axis; equal values lie apart on another one."""
    return F.pmod(F.xxhash64(F.lit(axis), *map(quoted, names)), F.lit(sides[axis]))


def _cell(places: Sequence[Column], sides: Sequence[int]) -> Column:
    number = F.lit(0)
    for place, side in zip(places, sides):
        number = number * F.lit(side) + place
    return number.cast("int")


def _dealt(frame: DataFrame, sides: Sequence[int]) -> DataFrame:
    return frame.repartitionById(prod(sides), _CELL)
