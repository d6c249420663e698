"""Declarative descriptions of what each layer of the mart does.

Specs hold no Spark objects, so they can be built, compared and unit-tested
without a session. Table names are bare; the layer's database is added when a
plan runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SinkSpec:
    """How a result is stored.

    ``mode`` is ``overwrite`` (a new version replaces the old one) or ``append``
    (each run adds rows). ``rebalance`` lets adaptive execution even out file
    sizes before the write, splitting a partition that holds most of the rows.
    ``sort_by`` orders the rows within each file, without a global sort.
    """

    mode: str = "overwrite"
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    rebalance: bool = False
    sort_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.mode not in ("overwrite", "append"):
            raise ValueError(f"unknown sink mode {self.mode!r}")
        if bool(self.bucket_by) != (self.buckets > 0):
            raise ValueError("bucket_by and buckets must be given together")
        if self.mode == "append" and self.bucket_by and not self.partition_by:
            raise ValueError("an appended bucketed table needs partition_by")


@dataclass(frozen=True)
class SourceSpec:
    """A raw file source and the table it lands in.

    With ``quarantine``, rows of CSV and JSON sources that do not fit the declared schema
    land in a table of their own, named after this one with ``_rejected``.
    """

    table: str
    format: str
    file_name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)
    sink: SinkSpec = field(default_factory=SinkSpec)
    quarantine: bool = False


@dataclass(frozen=True)
class CleanRules:
    """Which columns get which cleaning. Columns a table lacks are skipped."""

    names: tuple[str, ...] = ()
    emails: tuple[str, ...] = ()
    phones: tuple[str, ...] = ()
    postal_codes: tuple[str, ...] = ()
    dates: Mapping[str, str] = field(default_factory=dict)
    years: Mapping[str, str] = field(default_factory=dict)
    rounding: Mapping[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class JoinSpec:
    """One left join: ``columns`` of ``table`` looked up by ``on``, one column or several.

    ``on_duplicate`` says what to do where the dimension repeats a key:
    ``fanout`` repeats the fact row, ``unique`` keeps one dimension row per key,
    ``error`` fails the job. ``colocated`` keeps the dimension's own partitioning,
    see ``lookup``.
    """

    table: str
    on: str | tuple[str, ...]
    columns: tuple[str, ...]
    on_duplicate: str = "fanout"
    colocated: bool = False


@dataclass(frozen=True)
class EnrichSpec:
    """Raw table to cleaned, deduplicated, joined and completed table.

    ``join_tasks`` deals the rows once for all joins, to about that many tasks, which saves
    shuffles where rows are many and dimensions small beside them but too large to broadcast.
    """

    table: str
    source: str
    key: tuple[str, ...]
    columns: tuple[str, ...]
    batch_column: str | None = None
    clean: CleanRules = field(default_factory=CleanRules)
    joins: tuple[JoinSpec, ...] = ()
    join_tasks: int | None = None
    critical: tuple[str, ...] = ()
    keep_null: tuple[str, ...] = ()
    count_duplicates: bool = True
    sink: SinkSpec = field(default_factory=SinkSpec)


@dataclass(frozen=True)
class Metric:
    """``function`` is one of ``sum``, ``count``, ``countDistinct``, ``distinctSketch``.

    ``scale`` states how many decimals a summed double column carries at most.
    """

    column: str
    function: str
    scale: int | None = None


@dataclass(frozen=True)
class AggregateSpec:
    """A stored aggregate over an enriched table."""

    table: str
    source: str
    group_by: tuple[str, ...]
    metrics: tuple[Metric, ...]
    order_by: tuple[str, ...] = ()
    sink: SinkSpec = field(default_factory=SinkSpec)
