"""What the three layers share: where tables live and what a load reports."""

from __future__ import annotations

import logging
from dataclasses import dataclass

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layout:
    """The database of each layer; locations are optional."""

    raw: str = "mart_raw"
    enriched: str = "mart_enriched"
    aggregated: str = "mart_aggregated"
    location: str | None = None

    def location_of(self, database: str) -> str | None:
        return f"{self.location.rstrip('/')}/{database}" if self.location else None


@dataclass(frozen=True)
class LoadReport:
    """Counts of one published table.

    ``duplicates`` are rows that deduplication dropped, ``fan_out`` rows that joins
    added and ``rejected`` rows in quarantine; each is None where it was not asked for.
    """

    table: str
    rows: int
    null_rows: int
    duplicates: int | None = None
    fan_out: int | None = None
    rejected: int | None = None


class LayerError(RuntimeError):
    """A layer stopped, or ended with tables that failed."""

    def __init__(self, layer: str, failed: dict[str, Exception]) -> None:
        reasons = "; ".join(f"{table}: {error}" for table, error in failed.items())
        super().__init__(f"{layer} layer incomplete, failed tables: {reasons}")
        self.failed = failed


class EmptyTableError(ValueError):
    """A load without rows never replaces published data."""

    def __init__(self, table: str) -> None:
        super().__init__(f"{table} is empty, nothing was published")


def warn_about_nulls(table: str, columns: tuple[str, ...], null_rows: int) -> None:
    if null_rows:
        log.warning("%s: %d rows lack a value in one of %s", table, null_rows, list(columns))
