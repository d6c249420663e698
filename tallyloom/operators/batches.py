"""Selecting the newest load of a table that keeps several."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.columns import quoted

log = logging.getLogger(__name__)


def latest_batch(frame: DataFrame, column: str, period: str | None = None) -> DataFrame:
    """Rows of the newest batch, without the batch column.

    A batch is one value of the column or, with ``period`` (``day``, ``hour`` and so
    on), all times from the start of the newest one's period. The column itself is
    compared, so the range reaches the files.

    The maximum is a scalar subquery, so this stays one lazy plan. On a table
    partitioned by the batch column the filter prunes whole batches before
    anything is read. Rows with no batch value belong to no batch and are left
    out. A frame without the column is returned as it is, with a warning.
    """
    if column not in frame.columns:
        log.warning("no batch column %r, keeping every row", column)
        return frame
    if period:
        start = frame.select(F.date_trunc(period, F.max(quoted(column)))).scalar()
        return frame.where(quoted(column) >= start).drop(column)
    newest = frame.select(F.max(quoted(column))).scalar()
    return frame.where(quoted(column) == newest).drop(column)
