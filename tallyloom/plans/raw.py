"""Raw layer: source files land as tables with declared schemas."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import audit, quoted
from tallyloom.plans.layers import (
    EmptyTableError,
    LayerError,
    Layout,
    LoadReport,
    warn_about_nulls,
)
from tallyloom.sinks import (
    add_staged,
    create_database,
    discard,
    publish,
    qualified,
    replace_batch,
    stage,
    staged_without,
)
from tallyloom.sources import read_checked, read_source, source_path
from tallyloom.sources.files import BATCH_COLUMN
from tallyloom.sources.quarantine import FILE, HEADER, NO_HEADER, REASON, RECORD, SWAPPED
from tallyloom.specs import SinkSpec, SourceSpec

log = logging.getLogger(__name__)


def land(frame: DataFrame, spec: SourceSpec, layout: Layout, at: datetime) -> LoadReport:
    """Store rows stamped with the load time ``at`` and report on them.

    The source is parsed once, into a staged version. The audit reads only the key
    columns of the files just written, and no row is visible before it. An appended
    table is partitioned by load time unless the sink says otherwise, so any later
    pick of the newest batch reads that batch alone. Loading a batch again replaces
    it under any partitioning. A load without rows leaves published data as it was,
    and fails.
    """
    spark = frame.sparkSession
    sink = spec.sink
    if sink.mode == "append":
        sink = replace(sink, partition_by=sink.partition_by or (BATCH_COLUMN,))
    staged = stage(frame, sink, layout.raw, spec.table)
    counts = audit(spark.table(staged), spec.key).first()
    if not counts.row_count:
        discard(spark, staged)
        raise EmptyTableError(spec.table)
    if sink.mode == "append":
        _add_batch(staged, sink, spec.table, layout, at)
    else:
        publish(spark, staged, layout.raw, spec.table)
    warn_about_nulls(spec.table, spec.key, counts.null_rows)
    return LoadReport(spec.table, counts.row_count, counts.null_rows)


REJECTED = "_rejected"


def land_checked(frame: DataFrame, spec: SourceSpec, layout: Layout, at: datetime) -> LoadReport:
    """Store the fitting rows of a checked read, and the others in a table of their own.

    The source is parsed and written once: one staged version keeps both kinds in folders
    of their own, and the good ones become visible without being moved. A CSV file whose
    header is missing or in another order is rejected as a whole; only a delivery with
    such files has its good rows written a second time, from the staged version.

    The other table has the columns ``reason``, ``record``, ``file`` and the load time,
    and is published first, so that it also tells why a load ended empty.
    """
    spark = frame.sparkSession
    own = spec.sink
    if own.mode == "append":
        own = replace(own, partition_by=own.partition_by or (BATCH_COLUMN,))
    apart = replace(own, partition_by=(REJECTED, *own.partition_by))
    marked = frame.withColumn(REJECTED, F.col(REASON).isNotNull())
    staged = stage(marked, apart, layout.raw, spec.table)
    rows = spark.table(staged)
    extra = [REASON, RECORD, FILE, REJECTED]
    bad_files = _bad_files(rows) if spec.format == "csv" else None
    if bad_files is not None and not bad_files.isEmpty():
        of_bad = rows.join(bad_files, rows[FILE].eqNullSafe(bad_files["bad_file"]), "left")
        declared = [name for name, _ in spec.columns]
        line = F.to_csv(F.struct(*(quoted(name).alias(f"c{i}") for i, name in enumerate(declared))))
        judged = of_bad.withColumns(
            {
                RECORD: F.when(F.col("why").isNotNull(), F.coalesce(RECORD, line)).otherwise(F.col(RECORD)),
                REASON: F.when(F.col(REASON).isNull(), F.col("why")).otherwise(F.col(REASON)),
            }
        ).withColumn(REJECTED, F.col(REASON).isNotNull())
        again = stage(judged.select(*map(quoted, rows.columns)), apart, layout.raw, spec.table)
        discard(spark, staged)
        staged, rows = again, spark.table(again)
    rejected = _quarantine(rows, spec, layout, at)
    good = rows.where(~F.col(REJECTED)).drop(*extra)
    counts = audit(good, spec.key).first()
    if not counts.row_count:
        discard(spark, staged)
        raise EmptyTableError(spec.table)
    bare = staged_without(spark, staged, own, layout.raw, spec.table, extra, f"{REJECTED}=false")
    if own.mode == "append":
        _add_batch(bare, own, spec.table, layout, at)
    else:
        publish(spark, bare, layout.raw, spec.table)
    warn_about_nulls(spec.table, spec.key, counts.null_rows)
    if rejected:
        log.warning("%s: %d rows were rejected", spec.table, rejected)
    return LoadReport(spec.table, counts.row_count, counts.null_rows, rejected=rejected)


def _bad_files(rows: DataFrame) -> DataFrame:
    """(bad_file, why) of the files without exactly the declared header."""
    of_file = rows.groupBy(F.col(FILE).alias("bad_file")).agg(
        F.bool_or(F.coalesce(F.col(REASON) == HEADER, F.lit(False))).alias("headed"),
        F.bool_or(F.coalesce(F.col(REASON) == SWAPPED, F.lit(False))).alias("swapped"),
    )
    why = F.when(F.col("swapped"), SWAPPED).when(~F.col("headed"), NO_HEADER)
    return of_file.select("bad_file", why.alias("why")).where("why IS NOT NULL")


def _quarantine(rows: DataFrame, spec: SourceSpec, layout: Layout, at: datetime) -> int:
    """Store the rejected rows and count them; header lines are none."""
    spark, table = rows.sparkSession, spec.table + REJECTED
    lines = rows.where(F.col(REJECTED) & ~F.col(REASON).isin(HEADER))
    kept = lines.select(
        F.col(REASON).alias("reason"), F.col(RECORD).alias("record"), F.col(FILE).alias("file"), BATCH_COLUMN
    )
    sink = SinkSpec(mode=spec.sink.mode, partition_by=(BATCH_COLUMN,) if spec.sink.mode == "append" else ())
    staged = stage(kept, sink, layout.raw, table)
    count = spark.table(staged).count()
    if sink.mode == "append":
        _add_batch(staged, sink, table, layout, at)
    else:
        publish(spark, staged, layout.raw, table)
    return count


def _add_batch(staged: str, sink: SinkSpec, table: str, layout: Layout, at: datetime) -> None:
    """Add the staged batch of ``at``, or put it in the place of the same batch.

    Where load time is the first partition column, a batch is replaced alone. Under
    another layout the table is written anew with the other batches.
    """
    spark = SparkSession.active()
    target = qualified(layout.raw, table)
    this_batch = F.col(BATCH_COLUMN) == F.lit(at)
    known = spark.catalog.tableExists(target)
    if not known or spark.table(target).where(this_batch).isEmpty():
        add_staged(spark, staged, sink, layout.raw, table)
    elif sink.partition_by[0] == BATCH_COLUMN:
        replace_batch(spark.table(staged), sink, at, layout.raw, table)
        discard(spark, staged)
    else:
        stored = spark.table(target)
        others = stored.where(~F.coalesce(this_batch, F.lit(False)))
        rows = others.unionByName(spark.table(staged).select(*map(quoted, stored.columns)))
        publish(spark, stage(rows, sink, layout.raw, table), layout.raw, table)
        discard(spark, staged)


def run_raw(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    base_path: str,
    layout: Layout,
    at: datetime | None = None,
) -> list[LoadReport]:
    """Land every source in order under one load time; the first failure stops the layer."""
    at = at or datetime.now(timezone.utc)
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    done: list[LoadReport] = []
    for spec in specs:
        try:
            path = source_path(base_path, spec)
            if spec.quarantine:
                done.append(land_checked(read_checked(spark, spec, path, at), spec, layout, at))
            else:
                done.append(land(read_source(spark, spec, path, at), spec, layout, at))
        except Exception as error:
            raise LayerError("raw", {spec.table: error}) from error
    return done
