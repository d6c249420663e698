"""Writing, checking and publishing tables.

An overwrite goes to a new folder under the database's own location and is
registered under a staging name. Publishing points the table's entry at the new
folder where schema and layout stay the same; else it renames the old entry
aside, the new one in, and drops the old one. These are catalog operations on
external tables: no data file moves or is copied, whatever the size, running
readers keep the files they opened, and a plan may overwrite a table that it
reads. ``recover`` puts back a table whose publishing broke off between the
renames. Folders of earlier versions stay until ``expire_versions``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.operators.columns import quoted
from tallyloom.specs import SinkSpec


def qualified(database: str, table: str) -> str:
    return f"`{database}`.`{table.lower()}`"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def register_view(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def _writer(frame: DataFrame, sink: SinkSpec) -> DataFrameWriter:
    if sink.rebalance:
        frame = frame.hint("rebalance", *(quoted(name) for name in sink.partition_by))
    if sink.sort_by and not sink.bucket_by:
        frame = frame.sortWithinPartitions(*map(quoted, (*sink.partition_by, *sink.sort_by)))
    writer = frame.write.format(sink.format).options(**sink.options)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    if sink.bucket_by:
        writer = writer.bucketBy(sink.buckets, *sink.bucket_by).sortBy(*sink.bucket_by)
    return writer


def stage(frame: DataFrame, sink: SinkSpec, database: str, table: str) -> str:
    """Write a new version beside the current one; returns its staging name."""
    version = uuid.uuid4().hex
    root = frame.sparkSession.catalog.getDatabase(database).locationUri.rstrip("/")
    staged = qualified(database, f"{table}__{version}")
    _writer(frame, sink).option("path", f"{root}/{table.lower()}/version={version}").saveAsTable(
        staged
    )
    return staged


def staged_without(
    spark: SparkSession,
    staged: str,
    sink: SinkSpec,
    database: str,
    table: str,
    columns: Sequence[str],
    folder: str = "",
) -> str:
    """The staged version under a new staging name, without some of its columns.

    Its files stay as they are: formats that find columns by name skip what the new
    entry does not name. ``folder`` narrows the entry to one folder of the version, that
    of a partition column among ``columns``.
    """
    place = f"{_described(spark, staged)['Location'].rstrip('/')}/{folder}".rstrip("/")
    kept = StructType([item for item in spark.table(staged).schema if item.name not in columns])
    bare = qualified(database, f"{table}__{uuid.uuid4().hex}")
    _register(spark, bare, kept, sink, place)
    if sink.partition_by:
        spark.sql(f"ALTER TABLE {bare} RECOVER PARTITIONS")
    spark.sql(f"DROP TABLE {staged}")
    return bare


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(names: Sequence[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "`" for name in names)


def _register(
    spark: SparkSession, name: str, schema: StructType, sink: SinkSpec, place: str
) -> None:
    """An entry for a folder of files; its partitions are added by other commands."""
    parts = [f"CREATE TABLE {name} ({schema.toDDL()}) USING {sink.format}"]
    if sink.options:
        options = ", ".join(f"{_literal(key)} {_literal(value)}" for key, value in sink.options.items())
        parts.append(f"OPTIONS ({options})")
    if sink.partition_by:
        parts.append(f"PARTITIONED BY ({_named(sink.partition_by)})")
    if sink.bucket_by:
        by = _named(sink.bucket_by)
        parts.append(f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {sink.buckets} BUCKETS")
    spark.sql(" ".join([*parts, f"LOCATION {_literal(place)}"]))


ASIDE = "__replaced"


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: its columns by place, and its layout by name."""
    found: dict[str, str] = {}
    for place, row in enumerate(spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()):
        detail = row.col_name in ("Location", "Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
        found[row.col_name if detail else f"{place}: {row.col_name}"] = row.data_type
    return found


def _layout(described: dict[str, str]) -> list[tuple[str, str]]:
    """Columns, format and buckets, without what differs between versions."""
    layout = []
    for name, value in described.items():
        if name.endswith(": # Detailed Table Information"):
            break
        layout.append((name, value))
    kept = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    return layout + [(name, described[name]) for name in kept if name in described]


def publish(spark: SparkSession, staged: str, database: str, table: str) -> str:
    """Put a staged version in the table's place, whatever its schema was before.

    Readers find a table at any moment, but for the instant between two renames
    where the schema changes; ``recover`` ends a publishing that broke off there.
    """
    target = qualified(database, table)
    recover(spark, database, table)
    if not spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
        return target
    new, old = _described(spark, staged), _described(spark, target)
    partitioned = any("# Partition" in name for name in new)
    if not partitioned and _layout(new) == _layout(old):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{new['Location']}'")
        spark.sql(f"DROP TABLE {staged}")
        return target
    aside = qualified(database, table + ASIDE)
    spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {target}")
    spark.sql(f"DROP TABLE {aside}")
    return target


def recover(spark: SparkSession, database: str, table: str) -> None:
    """Finish a publishing that broke off: put the old table back, or forget it if replaced."""
    target, aside = qualified(database, table), qualified(database, table + ASIDE)
    if spark.catalog.tableExists(aside):
        if spark.catalog.tableExists(target):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")


def expire_versions(spark: SparkSession, database: str, table: str, keep: int = 1) -> int:
    """Delete the folders of a table's versions but the published and the ``keep`` newest others.

    Versions that are staged or set aside count as others; those that are still being
    written do not, nor do those that hold a run of the table. Readers of a deleted
    version fail, so keep as many as the longest query may need. Returns how many
    went.
    """
    recover(spark, database, table)
    target = qualified(database, table)
    used = [_described(spark, target)["Location"], *committed_runs(spark, database, table).values()]
    current = {part for place in used for part in place.split("/") if part.startswith("version=")}
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{table.lower()}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0
    versions = [
        (status.getModificationTime(), status.getPath())
        for status in files.listStatus(folder)
        if status.getPath().getName().startswith("version=")
        and status.getPath().getName() not in current
        and not files.exists(status.getPath().suffix("/_temporary"))
    ]
    old = sorted(versions, key=lambda version: version[0], reverse=True)[keep:]
    for _, path in old:
        files.delete(path, True)
    return len(old)


def add_staged(
    spark: SparkSession, staged: str, sink: SinkSpec, database: str, table: str
) -> str:
    """Append a staged version's rows to the table, creating it on first use."""
    if not spark.catalog.tableExists(qualified(database, table)):
        return publish(spark, staged, database, table)
    target = append_rows(spark.table(staged), sink, database, table)
    discard(spark, staged)
    return target


# Fixed value: the column that tells the runs of an appended table apart.
RUN_COLUMN = "run_id"


def add_run(
    spark: SparkSession, staged: str, sink: SinkSpec, run: str, database: str, table: str
) -> str:
    """Show a staged version's rows as those of one run, in the place of what the run had before.

    The table is partitioned by run, and a partition's entry in the catalog is the run's
    record: it names the folder of the version that counts. One catalog operation adds or
    moves it, so a run that is repeated, after a failure or not, counts once, readers see
    all of its rows or none, and no row is written twice.
    """
    if sink.partition_by or sink.bucket_by:
        raise ValueError("a table of runs is partitioned by run alone")
    target = qualified(database, table)
    rows = spark.table(staged).schema
    if not spark.catalog.tableExists(target):
        root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        schema = StructType([*rows, StructField(RUN_COLUMN, StringType())])
        by_run = replace(sink, partition_by=(RUN_COLUMN,))
        _register(spark, target, schema, by_run, f"{root}/{table.lower()}/runs")
    known = [(item.name, item.dataType) for item in spark.table(target).schema]
    if known != [*((item.name, item.dataType) for item in rows), (RUN_COLUMN, StringType())]:
        raise ValueError(f"{table} has other columns than this run")
    partition = f"PARTITION ({RUN_COLUMN} = {_literal(run)})"
    place = _literal(_described(spark, staged)["Location"])
    if run in committed_runs(spark, database, table):
        spark.sql(f"ALTER TABLE {target} {partition} SET LOCATION {place}")
    else:
        spark.sql(f"ALTER TABLE {target} ADD PARTITION ({RUN_COLUMN} = {_literal(run)}) LOCATION {place}")
    discard(spark, staged)
    return target


def committed_runs(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    """The folder of each run of a table; none where the table is not kept by runs."""
    target = qualified(database, table)
    if not spark.catalog.tableExists(target) or RUN_COLUMN not in spark.table(target).columns:
        return {}
    partitioned = [column.name for column in spark.catalog.listColumns(target) if column.isPartition]
    if partitioned != [RUN_COLUMN]:
        return {}
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {target}").collect():
        run = unquote(row.partition.partition("=")[2])
        described = spark.sql(
            f"DESCRIBE TABLE EXTENDED {target} PARTITION ({RUN_COLUMN} = {_literal(run)})"
        ).collect()
        found[run] = next(line.data_type for line in described if line.col_name == "Location")
    return found


def discard(spark: SparkSession, staged: str) -> None:
    """Forget a staged version that failed its checks."""
    spark.sql(f"DROP TABLE IF EXISTS {staged}")


def append_rows(frame: DataFrame, sink: SinkSpec, database: str, table: str) -> str:
    """Add rows to a table, creating it on first use."""
    target = qualified(database, table)
    writer = _writer(frame, sink).mode("append")
    if not frame.sparkSession.catalog.tableExists(target):
        root = frame.sparkSession.catalog.getDatabase(database).locationUri.rstrip("/")
        writer = writer.option("path", f"{root}/{table.lower()}/appended")
    writer.saveAsTable(target)
    return target


def replace_batch(
    frame: DataFrame, sink: SinkSpec, batch: datetime, database: str, table: str
) -> str:
    """Put rows in the place of one batch, named by the first partition column."""
    spark, target = frame.sparkSession, qualified(database, table)
    batch_column, *finer = sink.partition_by
    written = batch.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f+00:00")
    partition = ", ".join(
        [f"`{batch_column}` = TIMESTAMP'{written}'", *(f"`{name}`" for name in finer)]
    )
    stored = [name for name in spark.table(target).columns if name != batch_column]
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION ({partition}) SELECT * FROM {{rows}}",
        rows=frame.select(*(quoted(name) for name in stored)),
    )
    return target
