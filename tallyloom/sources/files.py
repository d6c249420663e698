"""CSV, JSON and workbook sources behind one call.

A source may be one file or a folder of files. Multi-line CSV and JSON-array
files are read by one task each, because only a parser that starts at the first
byte knows where a record begins; such data scales by the number of files.
Line-delimited files (``multiLine`` off) are split by size like any other.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tallyloom.operators.columns import stamp
from tallyloom.sources.schema import declared_schema
from tallyloom.sources.workbooks import parse_workbooks
from tallyloom.specs import SourceSpec

# Fixed value: the column that tells load batches apart.
BATCH_COLUMN = "ingested_at"

WORKBOOK_FORMAT = "xlsx"


def source_path(base: str, spec: SourceSpec) -> str:
    return f"{base.rstrip('/')}/{spec.file_name}.{spec.format}"


def read_source(
    spark: SparkSession, spec: SourceSpec, path: str, at: datetime | None = None
) -> DataFrame:
    """The rows of a source under its declared schema, stamped with the load time."""
    schema = declared_schema(spec.columns)
    if spec.format == WORKBOOK_FORMAT:
        files = spark.read.format("binaryFile").options(**spec.options).load(path)
        rows = parse_workbooks(files, schema)
    else:
        rows = spark.read.format(spec.format).schema(schema).options(**spec.options).load(path)
    return stamp(rows, BATCH_COLUMN, at)
