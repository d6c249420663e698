"""Sources read so that rows that do not fit the declared schema can be told apart.

A record is parsed once. What a plain read would bind wrongly, cut or set to null
comes out with a reason and as it was delivered.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.operators.columns import quoted, stamp
from tallyloom.sources.files import BATCH_COLUMN
from tallyloom.sources.schema import declared_schema
from tallyloom.specs import SourceSpec

#: Columns of a checked read beside the declared ones.
REASON, RECORD, FILE = "_reason", "_record", "_file"

HEADER = "header"
SWAPPED = "header in another order"
NO_HEADER = "file without the declared header"
FIELDS = "other number of fields"
NO_ARRAY = "no JSON array"
UNREADABLE = "unreadable"


def _bad_values(schema: StructType, texts: Mapping[str, Column], values: Mapping[str, Column]) -> Column:
    """``bad value in`` and the columns whose text was read as no value; else null."""
    bad = F.filter(
        F.array(
            *(
                F.when(texts[name].isNotNull() & values[name].isNull(), F.lit(name))
                for name in schema.names
            )
        ),
        lambda name: name.isNotNull(),
    )
    return F.when(F.size(bad) > 0, F.concat(F.lit("bad value in "), F.array_join(bad, ", ")))


def _text_schema(schema: StructType) -> StructType:
    """Every field as text, under names that need no quoting."""
    fields = [StructField(f"c{place}", StringType()) for place in range(len(schema))]
    return StructType([*fields, StructField(RECORD, StringType())])


def _checked_csv(spark: SparkSession, spec: SourceSpec, path: str, schema: StructType) -> DataFrame:
    """Header lines come out as records: a file's other rows are judged by them later."""
    options = {name: value for name, value in spec.options.items() if name.lower() != "header"}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    with_record = StructType([*schema, StructField(RECORD, StringType())])
    rows = spark.read.format("csv").schema(with_record).options(**options, header=False).load(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias(FILE))
    texts = _text_schema(schema)
    again = F.from_csv(F.col(RECORD), texts.simpleString()[len("struct<") : -1].replace(":", " "), options)
    rows = rows.withColumn("_again", F.when(F.col(RECORD).isNotNull(), again))
    fields = [F.col(f"_again.c{place}") for place in range(len(schema))]
    if all(isinstance(item.dataType, StringType) for item in schema):
        fields = [
            F.coalesce(field, F.when(F.col(RECORD).isNull(), quoted(name)))
            for field, name in zip(fields, schema.names)
        ]
    exact = reduce(and_, (field.eqNullSafe(F.lit(name)) for field, name in zip(fields, schema.names)))
    swapped = F.array_sort(F.array(*fields)) == F.array_sort(F.array(*map(F.lit, schema.names)))
    bad = _bad_values(
        schema, dict(zip(schema.names, fields)), {name: quoted(name) for name in schema.names}
    )
    reason = (
        F.when(exact, HEADER)
        .when(F.coalesce(swapped, F.lit(False)), SWAPPED)
        .when(F.col(RECORD).isNotNull() & F.col(f"_again.{RECORD}").isNotNull(), FIELDS)
        .when(F.col(RECORD).isNotNull(), F.coalesce(bad, F.lit(UNREADABLE)))
    )
    return rows.withColumn(REASON, reason).drop("_again")


def _checked_json(spark: SparkSession, spec: SourceSpec, path: str, schema: StructType) -> DataFrame:
    """One record per element of each file's array, or per line of line-delimited files."""
    multi_line = str(spec.options.get("multiLine", "false")).lower() == "true"
    options = {name: value for name, value in spec.options.items() if name.lower() != "multiline"}
    options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD}
    files = spark.read.text(path, wholetext=multi_line).select(
        "value", F.col("_metadata.file_path").alias(FILE)
    )
    whole = F.trim("value")
    if multi_line:
        single = F.array("value")
        elements = F.when(whole.startswith("["), F.from_json("value", "array<string>")).otherwise(single)
        files = files.withColumn("_parts", elements).select(
            FILE,
            F.explode(F.coalesce("_parts", single)).alias("_text"),
            F.col("_parts").isNull().alias("_broken"),
        )
    else:
        files = files.where(whole != "").select(FILE, F.col("value").alias("_text"), F.lit(False).alias("_broken"))
    with_record = StructType([*schema, StructField(RECORD, StringType())])
    as_text = StructType([StructField(item.name, StringType()) for item in schema])
    rows = files.select(
        FILE,
        "_text",
        "_broken",
        F.from_json("_text", with_record, options).alias("_typed"),
        F.from_json("_text", as_text, dict(spec.options)).alias("_texts"),
    )
    typed = {name: F.col("_typed").getField(name) for name in schema.names}
    texts = {name: F.col("_texts").getField(name) for name in schema.names}
    broken = F.coalesce(F.col("_broken"), F.lit(True)) | F.col("_text").isNull() | F.col("_typed").isNull()
    corrupt = F.col("_typed").getField(RECORD).isNotNull()
    reason = F.when(broken, NO_ARRAY if multi_line else UNREADABLE).otherwise(
        F.coalesce(_bad_values(schema, texts, typed), F.when(corrupt, UNREADABLE))
    )
    record = F.coalesce("_text", F.lit("null"))
    values = [column.alias(name) for name, column in typed.items()]
    return rows.select(*values, FILE, reason.alias(REASON), record.alias("_kept")).select(
        *map(quoted, schema.names), FILE, REASON, F.when(F.col(REASON).isNotNull(), F.col("_kept")).alias(RECORD)
    )


def read_checked(
    spark: SparkSession, spec: SourceSpec, path: str, at: datetime | None = None
) -> DataFrame:
    """The rows of a CSV or JSON source with ``_reason``, ``_record`` and ``_file``.

    Rows that fit have no reason, and the values a plain read gives. Others carry the
    record as delivered. A CSV file's header line is a record with the reason ``header``,
    or with that of a header in another order, which concerns all rows of the file.
    """
    schema = declared_schema(spec.columns)
    if spec.format == "csv":
        rows = _checked_csv(spark, spec, path, schema)
    elif spec.format == "json":
        rows = _checked_json(spark, spec, path, schema)
    else:
        raise ValueError(f"{spec.format} sources have no quarantine")
    columns = [*schema.names, REASON, RECORD, FILE]
    return stamp(rows.select(*map(quoted, columns)), BATCH_COLUMN, at)
