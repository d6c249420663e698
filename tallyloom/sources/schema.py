"""Schemas declared as ``(name, type)`` pairs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# The types a source may declare.
DECLARED_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType()}


def declared_schema(columns: Iterable[tuple[str, str]]) -> StructType:
    """Nullable fields with names kept verbatim; an unknown type is a ``KeyError``."""
    schema = StructType()
    for name, kind in columns:
        schema.add(StructField(name, DECLARED_TYPES[kind.lower()], nullable=True))
    return schema
