"""Raw file readers with declared schemas."""

from tallyloom.sources.files import read_source, source_path
from tallyloom.sources.quarantine import read_checked
from tallyloom.sources.schema import declared_schema
from tallyloom.sources.workbooks import parse_workbooks

__all__ = ["declared_schema", "parse_workbooks", "read_checked", "read_source", "source_path"]
