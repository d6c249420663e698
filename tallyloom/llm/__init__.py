"""Operators of a training-data pipeline: deduplication, filters, tokens and packing.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries`` applies them to whole tables.
"""
