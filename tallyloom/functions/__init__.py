"""Column-to-column expressions built only from Spark's own functions."""

from tallyloom.functions.dates import parse_date, year_of
from tallyloom.functions.money import exact, inexact, round_half_up, total
from tallyloom.functions.text import clean_name, normalise_phone, pad_postal, validate_email

__all__ = [
    "clean_name",
    "exact",
    "inexact",
    "normalise_phone",
    "pad_postal",
    "parse_date",
    "round_half_up",
    "total",
    "validate_email",
    "year_of",
]
