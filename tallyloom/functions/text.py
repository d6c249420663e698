"""Text cleaning for contact data, one expression per field kind.

Every function maps a string column to a string column inside generated code;
nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and literals that stored results depend on.
NAME_DISALLOWED = r"[^a-zA-Z\s']"
WHITESPACE_RUN = r"\s+"
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
EMAIL_INVALID = "not valid"
PHONE_ERROR_MARK = "#ERROR!"
PHONE_NON_DIGIT = r"\D"
POSTAL_WIDTH = 5

# A leading 001 is always a prefix; a leading 1 only when ten digits follow it.
# The possessive "?+" keeps the prefix consumed, so a number that is too short
# without it yields no match instead of being read with its prefix.
PHONE_NATIONAL = r"^(?:001|1(?=\d{10}))?+(\d{10})"


def clean_name(value: Column) -> Column:
    """Keep ASCII letters, apostrophes and single inner spaces."""
    letters = F.regexp_replace(value, NAME_DISALLOWED, "")
    return F.trim(F.regexp_replace(letters, WHITESPACE_RUN, " "))


def validate_email(value: Column) -> Column:
    """The address itself, or a marker for anything else, null included."""
    return F.when(F.rlike(value, F.lit(EMAIL_PATTERN)), value).otherwise(EMAIL_INVALID)


def normalise_phone(value: Column) -> Column:
    """Ten national digits, or null where there are none."""
    national = F.regexp_extract(F.regexp_replace(value, PHONE_NON_DIGIT, ""), PHONE_NATIONAL, 1)
    return F.when(~F.contains(value, F.lit(PHONE_ERROR_MARK)) & (national != ""), national)


def pad_postal(value: Column) -> Column:
    """Exactly five characters: zeros added on the left, or the tail cut."""
    return F.lpad(value.cast("string"), POSTAL_WIDTH, "0")
