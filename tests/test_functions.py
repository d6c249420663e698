from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyloom import CleanRules
from tallyloom.functions import (
    clean_name,
    exact,
    normalise_phone,
    pad_postal,
    parse_date,
    round_half_up,
    validate_email,
)
from tallyloom.operators import clean, snake_case


def mapped(spark, change, cases):
    rows = spark.createDataFrame([(given,) for given in cases], "given string")
    return {row.given: row.found for row in rows.select("given", change("given").alias("found")).collect()}


def test_names(spark):
    cases = {
        "Gary567 Hansen": "Gary Hansen",
        "Pete@#$ Takahito": "Pete Takahito",
        "Adam    ...Hart": "Adam Hart",
        "   Tracy Blumstein": "Tracy Blumstein",
        "Philip Fox": "Philip Fox",
        "Mary O'Rourke": "Mary O'Rourke",
        "José Núñez": "Jos Nez",
        "Jean-Luc": "JeanLuc",
        "123": "",
        "a\tb\nc": "a b c",
        None: None,
    }
    assert mapped(spark, lambda c: clean_name(F.col(c)), cases) == cases


def test_emails(spark):
    valid = ["test@example.com", "user123@domain99.org", "a@b..com", "first.last+tag@x-y.co.uk"]
    invalid = ["not-an-email", "user@", "userexample.com", "a@b", "", " a@b.c", None]
    expected = {**{v: v for v in valid}, **dict.fromkeys(invalid, "not valid")}
    assert mapped(spark, lambda c: validate_email(F.col(c)), expected) == expected


def test_phones(spark):
    cases = {
        "7185624866": "7185624866",
        "421.580.0902": "4215800902",
        "0014215800902": "4215800902",
        "17185624866": "7185624866",
        "12345": None,
        "#ERROR!": None,
        "#ERROR! 7185624866": None,
        "421.580.0902x9815": "4215800902",
        "001-542-415-0246": "5424150246",
        "0011234567": None,
        "142.158.0090x12": "4215800901",
        "+44 20 7946 0958": "4420794609",
        "+1 (743) 555-3824": "7435553824",
        "1234567890": "1234567890",
        "00112345678901": "1234567890",
        "": None,
        None: None,
    }
    assert mapped(spark, lambda c: normalise_phone(F.col(c)), cases) == cases


def test_postal_codes(spark):
    cases = {
        "1234": "01234",
        "12345": "12345",
        "123": "00123",
        "12345-6789": "12345",
        "": "00000",
        None: None,
    }
    assert mapped(spark, lambda c: pad_postal(F.col(c)), cases) == cases
    assert spark.range(7, 8).select(pad_postal(F.col("id"))).first()[0] == "00007"


def test_dates(spark):
    cases = {
        "21/8/2016": date(2016, 8, 21),
        "1/1/2017": date(2017, 1, 1),
        "01/01/2017": date(2017, 1, 1),
        "021/8/2016": date(2016, 8, 21),
        "not-a-date": None,
        "31/2/2016": None,
        "21/8/16": None,
        " 21/8/2016": None,
        "2016-08-21": None,
        None: None,
    }
    assert mapped(spark, lambda c: parse_date(F.col(c), "d/M/yyyy"), cases) == cases


def test_rounding_is_half_up_on_the_written_value(spark):
    rows = spark.createDataFrame([(1.005, 1.01), (2.675, 2.68), (-1.005, -1.01), (63.687, 63.69)], "v double, r double")
    assert all(row.found == row.r for row in rows.withColumn("found", round_half_up(F.col("v"))).collect())
    cents = rows.select(exact(F.col("v"), rows.schema["v"].dataType, 2).cast("double").alias("v"), "r")
    assert all(row.v == row.r for row in cents.collect())


def test_exact_refuses_text(spark):
    rows = spark.createDataFrame([("a",)], "v string")
    with pytest.raises(TypeError, match="string"):
        exact(F.col("v"), rows.schema["v"].dataType)


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Product ID", "product_id"),
        ("Sub-Category", "sub_category"),
        ("OrderDate", "order_date"),
        ("customer_id", "customer_id"),
        ("Price  Per  Product", "price_per_product"),
        ("Price per product", "price_per_product"),
        ("HTTPServer", "httpserver"),
        ("_Size (cm)_", "size_cm"),
        ("a.b-c d", "a_b_c_d"),
        ("Größe1Zoll", "gre1_zoll"),
    ],
)
def test_snake_case(given, expected):
    assert snake_case(given) == expected


def test_rules_skip_absent_columns(spark):
    rows = spark.createDataFrame([("value", 1.239)], "some_col string, amount double")
    rules = CleanRules(
        names=("n",),
        emails=("e",),
        phones=("p",),
        postal_codes=("z",),
        dates={"order_date": "d/M/yyyy"},
        years={"order_year": "order_date"},
        rounding={"amount": 2, "other": 1},
    )
    cleaned = clean(rows, rules)
    assert cleaned.columns == ["some_col", "amount"]
    assert cleaned.first() == ("value", 1.24)


def test_year_only_for_dates_that_the_rules_parse(spark):
    rows = spark.createDataFrame([(date(2016, 8, 21),)], "order_date date")
    assert clean(rows, CleanRules(years={"order_year": "order_date"})).columns == ["order_date"]


def test_one_column_under_several_rules_is_cleaned_in_order(spark):
    rows = spark.createDataFrame([("1 2 3",)], "v string")
    assert clean(rows, CleanRules(names=("v",), postal_codes=("v",))).first().v == "00000"
