from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from checks.rawfiles import pack_workbooks, write_json_arrays
from tallyloom import SourceSpec
from tallyloom.retail import CSV_OPTIONS, JSON_OPTIONS
from tallyloom.sources import declared_schema, parse_workbooks, read_source, source_path
from workbook import Number, Styled, write_workbook

COLUMNS = (("Product ID", "string"), ("Quantity", "int"), ("Price per product", "double"))
CSV = SourceSpec("products", "csv", "Products", COLUMNS, ("Product ID",), CSV_OPTIONS)
JSON = SourceSpec("orders", "json", "Orders", COLUMNS, ("Product ID",), JSON_OPTIONS)
BOOK = SourceSpec("customers", "xlsx", "Customers", COLUMNS, ("Product ID",))


def read(spark, spec, folder, content=None):
    path = source_path(str(folder), spec)
    if content is not None:
        with open(path, "w", newline="") as file:
            file.write(content)
    frame = read_source(spark, spec, path).drop("ingested_at")
    return sorted(map(tuple, frame.collect()), key=repr)


def test_declared_schema():
    schema = declared_schema([("Customer ID", "String"), ("age", "INT"), ("salary", "double")])
    assert isinstance(schema, StructType)
    assert schema.names == ["Customer ID", "age", "salary"]
    assert [type(item.dataType) for item in schema] == [StringType, IntegerType, DoubleType]
    assert all(item.nullable for item in schema)
    with pytest.raises(KeyError):
        declared_schema([("dt", "date")])


def test_path_rule():
    assert source_path("/in/", CSV) == "/in/Products.csv"


def test_csv_quotes_commas_and_line_breaks(spark, folder):
    text = 'Product ID,Quantity,Price per product\n"a ""b"", c\nd",1,2.5\nx,bad,\n'
    assert read(spark, CSV, folder, text) == [('a "b", c\nd', 1, 2.5), ("x", None, None)]


def test_csv_binds_by_position_and_drops_extra_fields(spark, folder):
    text = "Quantity,Product ID,Price per product\np,1,2.5,extra\n"
    assert read(spark, CSV, folder, text) == [("p", 1, 2.5)]
    strict = replace(CSV, options={**CSV_OPTIONS, "enforceSchema": "false"})
    with pytest.raises(Exception, match="header"):
        read(spark, strict, folder)


def test_declared_corrupt_record_column_keeps_bad_rows(spark, folder):
    spec = replace(
        CSV,
        columns=(*COLUMNS, ("_bad", "string")),
        options={**CSV_OPTIONS, "columnNameOfCorruptRecord": "_bad"},
    )
    text = "Product ID,Quantity,Price per product\nx,bad,1\ny,2,1\n"
    assert read(spark, spec, folder, text) == [("x", None, 1.0, "x,bad,1"), ("y", 2, 1.0, None)]


def test_json_array_by_name(spark, folder):
    rows = [
        {"Quantity": 1, "Product ID": "a", "Other": 5, "Price per product": 2},
        {"Product ID": "b", "Quantity": "x"},
    ]
    assert read(spark, JSON, folder, json.dumps(rows, indent=1)) == [("a", 1, 2.0), ("b", None, None)]


def test_folder_of_files_is_one_source(spark, folder):
    base = folder / "Orders.json"
    base.mkdir()
    for name in "ab":
        (base / f"{name}.json").write_text(json.dumps([{"Product ID": name, "Quantity": 1}]))
    assert read(spark, JSON, folder) == [("a", 1, None), ("b", 1, None)]


def test_ingest_stamp(spark, folder):
    path = source_path(str(folder), CSV)
    with open(path, "w") as file:
        file.write("Product ID,Quantity,Price per product\nx,1,1\ny,2,2\n")
    at = datetime(2024, 1, 2, 3, 4, 5, 678901, tzinfo=timezone.utc)
    fixed = read_source(spark, CSV, path, at)
    assert fixed.where(F.col("ingested_at") == F.lit(at)).count() == 2
    assert read_source(spark, CSV, path).select("ingested_at").distinct().count() == 1


def test_workbook_cells(spark, folder):
    write_workbook(
        folder / "Customers.xlsx",
        {
            1: ["Product ID", "Quantity", "Price per product"],
            2: ["P & <1>", 3, 2.5],
            4: [None, "N/A", "=7.25"],
            5: ["!#REF!", True, 1],
            6: ["00501"],
            9: [None, None, None],
        },
    )
    assert read(spark, BOOK, folder) == sorted(
        [
            ("P & <1>", 3, 2.5),
            (None, None, None),
            (None, None, 7.25),
            ("#REF!", None, 1.0),
            ("00501", None, None),
        ],
        key=repr,
    )
    text = declared_schema((name, "string") for name, _ in COLUMNS)
    books = spark.read.format("binaryFile").load(str(folder))
    assert ("#REF!", "True", "1") in map(tuple, parse_workbooks(books, text).collect())


def test_workbook_numbers_as_written(spark, folder):
    numbers = {
        "1.1000000000000001": "1.1",
        "1234.0": "1234",
        "1E3": "1000",
        "-0.5": "-0.5",
        "12345678901234567890": "12345678901234567890",
    }
    cells = {number: [Number(text)] for number, text in enumerate(numbers, 2)}
    write_workbook(folder / "b.xlsx", {1: ["h"], **cells})
    books = spark.read.format("binaryFile").load(str(folder))
    found = parse_workbooks(books, declared_schema([("h", "string")])).collect()
    assert [row.h for row in found] == list(numbers.values())


def test_workbook_with_absolute_target_and_folder_of_workbooks(spark, folder):
    base = folder / "Customers.xlsx"
    base.mkdir()
    for name in "ab":
        write_workbook(base / f"{name}.xlsx", {1: ["h"], 2: [name]}, "/xl/worksheets/s.xml")
    assert read(spark, BOOK, folder) == [("a", None, None), ("b", None, None)]


def test_workbook_wider_than_declared_fails(spark, folder):
    write_workbook(folder / "Customers.xlsx", {1: ["h"], 2: [1, 2, 3, 4]})
    with pytest.raises(Exception, match="4 cells, 3 are declared"):
        read(spark, BOOK, folder)


def test_long_workbook_leaves_the_task_in_batches(spark, folder):
    count = 12_345
    write_workbook(folder / "Customers.xlsx", {1: ["h"], **{n: [n] for n in range(2, count + 2)}})
    assert len(read(spark, BOOK, folder)) == count


def test_workbook_dates_as_shown(spark, folder):
    goldens = {
        "0:42603": "42603",
        "1:42603": "2016-08-21 00:00:00",
        "2:42603.75": "2016-08-21 18:00:00",
        "3:0.2708333333333333": "06:30:00",
        "4:0.25": "0.25",
        "5:1.5": "1.5",
        "6:59": "1900-02-28 00:00:00",
        "6:61": "1900-03-01 00:00:00",
        "7:12": "12",
        "1:1e9": "1000000000",
    }
    rows = {n: [Styled(cell)] for n, cell in enumerate(goldens, 2)}
    write_workbook(folder / "d.xlsx", {1: ["h"], **rows})
    books = spark.read.format("binaryFile").load(str(folder / "d.xlsx"))
    found = [row.h for row in parse_workbooks(books, declared_schema((("h", "string"),))).collect()]
    assert found == list(goldens.values())


def test_workbooks_are_packed_by_a_task_each(spark, monkeypatch):
    """However few tasks the rows come from."""
    monkeypatch.setattr("checks.rawfiles.WORKBOOK_ROWS", 30)
    rows = spark.range(100).selectExpr("cast(id AS string) AS id", "concat('n', id) AS name").coalesce(1)
    books = pack_workbooks(rows)
    assert books.rdd.getNumPartitions() == 4
    found = parse_workbooks(books, rows.schema).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, rows.collect()))


def test_json_arrays_are_delivered_compressed(spark, folder):
    rows = spark.range(20_000).selectExpr("cast(id AS string) AS id", "concat('name ', id % 7) AS name")
    path = str(folder / "rows.json")
    write_json_arrays(rows, path)
    plain = rows.selectExpr("sum(length(to_json(struct(*))))").first()[0]
    written = list(Path(path).glob("part-*"))
    assert written and all(file.name.endswith(".gz") for file in written)
    assert sum(file.stat().st_size for file in written) < plain / 4
    found = spark.read.schema(rows.schema).option("multiLine", True).json(path)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))
