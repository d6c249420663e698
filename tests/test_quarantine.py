"""Rows that do not fit the declared schema land apart, with a reason."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom import SinkSpec, SourceSpec
from tallyloom.plans import LayerError, run_raw
from tallyloom.sinks import expire_versions, qualified
from tallyloom.sources import read_checked

AT = datetime(2024, 1, 2, 10, tzinfo=timezone.utc)
COLUMNS = (("Item ID", "string"), ("Item.Name", "string"), ("Count", "int"), ("Price", "double"))


def source(kind="csv", sink=SinkSpec(), columns=COLUMNS, **options):
    if kind == "csv":
        options = {"header": "true", "multiLine": "true", "escape": '"', **options}
    return SourceSpec("items", kind, "Items", columns, ("Item ID",), options, sink, quarantine=True)


def deliver(folder, name, **files):
    path = folder / name
    path.mkdir()
    for file, text in files.items():
        (path / file).write_text(text)
    return str(folder)


def rejected(spark, layout):
    rows = spark.table(qualified(layout.raw, "items_rejected"))
    return sorted((row.reason, row.record) for row in rows.collect())


def landed(spark, layout):
    return sorted(
        (row["Item ID"], row["Item.Name"], row["Count"], row["Price"])
        for row in spark.table(qualified(layout.raw, "items")).collect()
    )


GOOD = 'Item ID,Item.Name,Count,Price\nI1,"a, ""b""\nc",1,1.5\nI2,,,\n'


def test_csv_rows_are_told_apart(spark, folder, layout):
    text = GOOD + "I3,x,three,2\nI4,x,4,4,more\nI5,x\nI6,y,6,six\n"
    report = run_raw(spark, [source()], deliver(folder, "Items.csv", a=text), layout, AT)[0]
    assert (report.rows, report.rejected) == (2, 4)
    assert landed(spark, layout) == [("I1", 'a, "b"\nc', 1, 1.5), ("I2", None, None, None)]
    assert rejected(spark, layout) == [
        ("bad value in Count", "I3,x,three,2"),
        ("bad value in Price", "I6,y,6,six"),
        ("other number of fields", "I4,x,4,4,more"),
        ("other number of fields", "I5,x"),
    ]
    stored = spark.table(qualified(layout.raw, "items"))
    assert stored.columns == [*dict(COLUMNS), "ingested_at"]


def test_files_with_another_header_are_rejected_whole(spark, folder, layout):
    swapped = "Item.Name,Item ID,Count,Price\nx,I8,8,8.5\ny,I9,nine,9\n"
    headless = "I10,z,10,1\n"
    path = deliver(folder, "Items.csv", a=GOOD, b=swapped, c=headless, d="")
    report = run_raw(spark, [source()], path, layout, AT)[0]
    assert report.rows == 2 and len(landed(spark, layout)) == 2
    found = rejected(spark, layout)
    assert ("bad value in Count", "y,I9,nine,9") in found
    assert ("file without the declared header", "I10,z,10,1.0") in found
    assert [record for reason, record in found if reason == "header in another order"] == [
        "Item.Name,Item ID,Count,Price",
        "x,I8,8,8.5",
    ]


def test_headers_of_text_columns_are_found(spark, folder, layout):
    columns = (("A", "string"), ("B", "string"))
    path = deliver(folder, "Items.csv", a="A,B\n1,2\n", b="B,A\n3,4\n")
    spec = source(columns=columns, multiLine="false")
    spec = SourceSpec(spec.table, spec.format, spec.file_name, columns, ("A",), spec.options, quarantine=True)
    run_raw(spark, [spec], path, layout, AT)
    assert [tuple(row)[:2] for row in spark.table(qualified(layout.raw, "items")).collect()] == [("1", "2")]
    assert {record for _, record in rejected(spark, layout)} == {"B,A", "3,4"}


def test_json_elements_are_told_apart(spark, folder, layout):
    array = (
        '[{"Item ID": "J1", "Item.Name": "n", "Count": 1, "Price": 1.5}, {"Item ID": "J2", "Count": "x"},'
        ' {"Item ID": "J3", "Price": "y", "More": 1}, {"Item ID": "J4", "Count": null}]'
    )
    path = deliver(folder, "Items.json", a=array, b='[{"Item ID": "J9"')
    report = run_raw(spark, [source("json", multiLine="true")], path, layout, AT)[0]
    assert (report.rows, report.rejected) == (2, 3)
    assert landed(spark, layout) == [("J1", "n", 1, 1.5), ("J4", None, None, None)]
    assert [reason for reason, _ in rejected(spark, layout)] == [
        "bad value in Count", "bad value in Price", "no JSON array",
    ]
    assert '"More":1' in rejected(spark, layout)[1][1].replace(" ", "")


def test_json_lines_are_told_apart(spark, folder, layout):
    path = deliver(folder, "Items.json", a='{"Item ID": "J1", "Count": 1}\n\n{"Item ID": "J2", "Count": "x"}\n{"Item')
    report = run_raw(spark, [source("json")], path, layout, AT)[0]
    assert (report.rows, report.rejected) == (1, 2)
    assert {reason for reason, _ in rejected(spark, layout)} == {"bad value in Count", "unreadable"}


def test_a_load_of_bad_rows_only_leaves_the_table_and_tells_why(spark, folder, layout):
    run_raw(spark, [source()], deliver(folder, "Items.csv", a=GOOD), layout, AT)
    other = folder / "next"
    other.mkdir()
    with pytest.raises(LayerError, match="empty"):
        run_raw(spark, [source()], deliver(other, "Items.csv", a="Item ID,Item.Name,Count,Price\nI1,x,y,z\n"), layout, AT)
    assert len(landed(spark, layout)) == 2
    assert rejected(spark, layout) == [("bad value in Count, Price", "I1,x,y,z")]


def test_appended_batches_and_their_rejects_are_replaced_when_loaded_again(spark, folder, layout):
    spec = source(sink=SinkSpec(mode="append"))
    path = deliver(folder, "Items.csv", a=GOOD + "I3,x,three,2\n")
    for _ in range(2):
        run_raw(spark, [spec], path, layout, AT)
    run_raw(spark, [spec], path, layout, datetime(2024, 1, 3, tzinfo=timezone.utc))
    assert len(landed(spark, layout)) == 4 and len(rejected(spark, layout)) == 2


def test_the_published_version_is_not_expired(spark, folder, layout):
    path = deliver(folder, "Items.csv", a=GOOD)
    for _ in range(3):
        run_raw(spark, [source()], path, layout, AT)
    assert expire_versions(spark, layout.raw, "items", keep=0) == 2
    assert len(landed(spark, layout)) == 2


def test_source_is_parsed_once(spark, folder):
    frame = read_checked(spark, source(), deliver(folder, "Items.csv", a=GOOD) + "/Items.csv", AT)
    assert frame._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert len(frame.where(F.col("_reason").isNull()).collect()) == 2


def test_workbooks_have_no_quarantine(spark, folder):
    with pytest.raises(ValueError, match="no quarantine"):
        read_checked(spark, source("xlsx"), str(folder))
