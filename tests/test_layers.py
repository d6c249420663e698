from __future__ import annotations

import json
import logging
from dataclasses import replace
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom import SinkSpec
from tallyloom.operators import latest_batch
from tallyloom.plans import (
    LayerError,
    land,
    report_tables,
    run_aggregated,
    run_enriched,
    run_raw,
)
from tallyloom.plans import enriched as enriched_layer
from tallyloom.retail import (
    AGGREGATES,
    CUSTOMER_COLUMNS,
    ENRICHED,
    ORDER_COLUMNS,
    ORDERS,
    PROFIT,
    SOURCES,
    appended,
    orders_with,
)
from tallyloom.sinks import append_rows, create_database, publish, qualified, stage
from workbook import write_workbook

DAY_1 = datetime(2024, 1, 1, 10, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 1, 2, 11, tzinfo=timezone.utc)

PRODUCTS = '''Product ID,Category,Sub-Category,Product Name,State,Price per product
P1,Furniture,Chairs,"Chair, ""big""",NY,10.5
P1,Furniture,Chairs,"Chair, ""big""",NY,11.5
P1,Furniture,Chairs,"Chair, ""big""",CA,12
P2, Technology ,Phones,Phone,NY,
'''
CUSTOMERS = [
    ["C1", "Gary567 Hansen", "g@x.org", "001-542-415-0246", "1 St", "Home", "US", "NY", "NY", 1234, "East"],
    ["C2", "Mary O'Rourke", "nope", "12345", None, "Corp", "US", "LA", "CA", "90001", "West"],
]


def order(row, number, day, customer, product, profit):
    values = [row, number, day, "3/9/2016", " First ", customer, product, 2, 5.5, 0.1, profit]
    return {name: value for (name, _), value in zip(ORDER_COLUMNS, values) if value is not None}


LINES = [
    order(1, "O1", "21/8/2016", "C1", "P2", 63.687),
    order(1, "O1", "21/8/2016", "C1", "P2", 63.687),
    order(2, "O1", "21/8/2016", "C1", "P2", -20.123),
    order(3, "O2", "1/1/2017", "C2", "P1", 45.678),
    order(4, "O3", "not-a-date", "C9", "P9", 1.005),
    order(5, None, "2/1/2017", None, "P2", None),
]


@pytest.fixture
def files(folder):
    (folder / "Products.csv").write_text(PRODUCTS)
    (folder / "Orders.json").write_text(json.dumps(LINES))
    header = [name for name, _ in CUSTOMER_COLUMNS]
    write_workbook(folder / "Customers.xlsx", {1: header, 2: CUSTOMERS[0], 3: CUSTOMERS[1]})
    return str(folder)


def stored(spark, database, table, *columns):
    frame = spark.table(qualified(database, table)).select(*columns)
    return sorted(map(tuple, frame.collect()), key=lambda row: [str(value) for value in row])


def test_files_to_reports(spark, files, layout, caplog):
    raw = run_raw(spark, SOURCES, files, layout)
    assert [(r.table, r.rows, r.null_rows) for r in raw] == [
        ("products", 4, 0), ("customers", 2, 0), ("orders", 6, 0),
    ]
    with caplog.at_level(logging.WARNING):
        done = {r.table: r for r in run_enriched(spark, ENRICHED, layout)}
    assert "orders: 1 rows lack a value" in caplog.text
    assert (done["customers"].rows, done["products"].rows, done["orders"].rows) == (2, 3, 6)
    assert (done["products"].duplicates, done["orders"].duplicates) == (1, 1)
    # Line 3 met both rows of product P1.
    assert done["orders"].fan_out == 1
    assert done["orders"].null_rows == 1

    assert stored(spark, layout.enriched, "customers", "customer_name", "email", "phone", "address", "postal_code") == [
        ("Gary Hansen", "g@x.org", "5424150246", "1 St", "01234"),
        ("Mary O'Rourke", "not valid", "Unknown", "Unknown", "90001"),
    ]
    assert stored(spark, layout.enriched, "products", "product_id", "category", "state", "price_per_product") == [
        ("P1", "Furniture", "CA", 12.0), ("P1", "Furniture", "NY", 10.5), ("P2", "Technology", "NY", 0.0),
    ]
    orders = spark.table(qualified(layout.enriched, "orders"))
    assert orders.columns == [*ORDERS.columns, "enriched_at"]
    assert dict(orders.dtypes)["order_date"] == "date"
    assert dict(orders.dtypes)["order_year"] == "int"
    assert stored(
        spark, layout.enriched, "orders",
        "row_id", "order_id", "order_date", "order_year", "ship_mode", "profit", "customer_name", "category",
    ) == [
        (1, "O1", date(2016, 8, 21), 2016, "First", 63.69, "Gary Hansen", "Technology"),
        (2, "O1", date(2016, 8, 21), 2016, "First", -20.12, "Gary Hansen", "Technology"),
        (3, "O2", date(2017, 1, 1), 2017, "First", 45.68, "Mary O'Rourke", "Furniture"),
        (3, "O2", date(2017, 1, 1), 2017, "First", 45.68, "Mary O'Rourke", "Furniture"),
        (4, "O3", None, 0, "First", 1.01, "Unknown", "Unknown"),
        (5, "Unknown", date(2017, 1, 2), 2017, "First", 0.0, "Unknown", "Technology"),
    ]

    (aggregate,) = run_aggregated(spark, AGGREGATES, layout)
    assert aggregate.rows == 4
    reports = report_tables(spark, PROFIT.table, layout)
    assert [tuple(row) for row in reports["profit_by_year"].collect()] == [(0, 1.01), (2016, 43.57), (2017, 91.36)]
    assert [tuple(row) for row in reports["profit_by_customer"].collect()] == [
        ("C2", "Mary O'Rourke", 91.36), ("C1", "Gary Hansen", 43.57), ("C9", "Unknown", 1.01), ("Unknown", "Unknown", 0.0),
    ]
    by_sql = spark.sql(
        f"SELECT order_year, ROUND(SUM(total_profit), 2) AS total_profit "
        f"FROM v_{PROFIT.table} GROUP BY order_year ORDER BY order_year"
    )
    assert by_sql.collect() == reports["profit_by_year"].collect()

    unique = replace(orders_with("unique"), count_duplicates=False)
    (again,) = run_enriched(spark, [unique], layout)
    assert (again.rows, again.duplicates, again.fan_out) == (5, None, None)
    with pytest.raises(LayerError, match="more than once: P1"):
        run_enriched(spark, [orders_with("error")], layout)
    assert spark.table(qualified(layout.enriched, "orders")).count() == 5

    by_year = replace(ORDERS, sink=SinkSpec(partition_by=("order_year",), rebalance=True))
    (rebalanced,) = run_enriched(spark, [by_year], layout)
    assert (rebalanced.rows, rebalanced.null_rows) == (6, 1)
    assert spark.table(qualified(layout.enriched, "orders")).where("order_year = 2017").count() == 3


def test_batches_are_kept_and_only_the_newest_is_used(spark, files, layout, folder):
    sources = appended()
    run_raw(spark, sources, files, layout, DAY_1)
    (folder / "Orders.json").write_text(json.dumps(LINES[:3]))
    raw = run_raw(spark, sources, files, layout, DAY_2)
    assert [r.rows for r in raw] == [4, 2, 3]
    assert spark.table(qualified(layout.raw, "orders")).count() == 9
    done = run_enriched(spark, ENRICHED, layout)
    assert [r.rows for r in done] == [2, 3, 2]

    # Loading a batch again replaces that batch and no other.
    run_raw(spark, sources, files, layout, DAY_2)
    assert spark.table(qualified(layout.raw, "orders")).count() == 9

    newest = latest_batch(spark.table(qualified(layout.raw, "orders")), "ingested_at")
    newest.collect()
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_at" in plan

    # An empty delivery fails, and the newest batch stays what it was.
    (folder / "Products.csv").write_text(PRODUCTS.splitlines()[0] + "\n")
    with pytest.raises(LayerError, match="products is empty"):
        run_raw(spark, sources, files, layout, datetime(2024, 1, 3, tzinfo=timezone.utc))
    assert latest_batch(spark.table(qualified(layout.raw, "products")), "ingested_at").count() == 4


def test_one_batch_of_several_partitions_is_replaced(spark, layout):
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    sink = SinkSpec(mode="append", partition_by=("ingested_at", "State"))
    spec = replace(SOURCES[0], table="places", key=("Product ID",), sink=sink)
    rows = [("P1", "NY"), ("P2", "CA")]

    def load(at, content):
        frame = spark.createDataFrame(content, "`Product ID` string, State string")
        return land(frame.withColumn("ingested_at", F.lit(at)), spec, layout, at)

    odd = DAY_2.replace(microsecond=123456)
    assert [load(at, rows).rows for at in (DAY_1, DAY_2, odd)] == [2, 2, 2]
    assert load(odd, [("P3", "NY")]).rows == 1
    assert load(DAY_1, [("P4", "TX")]).rows == 1
    assert stored(spark, layout.raw, "places", "Product ID", "State") == [
        ("P1", "NY"), ("P2", "CA"), ("P3", "NY"), ("P4", "TX"),
    ]


def test_empty_source_does_not_replace_good_data(spark, files, layout, folder):
    run_raw(spark, SOURCES, files, layout)
    (folder / "Customers.xlsx").unlink()
    write_workbook(folder / "Customers.xlsx", {1: [name for name, _ in CUSTOMER_COLUMNS]})
    (folder / "Orders.json").write_text("[]")
    with pytest.raises(LayerError, match="(?i)customers is empty") as caught:
        run_raw(spark, SOURCES, files, layout)
    assert isinstance(caught.value, RuntimeError)
    assert list(caught.value.failed) == ["customers"]
    # Stopped at customers: the orders, empty too, were not touched.
    assert spark.table(qualified(layout.raw, "customers")).count() == 2
    assert spark.table(qualified(layout.raw, "orders")).count() == 6
    listed = spark.sql(f"SHOW TABLES IN `{layout.raw}`").where("not isTemporary").collect()
    assert sorted(row.tableName for row in listed) == ["customers", "orders", "products"]


def test_null_keys_warn_and_pass(spark, layout, caplog):
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    rows = spark.createDataFrame([(None, "Alice"), ("C002", "Bob")], "`Customer ID` string, n string")
    spec = replace(SOURCES[1], table="people")
    with caplog.at_level(logging.WARNING):
        report = land(rows, spec, layout, DAY_1)
    assert (report.rows, report.null_rows) == (2, 1)
    assert "people: 1 rows" in caplog.text


def test_aggregates_go_on_after_a_failure(spark, layout):
    create_database(spark, layout.enriched, layout.location_of(layout.enriched))
    columns = "order_year int, category string, sub_category string, customer_id string, customer_name string, order_id string, profit double"
    rows = spark.createDataFrame([(2016, "a", "b", "c", "d", "o", 1.0)], columns)
    publish(spark, stage(rows, SinkSpec(), layout.enriched, "orders"), layout.enriched, "orders")
    missing = replace(PROFIT, table="broken", source="absent")
    with pytest.raises(LayerError, match="broken") as caught:
        run_aggregated(spark, [missing, PROFIT], layout)
    assert list(caught.value.failed) == ["broken"]
    assert spark.table(qualified(layout.aggregated, PROFIT.table)).count() == 1


def test_missing_table_stops_the_enriched_layer(spark, layout):
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    with pytest.raises(LayerError) as caught:
        run_enriched(spark, ENRICHED, layout)
    assert list(caught.value.failed) == ["customers"]


def test_counts_are_those_of_the_committed_files(spark, files, layout, monkeypatch):
    """Nothing but the staged files tells the counts, so no repeated stage can double them."""
    run_raw(spark, SOURCES, files, layout)
    write = enriched_layer.stage

    def write_twice(*arguments):
        enriched_layer.discard(spark, write(*arguments))
        return write(*arguments)

    monkeypatch.setattr(enriched_layer, "stage", write_twice)
    done = {r.table: r for r in run_enriched(spark, ENRICHED, layout)}
    assert (done["orders"].rows, done["orders"].null_rows) == (6, 1)


# --- sinks ---


def test_overwrite_may_change_schema_and_read_its_own_table(spark, layout):
    database = layout.raw
    create_database(spark, database, layout.location_of(database))
    create_database(spark, database, layout.location_of(database))
    first = spark.createDataFrame([(1, 2)], ["a b", "c"])
    target = publish(spark, stage(first, SinkSpec(), database, "T"), database, "T")
    reader = spark.table(target)
    second = reader.select((F.col("a b") + 1).alias("x"), F.lit("s").alias("y"))
    publish(spark, stage(second, SinkSpec(), database, "t"), database, "t")
    assert spark.table(target).collect() == [(2, "s")]
    # A frame opened before the overwrite still reads the version it opened.
    assert reader.collect() == [(1, 2)]


@pytest.mark.parametrize("sink", [
    SinkSpec(partition_by=("k",)),
    SinkSpec(partition_by=("k",), rebalance=True),
    SinkSpec(rebalance=True),
    SinkSpec(bucket_by=("v",), buckets=4),
    SinkSpec(format="orc", options={"compression": "zlib"}),
])
def test_layouts_hold_the_same_rows(spark, layout, sink):
    database = layout.raw
    create_database(spark, database, layout.location_of(database))
    rows = spark.range(100).selectExpr("id as v", "id % 3 as k")
    target = publish(spark, stage(rows, sink, database, "t"), database, "t")
    assert sorted(spark.table(target).select("v", "k").collect()) == sorted(rows.collect())


def test_append_adds_rows(spark, layout):
    database = layout.raw
    create_database(spark, database, layout.location_of(database))
    rows = spark.range(3).selectExpr("id as v", "1 as k")
    sink = SinkSpec(mode="append", partition_by=("k",))
    append_rows(rows, sink, database, "t")
    target = append_rows(rows.selectExpr("v", "2 as k"), sink, database, "t")
    assert spark.table(target).count() == 6


def test_bucketed_tables_join_without_a_shuffle(spark, layout, settings):
    settings(autoBroadcastJoinThreshold="-1")
    database = layout.raw
    create_database(spark, database, layout.location_of(database))
    sink = SinkSpec(bucket_by=("k",), buckets=4)
    rows = spark.range(100).selectExpr("id as k", "id * 2 as v")
    for name in ("l", "r"):
        publish(spark, stage(rows, sink, database, name), database, name)
    left, right = (spark.table(qualified(database, name)) for name in ("l", "r"))
    joined = left.join(right.withColumnRenamed("v", "w"), "k", "left")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("wrong", [
    {"mode": "merge"}, {"buckets": 3}, {"bucket_by": ("a",)},
])
def test_bad_sinks_are_refused(wrong):
    with pytest.raises(ValueError):
        SinkSpec(**wrong)
