from __future__ import annotations

import logging
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom import AggregateSpec, JoinSpec, Metric
from tallyloom.operators import (
    aggregate,
    all_rollups,
    any_null,
    audit,
    contract,
    dedupe,
    duplicate_keys,
    duplicate_summary,
    enrich_left,
    fill_missing,
    join_growth,
    latest_batch,
    lookup,
    preview,
    reaggregate,
    reports,
    snake_case_columns,
    stamp,
    trim_strings,
)

GRAIN = ("order_year", "category", "sub_category", "customer_id", "customer_name")
# Golden rows.
LINES = [
    (2016, "Furniture", "Chairs", "C001", "Alice", "ORD-001", 100.50),
    (2016, "Furniture", "Chairs", "C001", "Alice", "ORD-001", 200.75),
    (2016, "Technology", "Phones", "C002", "Bob", "ORD-002", -50.00),
    (2017, "Office Supplies", "Paper", "C001", "Alice", "ORD-003", 300.00),
    (2017, "Technology", "Phones", "C002", "Bob", "ORD-004", 75.25),
]
SPEC = AggregateSpec(
    "profit", "orders", GRAIN, (Metric("profit", "sum"), Metric("order_id", "countDistinct"))
)


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(LINES, [*GRAIN, "order_id", "profit"])


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


# --- columns ---


def test_rename_collision_is_an_error(spark):
    with pytest.raises(ValueError, match="a b.*a-b"):
        snake_case_columns(spark.createDataFrame([(1, 2)], ["a b", "a-b"]))
    with pytest.raises(ValueError, match="##"):
        snake_case_columns(spark.createDataFrame([(1,)], ["##"]))


def test_rename_keeps_order_and_odd_names(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["Order.Date", "Sub`Cat", "ID"])
    assert snake_case_columns(frame).columns == ["order_date", "subcat", "id"]
    assert snake_case_columns(frame).first() == (1, 2, 3)


def test_trim_takes_spaces_from_strings_only(spark):
    frame = spark.createDataFrame([("  a b ", "\tx ", 1, None)], "`v.1` string, w string, n int, z string")
    assert trim_strings(frame).first() == ("a b", "\tx", 1, None)


def test_contract_orders_columns_and_stamps(spark):
    frame = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    at = datetime(2024, 1, 2, 3, tzinfo=timezone.utc)
    fixed = contract(frame, ["c", "a"], "enriched_at", at)
    assert fixed.columns == ["c", "a", "enriched_at"]
    assert fixed.select("c", "a", F.unix_seconds("enriched_at")).first() == (3, 1, at.timestamp())
    assert stamp(frame, "t").select(F.col("t") > F.lit(at)).first()[0]
    with pytest.raises(Exception, match="missing"):
        contract(frame, ["missing"])


def test_any_null(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "`a b` int, c string")
    assert frame.where(any_null(["a b", "c"])).count() == 1
    assert frame.where(any_null("c")).count() == 1
    assert frame.where(any_null([])).count() == 0


def test_preview_is_planned_as_top_k(spark):
    frame = spark.range(1000)
    top = preview(frame, 3, [F.desc("id")])
    assert [row.id for row in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


# --- batches ---


@pytest.fixture
def batches(spark):
    return spark.createDataFrame(
        [("2024-01-01 10:00:00", "C001"), ("2024-01-02 11:00:00", "C002"), (None, "C003")],
        "ingested_at string, customer_id string",
    ).withColumn("ingested_at", F.to_timestamp("ingested_at"))


def test_latest_batch_keeps_newest_and_drops_column(batches):
    newest = latest_batch(batches, "ingested_at")
    assert newest.columns == ["customer_id"]
    assert rows(newest) == [("C002",)]


def test_latest_batch_without_the_column_keeps_all(batches, caplog):
    with caplog.at_level(logging.WARNING):
        assert latest_batch(batches, "nonexistent_col").count() == 3
    assert "nonexistent_col" in caplog.text


def test_latest_batch_of_nothing_is_nothing(batches):
    assert latest_batch(batches.limit(0), "ingested_at").count() == 0


# --- quality ---


def test_dedupe_counts(spark):
    frame = spark.createDataFrame([("C001", "Alice"), ("C001", "Alice"), ("C002", "Bob")], ["id", "name"])
    assert dedupe(frame, ["id"]).count() == 2
    assert dedupe(frame, ["id", "name"]).count() == 2
    places = spark.createDataFrame(
        [("P1", "Chair", "NY"), ("P1", "Chair", "NY"), ("P1", "Chair", "CA")], ["p", "n", "s"]
    )
    assert dedupe(places, ["p", "n", "s"]).count() == 2


def test_dedupe_survivor_is_smallest_row_nulls_last(spark):
    frame = spark.createDataFrame(
        [(3, "k", None), (5, "k", "b"), (5, "k", "a"), (1, "j", None), (9, None, "z"), (8, None, "y")],
        "v int, key string, w string",
    )
    for parts in (1, 7):
        assert rows(dedupe(frame.repartition(parts), ["key"])) == [
            (1, "j", None), (3, "k", None), (8, None, "y"),
        ]
        preferred = dedupe(frame.repartition(parts), ["key"], prefer=["w"])
        assert rows(preferred) == [(1, "j", None), (5, "k", "a"), (8, None, "y")]


def test_dedupe_handles_odd_column_names(spark):
    frame = spark.createDataFrame([(1, 2, 3), (1, 1, 9)], ["key id", "v.x", "n0"])
    assert rows(dedupe(frame, ["key id"])) == [(1, 1, 9)]


def test_fill_missing_by_type(spark):
    frame = spark.createDataFrame(
        [(None,) * 7],
        "id int, s string, i int, l bigint, d double, dec decimal(8,2), day date",
    )
    filled = fill_missing(frame, ["id"]).first()
    assert filled[:5] == (None, "Unknown", 0, 0, 0.0)
    assert (float(filled.dec), filled.day) == (0.0, None)
    assert fill_missing(frame, ["id"], keep_null=["s"]).first().s is None
    assert fill_missing(frame.select("id"), ["id"]).first() == (None,)
    not_a_number = spark.createDataFrame([("k", float("nan"))], "id string, v double")
    assert fill_missing(not_a_number, ["id"]).first() == ("k", 0.0)


def test_audit_counts_in_one_row(spark):
    frame = spark.createDataFrame([(None, "Alice"), ("C002", "Bob")], "`Customer ID` string, n string")
    assert audit(frame, "Customer ID").first() == (2, 1)
    assert audit(frame, ["Customer ID", "n"]).first() == (2, 1)
    assert audit(frame).first() == (2, 0)
    assert audit(frame.limit(0), ["n"]).first() == (0, 0)


def test_duplicate_reports(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert rows(duplicate_keys(frame, ["k"])) == [("a", 2), (None, 2)]
    assert duplicate_summary(frame, ["k"]).first() == (5, 3, 2)
    assert duplicate_summary(frame.limit(0), ["k"]).first() == (0, 0, 0)


# --- joins ---


@pytest.fixture
def star(spark):
    # Golden rows.
    orders = spark.createDataFrame(
        [(1, "C001", "P001", 63.687), (2, "C002", "P999", -20.123), (3, "C001", "P002", 45.678), (4, None, None, 1.0)],
        "row_id int, customer_id string, product_id string, profit double",
    )
    customers = spark.createDataFrame(
        [("C001", "Alice Smith"), ("C002", "Bob Jones"), (None, "Nobody")],
        "customer_id string, customer_name string",
    )
    products = spark.createDataFrame(
        [("P001", "Furniture", "Chairs", "NY"), ("P002", "Office Supplies", "Paper", "NY")],
        "product_id string, category string, sub_category string, state string",
    )
    return orders, customers, products


def test_left_chain_keeps_unmatched_rows(star):
    orders, customers, products = star
    joined = enrich_left(
        orders,
        {"customers": customers, "products": products},
        [
            JoinSpec("customers", "customer_id", ("customer_name",)),
            JoinSpec("products", "product_id", ("category", "sub_category")),
        ],
    ).select("row_id", "customer_name", "category", "sub_category")
    assert rows(joined) == [
        (1, "Alice Smith", "Furniture", "Chairs"),
        (2, "Bob Jones", None, None),
        (3, "Alice Smith", "Office Supplies", "Paper"),
        (4, None, None, None),
    ]


def test_fan_out_unique_and_error(spark):
    orders = spark.createDataFrame(
        [("P1", "O1", 10.0), ("PX", "O2", 5.0), (None, "O3", 1.0)], "p string, o string, profit double"
    )
    products = spark.createDataFrame(
        [("P1", "b", "NY"), ("P1", "a", "CA"), (None, "z", "NY"), (None, "z", "CA")],
        "p string, category string, state string",
    )
    fanned = lookup(orders, products, "p", ["category"])
    assert fanned.count() == 4
    assert fanned.where("p = 'P1'").agg(F.sum("profit"), F.count_distinct("o")).first() == (20.0, 1)
    assert rows(lookup(orders, products, "p", ["category"], "unique").select("p", "category")) == [
        ("P1", "a"), ("PX", None), (None, None),
    ]
    assert join_growth(orders, products, "p").first() == (3, 4, 2)
    with pytest.raises(Exception, match="dimension key p occurs more than once: P1"):
        lookup(orders, products, "p", ["category"], "error").collect()
    single = products.where("state = 'NY'")
    assert lookup(orders, single, "p", ["category"], "error").count() == 3


def test_lookup_refuses_bad_requests(star):
    orders, customers, _ = star
    with pytest.raises(ValueError, match="on_duplicate"):
        lookup(orders, customers, "customer_id", ["customer_name"], "first")
    with pytest.raises(ValueError, match="already present"):
        lookup(orders.withColumn("customer_name", F.lit(1)), customers, "customer_id", ["customer_name"])


# --- aggregation and reports ---


def test_totals_and_distinct_orders(lines):
    assert rows(aggregate(lines, SPEC).select("order_year", "category", "total_profit", "order_id_distinct_count")) == [
        (2016, "Furniture", 301.25, 1),
        (2016, "Technology", -50.0, 1),
        (2017, "Office Supplies", 300.0, 1),
        (2017, "Technology", 75.25, 1),
    ]


def test_grain_is_unique(lines):
    assert duplicate_keys(aggregate(lines, SPEC), GRAIN[:4]).count() == 0


def test_unknown_metric_fails_before_any_job(lines):
    with pytest.raises(ValueError, match="median"):
        aggregate(lines, AggregateSpec("t", "s", ("order_year",), (Metric("profit", "median"),)))
    with pytest.raises(ValueError, match="twice"):
        aggregate(lines, AggregateSpec("t", "s", ("order_year",), (Metric("profit", "sum"),) * 2))


def test_direct_and_paired_distinct_counts_agree(spark):
    frame = spark.createDataFrame(
        [("a", "x", 1, 0.1), ("a", "x", None, 0.2), ("a", None, 2, None), ("b", None, None, None), (None, "y", 3, -0.3)],
        "g string, o string, n int, v double",
    )
    metrics = (Metric("v", "sum"), Metric("n", "count"), Metric("o", "countDistinct"))
    paired = aggregate(frame, AggregateSpec("t", "s", ("g",), metrics))
    assert rows(paired) == [("a", 0.3, 2, 1), ("b", None, 0, 0), (None, -0.3, 1, 1)]
    both = aggregate(frame, AggregateSpec("t", "s", ("g",), (*metrics, Metric("n", "countDistinct"))))
    assert rows(both.drop("n_distinct_count")) == rows(paired)
    only = aggregate(frame, AggregateSpec("t", "s", ("g",), (Metric("o", "countDistinct"),)))
    assert rows(only) == [("a", 1), ("b", 0), (None, 1)]
    same = aggregate(frame, AggregateSpec("t", "s", ("g",), (Metric("g", "countDistinct"),)))
    assert rows(same) == [("a", 1), ("b", 1), (None, 0)]
    assert aggregate(frame.limit(0), AggregateSpec("t", "s", (), metrics)).first() == (None, 0, 0)


def test_sum_does_not_depend_on_order(spark):
    frame = spark.createDataFrame([(1, v) for v in (0.1, 0.2, 0.3, 1e15, -1e15, 0.4)], "g int, v double")
    spec = AggregateSpec("t", "s", ("g",), (Metric("v", "sum"),))
    assert {aggregate(frame.repartition(n), spec).first().total_v for n in (1, 2, 5)} == {1.0}


def test_sort_is_applied_on_request(lines):
    spec = AggregateSpec("t", "s", GRAIN, SPEC.metrics, ("order_year", "category"))
    assert [row.category for row in aggregate(lines, spec).collect()] == [
        "Furniture", "Technology", "Office Supplies", "Technology",
    ]


def test_rollups(lines):
    found = {name: [tuple(row) for row in frame.collect()] for name, frame in reports(aggregate(lines, SPEC)).items()}
    assert found == {
        "profit_by_year": [(2016, 251.25), (2017, 375.25)],
        "profit_by_year_category": [
            (2016, "Furniture", 301.25),
            (2016, "Technology", -50.0),
            (2017, "Office Supplies", 300.0),
            (2017, "Technology", 75.25),
        ],
        "profit_by_customer": [("C001", "Alice", 601.25), ("C002", "Bob", 25.25)],
        "profit_by_customer_year": [
            ("C001", "Alice", 2016, 301.25),
            ("C001", "Alice", 2017, 300.0),
            ("C002", "Bob", 2016, -50.0),
            ("C002", "Bob", 2017, 75.25),
        ],
    }


def test_all_rollups_equal_the_single_ones(lines):
    stored = aggregate(lines, SPEC)
    together = all_rollups(stored)
    for name, frame in reports(stored).items():
        part = together.where(F.col("rollup") == name).select(*frame.columns)
        assert rows(part) == rows(frame)
    assert together.count() == sum(frame.count() for frame in reports(stored).values())


def test_distinct_counts_are_not_summed(lines):
    stored = aggregate(lines, SPEC)
    with pytest.raises(ValueError, match="cannot be re-aggregated"):
        reaggregate(stored, ["order_year"], ["order_id_distinct_count"])
    with pytest.raises(ValueError, match="not a stored"):
        reaggregate(stored, ["order_year"], ["category"])
