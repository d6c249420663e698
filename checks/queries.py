"""One query per operator, each over whole tables of the test star."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.rawfiles import pack_workbooks, write_csv, write_json_arrays, write_workbooks
from checks.star import line_profit, order_lines, profit_by_grain, table, tasks_by_order
from tallyloom import (
    AggregateSpec,
    CleanRules,
    EnrichSpec,
    Metric,
    SinkSpec,
    SourceSpec,
)
from tallyloom.operators import (
    aggregate,
    all_rollups,
    audit,
    clean,
    contract,
    dedupe,
    duplicate_keys,
    duplicate_summary,
    fill_missing,
    join_growth,
    latest_batch,
    lookup,
    preview,
    reaggregate,
    rollup,
    snake_case_columns,
    trim_strings,
    with_estimates,
)
from tallyloom.plans import (
    EmptyTableError,
    Layout,
    enrich,
    land,
    report_tables,
    run_aggregated,
    run_enriched,
    run_raw,
)
from tallyloom.plans.enriched import PROCESSED_COLUMN
from tallyloom.retail import (
    AGGREGATES,
    CUSTOMERS,
    ORDERS,
    PRODUCTS,
    PROFIT,
    SOURCES,
    orders_with,
)
from tallyloom.session import scratch_folder
from tallyloom.sinks import RUN_COLUMN, create_database, qualified
from tallyloom.sources import declared_schema, parse_workbooks, read_source, source_path
from tallyloom.sources.files import BATCH_COLUMN

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# --- aggregation and reports ------------------------------------------------

query("profit_by_grain")(profit_by_grain)


@query("profit_by_year")
def profit_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(profit_by_grain(spark, folder), "profit_by_year")


@query("profit_by_year_category")
def profit_by_year_category(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(profit_by_grain(spark, folder), "profit_by_year_category")


@query("profit_by_customer")
def profit_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(profit_by_grain(spark, folder), "profit_by_customer")


@query("profit_by_customer_year")
def profit_by_customer_year(spark: SparkSession, folder: str) -> DataFrame:
    return rollup(profit_by_grain(spark, folder), "profit_by_customer_year")


@query("profit_grouping_sets")
def profit_grouping_sets(spark: SparkSession, folder: str) -> DataFrame:
    return all_rollups(profit_by_grain(spark, folder))


@query("top_customers")
def top_customers(spark: SparkSession, folder: str) -> DataFrame:
    totals = reaggregate(
        profit_by_grain(spark, folder), ["customer_id", "customer_name"], ["total_profit"]
    )
    return preview(totals, 10, [F.desc("total_profit"), "customer_id"])


@query("sum_and_two_distinct_counts")
def sum_and_two_distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    spec = AggregateSpec(
        table="flags",
        source="lineitem",
        group_by=("l_returnflag", "l_linestatus"),
        metrics=(
            Metric("l_quantity", "sum", scale=2),
            Metric("l_orderkey", "countDistinct"),
            Metric("l_partkey", "countDistinct"),
        ),
        order_by=("l_returnflag", "l_linestatus"),
    )
    return aggregate(table(spark, folder, "lineitem"), spec)


@query("sum_of_any_values")
def sum_of_any_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values too large, too small and too finely divided for the decimals they are hinted to have."""
    number, quantity = F.col("l_linenumber") % 4, F.col("l_quantity").cast("double")
    value = (
        F.when(number == 0, quantity * 2.0**50)
        .when(number == 1, quantity / 1024)
        .when(number == 2, quantity * 2.0**-20)
        .otherwise(F.col("l_extendedprice"))
    )
    lines = table(spark, folder, "lineitem").select(
        F.elt(number.cast("int") + 1, F.lit("huge"), F.lit("fine"), F.lit("tiny"), F.lit("plain")).alias("kind"),
        value.alias("hinted"),
        value.alias("unhinted"),
        "l_orderkey",
    )
    spec = AggregateSpec(
        table="kinds",
        source="lineitem",
        group_by=("kind",),
        metrics=(
            Metric("hinted", "sum", scale=2),
            Metric("unhinted", "sum"),
            Metric("l_orderkey", "countDistinct"),
        ),
    )
    return aggregate(lines, spec)


@query("count_metric")
def count_metric(spark: SparkSession, folder: str) -> DataFrame:
    spec = AggregateSpec(
        table="priorities",
        source="orders",
        group_by=("o_orderpriority",),
        metrics=(Metric("customer_name", "count"), Metric("o_totalprice", "sum", scale=2)),
        order_by=("o_orderpriority",),
    )
    return aggregate(enrich_left_unmatched(spark, folder), spec)


@query("summed_counts")
def summed_counts(spark: SparkSession, folder: str) -> DataFrame:
    spec = AggregateSpec(
        table="line_counts",
        source="lineitem",
        group_by=("l_returnflag", "l_linestatus", "l_suppkey"),
        metrics=(Metric("l_orderkey", "count"), Metric("l_quantity", "sum", scale=2)),
    )
    stored = aggregate(table(spark, folder, "lineitem"), spec)
    return reaggregate(stored, ["l_returnflag"], ["l_orderkey_count", "total_l_quantity"])


@query("mergeable_distinct_counts")
def mergeable_distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct orders by customer and by year from one stored aggregate's sketches.

    Beside each exact count, taken from the lines, stands whether the estimate from the
    united sketches is within 5 %, three standard errors, of it.
    """
    lines = order_lines(spark, folder)
    spec = AggregateSpec(
        table="orders_by_grain",
        source="orders",
        group_by=("order_year", "category", "customer_id"),
        metrics=(Metric("order_id", "distinctSketch"), Metric("profit", "sum")),
    )
    stored = aggregate(lines, spec)
    answers = []
    for dimension in ("order_year", "customer_id"):
        exact = AggregateSpec("exact", "orders", (dimension,), (Metric("order_id", "countDistinct"),))
        united = with_estimates(reaggregate(stored, [dimension], ["order_id_distinct_sketch"]))
        close = F.abs(F.col("order_id_distinct_estimate") / F.col("order_id_distinct_count") - 1) <= 0.05
        answers.append(
            aggregate(lines, exact).join(united, dimension).select(
                F.lit(dimension).alias("dimension"),
                F.col(dimension).cast("bigint").alias("value"),
                F.col("order_id_distinct_count").alias("exact_orders"),
                close.alias("within_bound"),
            )
        )
    return answers[0].unionByName(answers[1])


# --- batches, renames and cleaning ------------------------------------------


@query("latest_batch")
def latest_event_batch(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return latest_batch(events, "ts", "day")


@query("snake_case_rename")
def snake_case_rename(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        F.col("p_partkey").alias("Part ID"),
        F.col("p_name").alias("PartName"),
        F.col("p_brand").alias("Sub-Brand"),
        F.col("p_type").alias("Type.Of  Part"),
        F.col("p_size").alias("_Size (cm)_"),
        F.col("p_retailprice").alias("retail_price"),
    )
    return snake_case_columns(part)


@query("trim_strings")
def trimmed_strings(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("   "), "p_name", F.lit("  ")).alias("p_name"),
        F.concat("p_brand", F.lit(" ")).alias("p_brand"),
        F.concat(F.lit(" "), "p_type", F.lit("  "), "p_name").alias("p_type"),
        "p_size",
    )
    return trim_strings(part)


@query("clean_names")
def cleaned_names(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.concat(F.lit("  O'"), "c_mktsegment", F.lit(" 567   -"), "c_name", F.lit(".. Jr.")).alias(
            "full_name"
        ),
    )
    return clean(customers, CleanRules(names=("name", "full_name")))


@query("validate_emails")
def validated_emails(spark: SparkSession, folder: str) -> DataFrame:
    """Every different word of the documents, as an address or as none."""
    words = table(spark, folder, "documents").select(
        F.explode(F.split("text", "[ \\t\\r\\n]+")).alias("raw")
    )
    addresses = words.distinct().withColumn("email", F.col("raw"))
    return clean(addresses, CleanRules(emails=("email",)))


@query("normalise_phones")
def normalised_phones(spark: SparkSession, folder: str) -> DataFrame:
    numbers = table(spark, folder, "documents").select(
        "doc_id",
        F.explode(
            F.regexp_extract_all("text", F.lit(r"[+(]?[0-9][0-9().x +-]{5,}[0-9]"), F.lit(0))
        ).alias("raw"),
    )
    return clean(numbers.withColumn("phone", F.col("raw")), CleanRules(phones=("phone",)))


@query("normalise_phone_cases")
def normalised_customer_phones(spark: SparkSession, folder: str) -> DataFrame:
    """Every prefix and length case, spelled from the customer's key and balance."""
    key, cents = F.col("c_custkey").cast("string"), F.floor(F.abs("c_acctbal") * 100)
    digits = F.lpad(F.concat(cents.cast("string"), key), 10, "7")
    raw = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("001-"), digits))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("1 ("), digits, F.lit(")x12")))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("#ERROR!"), digits))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("001"), key, F.lit("."), key))
        .otherwise(digits)
    )
    rows = table(spark, folder, "customer").select("c_custkey", raw.alias("raw"))
    return clean(rows.withColumn("phone", F.col("raw")), CleanRules(phones=("phone",)))


@query("pad_postal")
def padded_postal_codes(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_partkey").alias("code"),
        F.concat("p_partkey", F.lit("-"), "p_size").alias("long_code"),
    )
    return clean(part, CleanRules(postal_codes=("code", "long_code")))


@query("parse_dates")
def parsed_dates(spark: SparkSession, folder: str) -> DataFrame:
    rendered = F.date_format("o_orderdate", "d/M/yyyy")
    spoilt = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "'31/2/'yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "P", F.lit("not-a-date"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(rendered)
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", spoilt.alias("raw"), spoilt.alias("order_date")
    )
    rules = CleanRules(
        dates={"order_date": "d/M/yyyy", "ship_date": "d/M/yyyy"},
        years={"order_year": "order_date", "ship_year": "ship_date"},
    )
    return clean(orders, rules)


@query("round_values")
def rounded_values(spark: SparkSession, folder: str) -> DataFrame:
    exact_product = F.col("l_quantity").cast("decimal(13,2)") * F.col("l_tax").cast("decimal(3,2)")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        exact_product.alias("tax_share"),
        exact_product.alias("whole_share"),
    )
    rounded = clean(lines, CleanRules(rounding={"tax_share": 1, "whole_share": 0, "absent": 2}))
    return rounded.select(
        "l_orderkey",
        "l_linenumber",
        F.col("tax_share").cast("double").alias("tax_share"),
        F.col("whole_share").cast("double").alias("whole_share"),
    )


# --- data quality -----------------------------------------------------------


@query("dedupe_on_key")
def dedupe_on_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return dedupe(lines, ["l_orderkey", "l_linenumber"])


@query("dedupe_preferring_latest_shipment")
def dedupe_preferring_latest_shipment(spark: SparkSession, folder: str) -> DataFrame:
    """The survivor is the line that ships last: the order is part of the request."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.datediff(F.lit("2030-01-01").cast("date"), F.to_date("l_shipdate")).alias("days_left"),
    )
    return dedupe(lines, ["l_orderkey"], prefer=["days_left"])


@query("duplicate_keys")
def duplicate_key_report(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_summary")
def duplicate_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_summary(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def _customers_with_some_nations(spark: SparkSession, folder: str) -> DataFrame:
    """Nations are looked up by a key that only those of two regions have."""
    known = F.when(F.col("n_regionkey").isin(0, 3), F.col("n_nationkey"))
    nations = table(spark, folder, "nation").select(
        known.alias("c_nationkey"), "n_name", "n_regionkey"
    ).withColumn("n_weight", F.col("n_regionkey").cast("bigint"))
    nations = nations.withColumn("n_share", F.col("n_regionkey").cast("decimal(8,2)"))
    nations = nations.withColumn("n_known", F.lit(True))
    customers = table(spark, folder, "customer")
    return lookup(
        customers,
        nations,
        "c_nationkey",
        ["n_name", "n_regionkey", "n_weight", "n_share", "n_known"],
    )


@query("fill_missing")
def filled_missing(spark: SparkSession, folder: str) -> DataFrame:
    filled = fill_missing(
        _customers_with_some_nations(spark, folder), ["c_custkey"], keep_null=["n_regionkey"]
    )
    return filled.withColumn("n_share", F.col("n_share").cast("double"))


@query("audit_table")
def table_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit(_customers_with_some_nations(spark, folder), ["c_custkey", "n_name"])


# --- joins ------------------------------------------------------------------


@query("enrich_left_unmatched")
def enrich_left_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Only customers of one segment have the key by which orders look them up."""
    known = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey"))
    customers = table(spark, folder, "customer").select(
        known.alias("customer_id"), F.col("c_name").alias("customer_name")
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        "o_orderpriority",
        "o_totalprice",
    )
    return lookup(orders, customers, "customer_id", ["customer_name"])


def _lines_and_flags(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    lineitem = table(spark, folder, "lineitem")
    lines = lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    flags = lineitem.select("l_partkey", F.col("l_returnflag").alias("flag")).distinct()
    return lines, flags


@query("enrich_left_fanout")
def enrich_left_fanout(spark: SparkSession, folder: str) -> DataFrame:
    lines, flags = _lines_and_flags(spark, folder)
    return lookup(lines, flags, "l_partkey", ["flag"], on_duplicate="fanout")


@query("enrich_left_unique")
def enrich_left_unique(spark: SparkSession, folder: str) -> DataFrame:
    lines, flags = _lines_and_flags(spark, folder)
    return lookup(lines, flags, "l_partkey", ["flag"], on_duplicate="unique")


@query("enrich_left_checked")
def enrich_left_checked(spark: SparkSession, folder: str) -> DataFrame:
    lines, _ = _lines_and_flags(spark, folder)
    parts = table(spark, folder, "part").withColumnRenamed("p_partkey", "l_partkey")
    return lookup(lines, parts, "l_partkey", ["p_brand", "p_size"], on_duplicate="error")


@query("enrich_left_composite_key")
def enrich_left_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    """What was sold of a part by a supplier, and kept, is known by both keys together.

    Lines that came back have no part key, so their supplier's rows match nothing.
    """
    lines, _ = _lines_and_flags(spark, folder)
    kept = F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))
    sold = table(spark, folder, "lineitem").withColumn("l_partkey", kept)
    largest = sold.groupBy("l_partkey", "l_suppkey").agg(F.max("l_quantity").alias("largest"))
    return lookup(lines, largest, ("l_partkey", "l_suppkey"), ["largest"], on_duplicate="error")


@query("join_growth")
def fan_out_report(spark: SparkSession, folder: str) -> DataFrame:
    lines, flags = _lines_and_flags(spark, folder)
    known = F.when(F.col("flag") != "A", F.col("l_partkey"))
    return join_growth(lines, flags.withColumn("l_partkey", known), "l_partkey")


@query("schema_contract")
def schema_contract(spark: SparkSession, folder: str) -> DataFrame:
    return contract(
        table(spark, folder, "orders"),
        ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice"],
    )


# --- sources, sinks and layers ----------------------------------------------

PRODUCT_SOURCE, CUSTOMER_SOURCE, ORDER_SOURCE = SOURCES

# Line keys of a large star do not fit the declared int, so they travel as text.
LINE_SOURCE = replace(
    ORDER_SOURCE,
    columns=tuple(
        (name, "string" if name == "Row ID" else kind) for name, kind in ORDER_SOURCE.columns
    ),
)


def product_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Products with commas, quotes and line breaks in their names."""
    return table(spark, folder, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"\n'), "p_type").alias("Product Name"),
        F.concat(F.lit("State "), "p_size").alias("State"),
        F.col("p_retailprice").alias("Price per product"),
    )


def customer_rows(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Country")
    )
    customers = lookup(table(spark, folder, "customer"), nations, "c_nationkey", ["Country"])
    key = F.col("c_custkey").cast("string")
    return customers.select(
        F.concat(F.lit("C"), key).alias("Customer ID"),
        F.concat("c_mktsegment", F.lit("  & "), "c_name").alias("Customer Name"),
        F.when(F.col("c_acctbal") < 0, F.lit("no <mail>"))
        .otherwise(F.concat(F.lit("c"), key, F.lit("@example.com")))
        .alias("email"),
        F.concat(F.lit("001-"), F.lpad(key, 10, "5")).alias("phone"),
        F.concat(key, F.lit(" Main St")).alias("address"),
        F.col("c_mktsegment").alias("Segment"),
        "Country",
        F.lit(None).cast("string").alias("City"),
        F.concat(F.lit("State "), F.col("c_nationkey")).alias("State"),
        key.alias("Postal Code"),
        F.lit("NA").alias("Region"),
    )


#: Fixed value: the delivered column by which order lines lie.
ROW_ID_START = "Row ID Start"


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as delivered: repeated line keys, dates as text, some of them bad."""
    return _placed_order_rows(spark, folder, F.col("l_orderkey")).drop(ROW_ID_START)


def _placed_order_rows(spark: SparkSession, folder: str, start: Column) -> DataFrame:
    """Order lines as delivered, with the number by which they met their order and lie once they are many.

    It is the order's; lines without an order may have another and match nothing.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("row_id_start"), "o_custkey", "o_orderdate", "o_orderstatus"
    )
    lines = lookup(
        table(spark, folder, "lineitem").withColumn("row_id_start", start),
        orders,
        "row_id_start",
        ["o_custkey", "o_orderdate", "o_orderstatus"],
    )
    ordered = F.col("l_orderkey").isNotNull()
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Row ID"),
        F.concat(F.lit("O"), "l_orderkey").alias("Order ID"),
        F.when(ordered & (F.col("o_orderstatus") == "P"), F.lit("unknown"))
        .when(ordered, F.date_format("o_orderdate", "d/M/yyyy"))
        .alias("Order Date"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("Ship Date"),
        F.concat(F.lit(" "), "l_returnflag", "l_linestatus").alias("Ship Mode"),
        F.when(ordered, F.concat(F.lit("C"), "o_custkey")).alias("Customer ID"),
        F.concat(F.lit("P"), "l_partkey").alias("Product ID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_discount").alias("Discount"),
        line_profit().cast("double").alias("Profit"),
        F.col("row_id_start").alias(ROW_ID_START),
    )


def _reread(spark: SparkSession, source: SourceSpec, base: str) -> DataFrame:
    rows = read_source(spark, source, source_path(base, source))
    return snake_case_columns(rows.drop(BATCH_COLUMN))


@query("csv_roundtrip")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_folder(spark)
    write_csv(product_rows(spark, folder), source_path(base, PRODUCT_SOURCE))
    return _reread(spark, PRODUCT_SOURCE, base)


@query("json_roundtrip")
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_folder(spark)
    write_json_arrays(order_rows(spark, folder), source_path(base, LINE_SOURCE))
    return _reread(spark, LINE_SOURCE, base)


@query("workbook_ingest")
def workbook_ingest(spark: SparkSession, folder: str) -> DataFrame:
    books = pack_workbooks(customer_rows(spark, folder))
    return snake_case_columns(parse_workbooks(books, declared_schema(CUSTOMER_SOURCE.columns)))


@query("typed_workbook_ingest")
def typed_workbook_ingest(spark: SparkSession, folder: str) -> DataFrame:
    books = pack_workbooks(product_rows(spark, folder))
    return snake_case_columns(parse_workbooks(books, declared_schema(PRODUCT_SOURCE.columns)))


#: Lines of one task that looks up customers and products, about 500 bytes each in two sorts.
JOINED_LINES_PER_TASK = 1_000_000

LOADED_AT = datetime(2024, 1, 2, 10, tzinfo=timezone.utc)


def _enriched(rows: DataFrame, spec: EnrichSpec, dimensions=None) -> DataFrame:
    """The enrichment of a single delivery; rows without batches need none picked."""
    return enrich(rows, replace(spec, batch_column=None), dimensions).drop(PROCESSED_COLUMN)


def products_by_state(spark: SparkSession, folder: str) -> DataFrame:
    """Products that repeat their id in up to three states."""
    states = table(spark, folder, "lineitem").select(
        F.concat(F.lit("P"), "l_partkey").alias("Product ID"), F.col("l_returnflag").alias("State")
    )
    products = product_rows(spark, folder).drop("State")
    return lookup(products, states.distinct(), "Product ID", ["State"])


def _delivered(customers: DataFrame) -> DataFrame:
    """Without one segment, so that some order lines match no customer."""
    return customers.where(F.col("Segment") != "BUILDING")


def _stocked(products: DataFrame) -> DataFrame:
    """Without one category, so that some order lines match no product."""
    return products.where(F.col("Category") != "ECONOMY")


def _dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "customers": _enriched(_delivered(customer_rows(spark, folder)), CUSTOMERS),
        "products": _enriched(_stocked(products_by_state(spark, folder)), PRODUCTS),
    }


@query("enriched_customers")
def enriched_customers(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(customer_rows(spark, folder), CUSTOMERS)


@query("enriched_products")
def enriched_products(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(products_by_state(spark, folder), PRODUCTS)


def _enriched_orders(spark: SparkSession, folder: str, orders: EnrichSpec) -> DataFrame:
    """Once the lines are many, they are exchanged once for their order and their row id, and once for both lookups.

    The number that a row id starts with depends on the id alone, so the key stays the row id.
    """
    start = F.coalesce("l_orderkey", "l_linenumber")
    tasks = tasks_by_order(spark, folder, JOINED_LINES_PER_TASK)
    placed = replace(orders, key=("row_id_start", *orders.key), join_tasks=tasks)
    return _enriched(_placed_order_rows(spark, folder, start), placed, _dimensions(spark, folder))


@query("enriched_orders_fanout")
def enriched_orders_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Some customers and products are left out, so that unmatched order lines show."""
    return _enriched_orders(spark, folder, ORDERS)


@query("enriched_orders_unique")
def enriched_orders_unique(spark: SparkSession, folder: str) -> DataFrame:
    """Some customers and products are left out, so that unmatched order lines show."""
    return _enriched_orders(spark, folder, orders_with("unique"))


@query("profit_with_fanout")
def profit_with_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """The stored aggregate over order lines that a partial product key repeats, some unmatched."""
    return aggregate(enriched_orders_fanout(spark, folder), PROFIT)


def _new_layout(spark: SparkSession) -> Layout:
    base = scratch_folder(spark)
    run = base.rpartition("-")[2]
    return Layout(f"raw_{run}", f"enriched_{run}", f"aggregated_{run}", location=base)


def _answer(frame: DataFrame, layout: Layout) -> DataFrame:
    """The rows, kept in the shared folder; the run's databases and files go."""
    spark = frame.sparkSession
    kept = frame.checkpoint()
    for database in (layout.raw, layout.enriched, layout.aggregated):
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    return kept


@query("appended_batches")
def appended_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads kept side by side; the newest is read back by pruning to its batch."""
    layout = _new_layout(spark)
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    source = replace(PRODUCT_SOURCE, sink=SinkSpec(mode="append"))
    rows = product_rows(spark, folder)
    stale = rows.withColumn("Category", F.lit("stale"))
    for day, batch in ((1, stale), (2, rows)):
        at = datetime(2024, 1, day, 10, tzinfo=timezone.utc)
        land(batch.withColumn(BATCH_COLUMN, F.lit(at)), source, layout, at)
    stored = spark.table(qualified(layout.raw, source.table))
    return _answer(snake_case_columns(latest_batch(stored, BATCH_COLUMN)), layout)


@query("reloaded_batch")
def reloaded_batch(spark: SparkSession, folder: str) -> DataFrame:
    """One batch loaded twice and then delivered empty, in a table that is not partitioned by it first."""
    layout = _new_layout(spark)
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    sink = SinkSpec(mode="append", partition_by=("Category", BATCH_COLUMN))
    source = replace(PRODUCT_SOURCE, sink=sink)
    rows = product_rows(spark, folder).withColumn(BATCH_COLUMN, F.lit(LOADED_AT))
    for _ in range(2):
        land(rows, source, layout, LOADED_AT)
    with contextlib.suppress(EmptyTableError):
        land(rows.where("false"), source, layout, LOADED_AT)
    stored = spark.table(qualified(layout.raw, source.table)).drop(BATCH_COLUMN)
    return _answer(snake_case_columns(stored), layout)


@query("appended_enriched_batches")
def appended_enriched_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two enrichments of the customers, the second added to the first."""
    layout = _new_layout(spark)
    create_database(spark, layout.raw, layout.location_of(layout.raw))
    rows = customer_rows(spark, folder).withColumn(BATCH_COLUMN, F.lit(LOADED_AT))
    land(rows, CUSTOMER_SOURCE, layout, LOADED_AT)
    for _ in range(2):
        run_enriched(spark, [replace(CUSTOMERS, sink=SinkSpec(mode="append"))], layout, LOADED_AT)
    stored = spark.table(qualified(layout.enriched, CUSTOMERS.table)).drop(PROCESSED_COLUMN)
    return _answer(stored, layout)


def _landed_customers(spark: SparkSession, folder: str) -> Layout:
    """Customers delivered as workbooks and landed as the raw layer lands them."""
    layout = _new_layout(spark)
    files = f"{layout.location}/files"
    write_workbooks(customer_rows(spark, folder), source_path(files, CUSTOMER_SOURCE))
    run_raw(spark, [CUSTOMER_SOURCE], files, layout, LOADED_AT)
    return layout


@query("landed_workbooks")
def landed_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table of customers that were delivered as workbooks, with its load time."""
    layout = _landed_customers(spark, folder)
    stored = spark.table(qualified(layout.raw, CUSTOMER_SOURCE.table))
    at_load = (F.col(BATCH_COLUMN) == F.lit(LOADED_AT)).alias("stamped")
    return _answer(snake_case_columns(stored.select("*", at_load).drop(BATCH_COLUMN)), layout)


@query("repeated_runs")
def repeated_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs add the customers to the enriched and aggregated tables; the second runs three times."""
    layout = _landed_customers(spark, folder)
    sink = SinkSpec(mode="append")
    per_country = AggregateSpec(
        "customers_by_country", "customers", ("country",), (Metric("customer_id", "countDistinct"),), sink=sink
    )
    for run in ("first", "second", "second", "second"):
        run_enriched(spark, [replace(CUSTOMERS, sink=sink)], layout, LOADED_AT, run)
        run_aggregated(spark, [per_country], layout, run)
    rows = spark.table(qualified(layout.enriched, CUSTOMERS.table))
    stored = spark.table(qualified(layout.aggregated, per_country.table))
    enriched = rows.groupBy(RUN_COLUMN, "country", PROCESSED_COLUMN).agg(F.count("*").alias("enriched_rows"))
    enriched = enriched.withColumn("stamped", F.col(PROCESSED_COLUMN) == F.lit(LOADED_AT)).drop(PROCESSED_COLUMN)
    return _answer(enriched.join(stored, [RUN_COLUMN, "country"], "full"), layout)


def _bad_lines(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Order lines as CSV text by kind of file: most fit, some do not, one file is swapped."""
    lines = table(spark, folder, "lineitem").select(
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("line"),
        F.concat(F.lit('"'), "l_linestatus", F.lit(', ""'), "l_returnflag", F.lit('"""')).alias("mode"),
        F.when(F.col("l_quantity") == 7, F.lit("seven")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(F.col("l_quantity") == 11, F.concat("l_extendedprice", F.lit(",0"))).otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        (F.col("l_suppkey") % 7 == 0).alias("swapped"),
    )
    right = lines.where("NOT swapped").select(F.concat_ws(",", "line", "mode", "quantity", "price").alias("value"))
    wrong = lines.where("swapped").select(F.concat_ws(",", "mode", "line", "quantity", "price").alias("value"))
    return {"Line,Mode,Quantity,Price": right, "Mode,Line,Quantity,Price": wrong}


@query("quarantined_rows")
def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines that land, and those in quarantine for a bad number, a field too many or their header."""
    layout = _new_layout(spark)
    source = SourceSpec(
        table="lines",
        format="csv",
        file_name="Lines",
        columns=(("Line", "string"), ("Mode", "string"), ("Quantity", "int"), ("Price", "double")),
        key=("Line",),
        options=PRODUCT_SOURCE.options,
        quarantine=True,
    )
    path = source_path(f"{layout.location}/files", source)
    for header, lines in _bad_lines(spark, folder).items():
        with_header = lines.mapInPandas(_headed(header), "value string")
        with_header.write.mode("append").text(path)
    report = run_raw(spark, [source], f"{layout.location}/files", layout, LOADED_AT)[0]
    good = spark.table(qualified(layout.raw, "lines")).agg(
        F.lit("landed").alias("reason"),
        F.count("*").alias("row_count"),
        F.count_if(F.col("Mode").contains(', "')).alias("as_delivered"),
        F.sum("Quantity").alias("quantity"),
    )
    delivered = F.col("record").contains(",seven,") | F.col("record").endswith(",0")
    bad = spark.table(qualified(layout.raw, "lines_rejected"))
    bad = bad.where(~F.col("record").startswith("Mode,")).groupBy("reason").agg(
        F.count("*").alias("row_count"),
        F.count_if(delivered).alias("as_delivered"),
        F.lit(None).cast("bigint").alias("quantity"),
    )
    both = good.unionByName(bad)
    return _answer(both.withColumn("reported", F.lit(report.rows).cast("bigint")), layout)


def _headed(header: str):
    """The lines of a task's file after its header."""

    def add(batches):
        import pandas as pd

        started = False
        for batch in batches:
            if len(batch) and not started:
                started = True
                yield pd.DataFrame({"value": [header]})
            yield batch

    return add


def _run_mart(spark: SparkSession, folder: str) -> Layout:
    """Files to raw, enriched and aggregated tables.

    Some customers and products are not delivered, so their order lines stay
    unmatched and are stored as unknown. Customers are delivered as CSV here.
    """
    layout = _new_layout(spark)
    files = f"{layout.location}/files"
    customers = replace(
        CUSTOMER_SOURCE, format="csv", options={**PRODUCT_SOURCE.options, "nullValue": "NA"}
    )
    write_csv(_stocked(product_rows(spark, folder)), source_path(files, PRODUCT_SOURCE))
    write_csv(_delivered(customer_rows(spark, folder)), source_path(files, customers))
    write_json_arrays(order_rows(spark, folder), source_path(files, LINE_SOURCE))
    run_raw(spark, [PRODUCT_SOURCE, customers, LINE_SOURCE], files, layout, LOADED_AT)
    run_enriched(spark, [CUSTOMERS, PRODUCTS, ORDERS], layout, LOADED_AT)
    run_aggregated(spark, AGGREGATES, layout)
    return layout


@query("mart_end_to_end")
def mart_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """The stored aggregate of a whole run of all layers."""
    layout = _run_mart(spark, folder)
    return _answer(spark.table(qualified(layout.aggregated, PROFIT.table)), layout)


@query("stored_reports")
def stored_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The report by customer over the stored aggregate, and the same from its view by SQL."""
    layout = _run_mart(spark, folder)
    report = report_tables(spark, PROFIT.table, layout)["profit_by_customer"]
    by_sql = spark.sql(
        f"SELECT customer_id, customer_name, ROUND(SUM(total_profit), 2) AS total_profit "
        f"FROM v_{PROFIT.table} GROUP BY customer_id, customer_name"
    )
    both = report.withColumn("origin", F.lit("report")).unionByName(
        by_sql.withColumn("origin", F.lit("view"))
    )
    return _answer(both, layout)
