"""The retail mart: three sources, three enriched tables, one profit aggregate."""

from __future__ import annotations

from dataclasses import replace

from tallyloom.sources.files import BATCH_COLUMN
from tallyloom.specs import (
    AggregateSpec,
    CleanRules,
    EnrichSpec,
    JoinSpec,
    Metric,
    SinkSpec,
    SourceSpec,
)

# Columns of the source files, reader options, and stored columns.
PRODUCT_COLUMNS = (
    ("Product ID", "string"),
    ("Category", "string"),
    ("Sub-Category", "string"),
    ("Product Name", "string"),
    ("State", "string"),
    ("Price per product", "double"),
)
CUSTOMER_COLUMNS = (
    ("Customer ID", "string"),
    ("Customer Name", "string"),
    ("email", "string"),
    ("phone", "string"),
    ("address", "string"),
    ("Segment", "string"),
    ("Country", "string"),
    ("City", "string"),
    ("State", "string"),
    ("Postal Code", "string"),
    ("Region", "string"),
)
ORDER_COLUMNS = (
    ("Row ID", "int"),
    ("Order ID", "string"),
    ("Order Date", "string"),
    ("Ship Date", "string"),
    ("Ship Mode", "string"),
    ("Customer ID", "string"),
    ("Product ID", "string"),
    ("Quantity", "int"),
    ("Price", "double"),
    ("Discount", "double"),
    ("Profit", "double"),
)
CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"'}
JSON_OPTIONS = {"multiLine": "true"}
DATE_FORMAT = "d/M/yyyy"
CUSTOMER_CONTRACT = (
    "customer_id", "customer_name", "email", "phone", "address", "segment",
    "country", "city", "state", "postal_code", "region",
)
PRODUCT_CONTRACT = (
    "product_id", "category", "sub_category", "product_name", "state", "price_per_product",
)
ORDER_CONTRACT = (
    "row_id", "order_id", "order_date", "order_year", "ship_date", "ship_mode",
    "customer_id", "product_id", "quantity", "price", "discount", "profit",
    "customer_name", "country", "category", "sub_category",
)
PROFIT_GRAIN = ("order_year", "category", "sub_category", "customer_id", "customer_name")

# Keys, audited columns, cleaning rules, lookups, grain and order of every table.
SOURCES = (
    SourceSpec(
        table="products",
        format="csv",
        file_name="Products",
        columns=PRODUCT_COLUMNS,
        key=("Product ID", "Product Name", "State"),
        options=CSV_OPTIONS,
    ),
    SourceSpec(
        table="customers",
        format="xlsx",
        file_name="Customers",
        columns=CUSTOMER_COLUMNS,
        key=("Customer ID",),
    ),
    SourceSpec(
        table="orders",
        format="json",
        file_name="Orders",
        columns=ORDER_COLUMNS,
        key=("Row ID",),
        options=JSON_OPTIONS,
    ),
)

CUSTOMERS = EnrichSpec(
    table="customers",
    source="customers",
    key=("customer_id",),
    batch_column=BATCH_COLUMN,
    clean=CleanRules(
        names=("customer_name",),
        emails=("email",),
        phones=("phone",),
        postal_codes=("postal_code",),
    ),
    columns=CUSTOMER_CONTRACT,
)

PRODUCTS = EnrichSpec(
    table="products",
    source="products",
    key=("product_id", "product_name", "state"),
    batch_column=BATCH_COLUMN,
    columns=PRODUCT_CONTRACT,
)

ORDERS = EnrichSpec(
    table="orders",
    source="orders",
    key=("row_id",),
    batch_column=BATCH_COLUMN,
    clean=CleanRules(
        dates={"order_date": DATE_FORMAT, "ship_date": DATE_FORMAT},
        years={"order_year": "order_date"},
        rounding={"profit": 2},
    ),
    # A product id may stand for one product per state, so this lookup can
    # repeat order lines; see orders_with().
    joins=(
        JoinSpec("customers", "customer_id", ("customer_name", "country")),
        JoinSpec("products", "product_id", ("category", "sub_category")),
    ),
    critical=("order_id", "customer_id", "product_id"),
    columns=ORDER_CONTRACT,
)

ENRICHED = (CUSTOMERS, PRODUCTS, ORDERS)

PROFIT = AggregateSpec(
    table="profit_by_year_category_customer",
    source="orders",
    group_by=PROFIT_GRAIN,
    metrics=(Metric("profit", "sum", scale=2), Metric("order_id", "countDistinct")),
    order_by=("order_year", "category", "sub_category", "customer_name"),
)

AGGREGATES = (PROFIT,)


def orders_with(on_duplicate: str) -> EnrichSpec:
    """The orders enrichment with another answer to repeated dimension keys."""
    return replace(
        ORDERS, joins=tuple(replace(join, on_duplicate=on_duplicate) for join in ORDERS.joins)
    )


def appended(sources: tuple[SourceSpec, ...] = SOURCES) -> tuple[SourceSpec, ...]:
    """The same sources kept batch by batch instead of overwritten."""
    return tuple(replace(source, sink=SinkSpec(mode="append")) for source in sources)
