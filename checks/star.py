"""The test star under the mart's names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom import AggregateSpec, Metric
from tallyloom.operators import aggregate, lookup

GRAIN = ("order_year", "category", "sub_category", "customer_id", "customer_name")

PROFIT_BY_GRAIN = AggregateSpec(
    table="profit_by_grain",
    source="order_lines",
    group_by=GRAIN,
    metrics=(Metric("profit", "sum"), Metric("order_id", "countDistinct")),
)

#: Lines of one task from the join on the order to the totals. A line takes about 850 bytes there,
#: in two sorts and three hash tables.
LINES_PER_TASK = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def line_profit() -> Column:
    """Net revenue of a line in exact cents; every factor fits one machine word."""
    price = F.col("l_extendedprice").cast("decimal(13,2)")
    kept = F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(3,2)")
    return F.round(price * kept, 2)


def tasks_by_order(spark: SparkSession, folder: str, per_task: int = LINES_PER_TASK) -> int | None:
    """Into how many tasks the lines are dealt by order; None where adaptive execution's are small enough.

    It merges partitions up to 64 MB of compressed rows, which take thirty times that in a
    task. The count comes from the files' footers.
    """
    tasks = -(-table(spark, folder, "lineitem").count() // per_task)
    return tasks if tasks > spark.sparkContext.defaultParallelism else None


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the attributes of their order, customer and product.

    Customers join the orders, which are a fraction of the lines. Products join
    the lines before the orders do, so that the join on the order comes last:
    its partitioning then also serves the distinct count of orders that follows.
    The number of its tasks grows with the lines, so what one of them holds does not.
    """
    products = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.year("o_orderdate").alias("order_year"),
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        line_profit().alias("profit"),
    )
    known_orders = lookup(orders, customers, "customer_id", ["customer_name"])
    known_lines = lookup(lines, products, "product_id", ["category", "sub_category"])
    return lookup(
        known_lines,
        known_orders,
        "order_id",
        ["order_year", "customer_id", "customer_name"],
        partitions=tasks_by_order(spark, folder),
    )


def profit_by_grain(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate(order_lines(spark, folder), PROFIT_BY_GRAIN)
