"""What the physical plans must look like at any size, and under skew."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from checks.star import profit_by_grain, table, tasks_by_order
from tallyloom import AggregateSpec, Metric
from tallyloom.operators import aggregate, dedupe, join_growth, latest_batch, lookup

SMALL = "/root/testdata/sf0.001"


WRITING = {
    "mart_end_to_end", "stored_reports", "appended_batches", "reloaded_batch", "appended_enriched_batches",
    "csv_roundtrip", "json_roundtrip", "landed_workbooks", "repeated_runs", "quarantined_rows",
}


def initial_plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    """The plan as adaptive execution left it."""
    frame.collect()
    return initial_plan(frame).partition("== Initial Plan ==")[0]


def test_flagship_reads_only_what_it_needs(spark):
    plan = initial_plan(profit_by_grain(spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan


def test_flagship_at_scale_shuffles_lines_three_times(spark, settings):
    """By product, by order (which also serves the distinct count), and by group."""
    settings(autoBroadcastJoinThreshold="-1")
    plan = initial_plan(profit_by_grain(spark, SMALL))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 7
    assert sum("product_id" in line for line in exchanges) == 2
    assert sum("customer_id" in line and "order_year" not in line for line in exchanges) == 2
    assert sum("order_id" in line for line in exchanges) == 2
    assert sum("order_year" in line for line in exchanges) == 1


def test_flagship_deals_lines_to_more_tasks_as_they_grow(spark, monkeypatch, connection):
    """Adaptive execution would merge these small partitions into one."""
    plain = initial_plan(profit_by_grain(spark, SMALL))
    assert "REPARTITION_BY_NUM" not in plain
    monkeypatch.setattr("checks.star.tasks_by_order", lambda spark, folder: 40)
    grown = profit_by_grain(spark, SMALL)
    plan = initial_plan(grown)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(exchanges) == 2
    assert all(", 40), REPARTITION_BY_NUM" in line for line in exchanges)
    assert difference(grown, connection, ORACLE_SQL["profit_by_grain"]) is None


def test_tasks_by_order_follow_the_number_of_lines(spark):
    lines = table(spark, SMALL, "lineitem").count()
    assert tasks_by_order(spark, SMALL) is None
    assert tasks_by_order(spark, SMALL, 100) == -(-lines // 100)
    assert tasks_by_order(spark, SMALL, 50) == -(-lines // 50)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_plan_multiplies_rows_or_runs_row_by_row_python(spark, settings, name):
    for threshold in ("10m", "-1"):
        settings(autoBroadcastJoinThreshold=threshold)
        plan = initial_plan(QUERIES[name](spark, SMALL))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
            assert operator not in plan
        assert ("MapInPandas" in plan) == ("workbook" in name)


@pytest.fixture
def hot(spark):
    """Lines of which a third belong to one product, spread over many map tasks."""
    lines = table(spark, "/root/testdata/sf0.01", "lineitem").select(
        F.when(F.col("l_linenumber") <= 3, F.lit(7).cast("bigint"))
        .otherwise(F.col("l_partkey"))
        .alias("product_id"),
        "l_orderkey",
        "l_quantity",
        "l_shipdate",
    )
    return lines.repartition(16)


@pytest.mark.parametrize("on_duplicate", ["fanout", "unique", "error"])
def test_hot_key_is_split_in_the_join(spark, settings, hot, on_duplicate):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="40k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    products = table(spark, "/root/testdata/sf0.01", "part").select(
        F.col("p_partkey").alias("product_id"), "p_brand"
    )
    joined = lookup(hot, products.repartition(8), "product_id", ["p_brand"], on_duplicate)
    assert "skew=true" in final_plan(joined)
    grouped = lookup(hot, dedupe(products, ["product_id"]), "product_id", ["p_brand"], on_duplicate)
    assert "skew=true" in final_plan(grouped)
    plain = joined.agg(F.count("*"), F.count("p_brand"), F.sum("l_quantity")).first()
    assert plain == hot.agg(F.count("*"), F.count("*"), F.sum("l_quantity")).first()


def test_hot_order_is_split_though_its_partitioning_is_reused(spark, settings, hot):
    """The distinct count would reuse the join's partitioning; a split costs it one shuffle."""
    lines = hot.withColumn(
        "order_id", F.when(F.col("l_quantity") <= 17, F.lit(5).cast("bigint")).otherwise(F.col("l_orderkey"))
    )
    orders = table(spark, "/root/testdata/sf0.01", "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_orderstatus"
    )
    spec = AggregateSpec(
        "t", "s", ("o_orderstatus",), (Metric("l_quantity", "sum", 2), Metric("order_id", "countDistinct"))
    )
    plain = sorted(aggregate(lookup(lines, orders, "order_id", ["o_orderstatus"]), spec).collect())
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        adaptive__advisoryPartitionSizeInBytes="40k",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    counted = aggregate(lookup(lines, orders, "order_id", ["o_orderstatus"]), spec)
    assert "skew=true" in final_plan(counted)
    assert sorted(counted.collect()) == plain


def test_hot_key_is_reduced_before_the_shuffle(spark, hot):
    """Each map task sends one row for the hot key, however many it holds."""
    kept = dedupe(hot.withColumn("product_id", F.col("product_id") * 0), ["product_id"])
    assert len(kept.collect()) == 1
    assert rows_sent(kept._jdf.queryExecution().executedPlan().finalPhysicalPlan()) <= 16


def rows_sent(node):
    """Rows written by the last shuffle on the way to the result."""
    while True:
        if "ShuffleQueryStage" in node.nodeName():
            return node.plan().metrics().get("shuffleRecordsWritten").get().value()
        node = node.children().head()


def test_hot_key_on_both_sides_costs_no_product_of_rows(spark, hot):
    """Rows of the join are counted from one number per key and side."""
    growth = join_growth(hot, hot, "product_id").first()
    counts = [row["count"] for row in hot.groupBy("product_id").count().collect()]
    assert growth.rows_after == sum(count * count for count in counts)
    assert growth.rows_before == sum(counts)


def test_newest_batch_is_one_plan_with_a_pushed_filter(spark, folder):
    path = str(folder / "batches")
    rows = spark.range(100).selectExpr("id", "id % 4 as batch")
    rows.write.partitionBy("batch").parquet(path)
    newest = latest_batch(spark.read.parquet(path), "batch")
    assert newest.count() == 25
    plan = initial_plan(newest)
    assert plan.count("Subquery") >= 1
    assert "PartitionFilters: [isnotnull(batch" in plan


def test_newest_day_is_pushed_as_a_range(spark):
    plan = QUERIES["latest_batch"](spark, SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "GreaterThanOrEqual(ts," in plan or "ts#" in plan and ">= Subquery" in plan


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_lose_nothing_in_either_mode(spark, settings, connection, ansi):
    settings(ansi__enabled=ansi)
    found = QUERIES["sum_of_any_values"](spark, SMALL)
    assert difference(found, connection, ORACLE_SQL["sum_of_any_values"]) is None


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLE_SQL[name]) is None
