"""Facts dealt once to a grid of tasks give the rows of one lookup after another."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.compare import connect, difference
from checks.oracle import ORACLE_SQL
from tallyloom import JoinSpec
from tallyloom.operators import enrich_left
from tallyloom.operators.joins import can_deal

SMALL = "/root/testdata/sf0.001"
DEALT = ["enriched_orders_unique", "enriched_orders_fanout", "profit_with_fanout"]


def rows(frame):
    return sorted(map(tuple, frame.select(sorted(frame.columns)).collect()), key=repr)


@pytest.fixture
def facts(spark):
    """Keys that match once, several times and never, null keys, and rows that occur twice."""
    line = spark.range(300)
    return line.select(
        F.when(line.id % 7 > 0, F.concat(F.lit("c"), line.id % 11)).alias("customer"),
        F.when(line.id % 5 > 0, line.id % 13).alias("product"),
        F.when(line.id % 3 > 0, F.date_add(F.lit("2024-01-01"), (line.id % 4).cast("int"))).alias("day"),
        (line.id % 150).alias("amount"),
    )


@pytest.fixture
def dimensions(spark):
    return {
        "customers": spark.createDataFrame(
            [(f"c{n}", f"name {n}") for n in range(9)] + [(None, "nobody")], "customer string, name string"
        ),
        "products": spark.createDataFrame(
            [(n, f"kind {n % 3}", copy) for n in range(10) for copy in range(n % 3 + 1)],
            "product long, kind string, copy int",
        ),
        "days": spark.sql("SELECT DATE'2024-01-02' AS day, 1L AS product, 'x' AS mark"),
    }


def joins(rule, count=2):
    return (
        JoinSpec("customers", "customer", ("name",), rule),
        JoinSpec("products", "product", ("kind", "copy"), rule),
        JoinSpec("days", ("day", "product"), ("mark",), rule),
    )[:count]


@pytest.mark.parametrize("tasks", [1, 2, 7, 12])
@pytest.mark.parametrize("rule, count", [("fanout", 2), ("unique", 2), ("fanout", 3), ("unique", 3)])
def test_dealt_lookups_equal_single_ones(facts, dimensions, rule, count, tasks):
    specs = joins(rule, count)
    assert can_deal(facts, dimensions, specs)
    dealt = enrich_left(facts, dimensions, specs, tasks)
    single = enrich_left(facts, dimensions, specs)
    assert sorted(dealt.columns) == sorted(single.columns)
    assert rows(dealt) == rows(single)


def test_dealt_lookups_name_a_repeated_key(facts, dimensions):
    with pytest.raises(Exception, match="occurs more than once"):
        enrich_left(facts, dimensions, joins("error"), 4).collect()


def test_dealt_lookups_refuse_present_columns(facts, dimensions):
    with pytest.raises(ValueError, match="already present"):
        enrich_left(facts.withColumn("kind", F.lit(1)), dimensions, joins("fanout"), 4)


def test_keys_that_may_hash_apart_are_looked_up_one_by_one(facts, dimensions):
    """An int and a long, an upper and a lower case of a collation, a key from another lookup."""
    specs = joins("fanout")
    narrow = facts.withColumn("product", F.col("product").cast("int"))
    assert not can_deal(narrow, dimensions, specs)
    collated = F.collate("customer", "UTF8_LCASE")
    upper = {**dimensions, "customers": dimensions["customers"].select(collated.alias("customer"), F.upper("name").alias("name"))}
    cased = facts.withColumn("customer", F.collate(F.upper("customer"), "UTF8_LCASE"))
    assert not can_deal(cased, upper, specs)
    for frame, found in ((narrow, dimensions), (cased, upper)):
        dealt = enrich_left(frame, found, specs, 6)
        assert rows(dealt) == rows(enrich_left(frame, found, specs))
    assert not can_deal(facts.drop("product"), dimensions, specs)


def test_hot_and_null_keys_are_dealt_to_several_tasks(spark, settings, dimensions):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    line = spark.range(3000)
    hot = line.select(F.lit("c1").alias("customer"), (line.id % 13).alias("product"), line.id.alias("amount"))
    nulls = hot.select(F.lit(None).cast("string").alias("customer"), F.lit(None).cast("long").alias("product"), "amount")
    for frame, least in ((hot, 3), (nulls, 9)):
        joined = enrich_left(frame, dimensions, joins("unique"), 9)
        assert joined.select(F.spark_partition_id()).distinct().count() == least
        assert joined.count() == 3000


@pytest.mark.parametrize("name", DEALT)
def test_many_lines_are_exchanged_once_for_both_lookups(spark, settings, monkeypatch, name):
    settings(autoBroadcastJoinThreshold="-1")
    plain = queries.QUERIES[name](spark, SMALL)
    assert "direct_shuffle_partition_id" not in plain._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr("checks.queries.tasks_by_order", lambda *_: 7)
    grown = queries.QUERIES[name](spark, SMALL)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange" in line]
    dealt = [line for line in sent if "direct_shuffle_partition_id" in line]
    assert len(dealt) == 3
    lines = sent.index(next(line for line in sent if "hashpartitioning(row_id" in line))
    assert sent[lines - 1] == dealt[0]
    assert not any("customer_id" in line or "product_id" in line for line in sent[: lines - 1] if "order_id" not in line and "order_year" not in line)
    assert difference(grown, connect(SMALL), ORACLE_SQL[name]) is None
