"""Appends, reloads and publishing that breaks off."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom import AggregateSpec, Metric, SinkSpec
from tallyloom.plans import EmptyTableError, land, run_aggregated
from tallyloom.retail import SOURCES
from tallyloom.sinks import create_database, expire_versions, publish, qualified, recover, stage
from tallyloom.sinks import tables as sink_tables

DAY_1, DAY_2 = (datetime(2024, 1, day, 10, tzinfo=timezone.utc) for day in (1, 2))


@pytest.fixture
def database(spark, layout):
    for name in (layout.raw, layout.enriched):
        create_database(spark, name, layout.location_of(name))
    return layout.raw


@pytest.mark.parametrize("partitions", [(), ("ingested_at", "State"), ("State", "ingested_at"), ("State",)])
def test_a_batch_loaded_twice_counts_once_and_an_empty_one_changes_nothing(spark, layout, database, partitions):
    sink = SinkSpec(mode="append", partition_by=partitions)
    spec = replace(SOURCES[0], table="places", key=("Product ID",), sink=sink)

    def load(at, content):
        rows = spark.createDataFrame(content, "`Product ID` string, State string")
        return land(rows.withColumn("ingested_at", F.lit(at)), spec, layout, at).rows

    with pytest.raises(EmptyTableError):
        load(DAY_1, [])
    assert not spark.catalog.tableExists(qualified(database, "places"))
    assert load(DAY_1, [("P1", "NY"), ("P2", "CA")]) == 2
    assert load(DAY_2, [("P1", "NY"), ("P3", "TX")]) == 2
    assert load(DAY_2, [("P1", "NY"), ("P4", "NY"), ("P5", "CA")]) == 3
    with pytest.raises(EmptyTableError):
        load(DAY_2, [])
    stored = spark.table(qualified(database, "places")).select("Product ID", "State").collect()
    assert sorted(map(tuple, stored)) == [("P1", "NY"), ("P1", "NY"), ("P2", "CA"), ("P4", "NY"), ("P5", "CA")]


def test_appended_aggregates_keep_earlier_rows(spark, layout, database):
    rows = spark.createDataFrame([(2016, 1.0)], "y int, profit double")
    publish(spark, stage(rows, SinkSpec(), layout.enriched, "orders"), layout.enriched, "orders")
    spec = AggregateSpec("p", "orders", ("y",), (Metric("profit", "sum"),), ("y",), SinkSpec(mode="append"))
    assert [run_aggregated(spark, [spec], layout)[0].rows for _ in range(2)] == [1, 1]
    assert spark.table(qualified(layout.aggregated, "p")).count() == 2


@pytest.mark.parametrize("second", ["id + 1 as v", "cast(id as string) as w"])
@pytest.mark.parametrize("partitions", [(), ("k",)])
def test_a_publishing_that_fails_leaves_a_readable_table(spark, database, monkeypatch, second, partitions):
    sink = SinkSpec(partition_by=partitions)
    target = publish(spark, stage(spark.range(3).selectExpr("id as v", "1 as k"), sink, database, "t"), database, "t")
    staged = stage(spark.range(5).selectExpr(second, "1 as k"), sink, database, "t")
    asked = []

    class Failing:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text, **options):
            if text.startswith("ALTER TABLE") and "RENAME" in text and len(asked) == 1:
                raise RuntimeError("lost")
            asked.extend([text] if "RENAME" in text or "SET LOCATION" in text else [])
            return spark.sql(text, **options)

    if second.endswith("v") and not partitions:
        publish(Failing(), staged, database, "t")
        assert len(asked) == 1 and "SET LOCATION" in asked[0]
    else:
        with pytest.raises(RuntimeError, match="lost"):
            publish(Failing(), staged, database, "t")
        recover(spark, database, "t")
        assert spark.table(target).count() == 3
        publish(spark, staged, database, "t")
    assert spark.table(target).count() == 5
    assert not spark.catalog.tableExists(qualified(database, "t" + sink_tables.ASIDE))


def test_old_versions_go_when_asked(spark, database):
    for count in range(1, 5):
        target = publish(spark, stage(spark.range(count), SinkSpec(), database, "t"), database, "t")
    assert expire_versions(spark, database, "t", keep=1) == 2
    assert expire_versions(spark, database, "t", keep=1) == 0
    assert spark.table(target).count() == 4


def test_rows_of_each_file_are_sorted(spark, database):
    sink = SinkSpec(sort_by=("v",))
    rows = spark.range(100).selectExpr("(id * 37) % 100 as v").repartition(3)
    target = publish(spark, stage(rows, sink, database, "t"), database, "t")
    files = spark.table(target).select(F.input_file_name().alias("f"), "v").collect()
    for name in {row.f for row in files}:
        values = [row.v for row in files if row.f == name]
        assert values == sorted(values)
