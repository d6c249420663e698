"""Sums of values that no bounded decimal holds."""

from __future__ import annotations

import math

import pytest

from tallyloom import AggregateSpec, Metric
from tallyloom.operators import aggregate, join_growth, lookup, reaggregate


def total(spark, values, scale=None, kind="double", distinct=False):
    metrics = (Metric("v", "sum", scale),) + (Metric("o", "countDistinct"),) * distinct
    rows = spark.createDataFrame([(1, v, i % 3) for i, v in enumerate(values)], f"g int, v {kind}, o int")
    return aggregate(rows, AggregateSpec("t", "s", ("g",), metrics)).first()["total_v"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("distinct", [False, True])
def test_no_value_is_lost_or_cut(spark, settings, ansi, distinct):
    settings(ansi__enabled=ansi)
    assert total(spark, [1.0, 5e16], distinct=distinct) == 5e16 + 1
    assert total(spark, [1.004] * 3, scale=2, distinct=distinct) == 3.01
    assert total(spark, [4e-11] * 1_000, scale=2, distinct=distinct) == 0.0
    assert total(spark, [4e-4] * 100, scale=2, distinct=distinct) == 0.04
    assert math.isnan(total(spark, [1.0, math.nan], distinct=distinct))
    assert total(spark, [1.0, math.inf], distinct=distinct) == math.inf
    assert total(spark, [None, None], distinct=distinct) is None
    assert total(spark, [0.1] * 10 + [None], distinct=distinct) == 1.0
    assert total(spark, [2**62] * 4, kind="bigint", distinct=distinct) == 2.0**64


def test_stored_totals_are_added_without_loss(spark):
    stored = spark.createDataFrame([(1, 1.0), (1, 5e16), (2, 0.1), (2, 0.2)], "g int, total_v double")
    found = dict(map(tuple, reaggregate(stored, ["g"], ["total_v"]).collect()))
    assert found == {1: 5e16 + 1, 2: 0.3}


@pytest.mark.parametrize("mode", ["fanout", "unique", "error"])
def test_keys_of_several_columns(spark, mode):
    facts = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, None, 12), (None, "a", 13)], "k int, s string, v int")
    rows = [(1, "a", "x"), (1, "c", "y"), (2, None, "z"), (None, "a", "w")]
    rows += [(1, "a", "y")] if mode != "error" else []
    dimension = spark.createDataFrame(rows, "k int, s string, name string")
    found = sorted(map(tuple, lookup(facts, dimension, ("k", "s"), ["name"], mode).select("v", "name").collect()))
    expected = [(10, "x"), (11, None), (12, None), (13, None)]
    assert found == sorted(expected + [(10, "y")] * (mode == "fanout"), key=str)
    growth = join_growth(facts, dimension, ["k", "s"]).first()
    assert (growth.rows_before, growth.rows_after, growth.rows_unmatched) == (4, 4 + (mode != "error"), 3)
