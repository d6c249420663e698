from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom import AggregateSpec, Metric
from tallyloom.functions import clean_name, normalise_phone, pad_postal
from tallyloom.operators import (
    aggregate,
    dedupe,
    duplicate_keys,
    duplicate_summary,
    join_growth,
    lookup,
    reaggregate,
    snake_case,
)

on_spark = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
texts = st.lists(
    st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=20)),
    min_size=1,
    max_size=60,
)
phones = st.lists(st.text("01234569 +-().x#", max_size=18), min_size=1, max_size=120)
keys = st.sampled_from(["a", "b", "c", None])
facts = st.lists(st.tuples(keys, keys, st.integers(-500, 500)), min_size=1, max_size=40)


def expected_phone(text: str) -> str | None:
    digits = re.sub("[^0-9]", "", text)
    if digits.startswith("001"):
        digits = digits[3:]
    elif digits.startswith("1") and len(digits) > 10:
        digits = digits[1:]
    return digits[:10] if len(digits) >= 10 else None


@given(st.text(max_size=30))
def test_snake_case_is_stable(name):
    once = snake_case(name)
    assert snake_case(once) == once
    assert re.fullmatch("([a-z0-9]+(_[a-z0-9]+)*)?", once)


@on_spark
@given(texts)
def test_cleaning_twice_changes_nothing(spark, values):
    frame = spark.createDataFrame([(value,) for value in values], "v string")
    for change in (clean_name, pad_postal):
        once = frame.select(change(F.col("v")).alias("once"))
        assert once.where(~change(F.col("once")).eqNullSafe(F.col("once"))).count() == 0


@on_spark
@given(phones)
def test_phones_match_the_rule_in_steps(spark, values):
    frame = spark.createDataFrame([(value, expected_phone(value)) for value in values], "v string, e string")
    assert frame.where(~normalise_phone(F.col("v")).eqNullSafe(F.col("e"))).count() == 0


@on_spark
@given(facts)
def test_dedupe_gives_unique_keys_and_real_rows(spark, rows):
    frame = spark.createDataFrame(rows, "k string, w string, v int")
    kept = dedupe(frame, ["k"])
    assert duplicate_keys(kept, ["k"]).count() == 0
    assert set(map(tuple, kept.collect())) <= set(rows)
    counts = duplicate_summary(frame, ["k"]).first()
    assert (counts.row_count, counts.key_count) == (len(rows), len({row[0] for row in rows}))
    assert kept.count() == counts.key_count == counts.row_count - counts.dropped


@on_spark
@given(facts, facts)
def test_joins_keep_every_fact(spark, rows, others):
    frame = spark.createDataFrame(rows, "k string, w string, v int")
    dimension = spark.createDataFrame(others, "k string, d string, e int")
    assert lookup(frame, dimension, "k", ["d", "e"], "unique").count() == len(rows)
    growth = join_growth(frame, dimension, "k").first()
    fanned = lookup(frame, dimension, "k", ["d", "e"])
    assert (growth.rows_before, growth.rows_after) == (len(rows), fanned.count())


@on_spark
@given(facts)
def test_rollups_add_up(spark, rows):
    frame = spark.createDataFrame(rows, "k string, w string, v int")
    spec = AggregateSpec("t", "s", ("k", "w"), (Metric("v", "sum"), Metric("v", "count")))
    stored = aggregate(frame, spec)
    coarse = reaggregate(stored, ["k"], ["total_v", "v_count"])
    assert sum(row.total_v for row in coarse.collect()) == sum(row[2] for row in rows)
    assert sum(row.v_count for row in coarse.collect()) == len(rows)
