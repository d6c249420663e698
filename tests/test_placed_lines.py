"""Order lines that lie by the start of their row id are deduplicated where they met their order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.compare import connect, difference
from checks.oracle import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"
PLACED = ["enriched_orders_unique", "enriched_orders_fanout", "profit_with_fanout"]


@pytest.mark.parametrize("name", PLACED)
def test_lines_are_exchanged_once_for_their_order_and_their_row_id(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    grown = queries.QUERIES[name](spark, SMALL)
    plan = grown._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(row_id_start" in line for line in sent) == 2  # lines and orders
    assert not any("hashpartitioning(row_id#" in line or "hashpartitioning(l_orderkey" in line for line in sent)
    assert difference(grown, connect(SMALL), ORACLE_SQL[name]) is None


def test_odd_line_keys_keep_their_rows(spark, settings, folder):
    """Null, negative and missing keys: a row id is kept once, and a line without an order meets none."""
    settings(autoBroadcastJoinThreshold="-1")
    for name in ("customer", "nation", "orders", "part"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    keys = [(1, 1), (1, 1), (1, None), (None, 1), (None, 2), (None, 2), (None, None), (-5, 3), (None, -5), (-5, None)]
    odd = spark.createDataFrame(keys, "l_orderkey long, l_linenumber int")
    one = lines.drop("l_orderkey", "l_linenumber").limit(1)
    odd.crossJoin(one).select(lines.columns).write.parquet(f"{folder}/lineitem.parquet")
    orders = {row.o_orderkey: row for row in spark.read.parquet(f"{SMALL}/orders.parquet").collect()}
    first = f"C{orders[1].o_custkey}"
    found = queries.QUERIES["enriched_orders_unique"](spark, str(folder))
    expected = [
        ("", "Unknown", "Unknown"),
        ("-5", "O-5", "Unknown"),
        ("-5-3", "O-5", "Unknown"),
        ("1", "O1", first),
        ("1-1", "O1", first),
        ("2", "Unknown", "Unknown"),
    ]
    assert sorted(map(tuple, found.select("row_id", "order_id", "customer_id").collect())) == expected
    assert found.where(F.col("row_id") == "2").first().order_date is None


def test_delivered_lines_do_not_show_where_they_lie(spark):
    assert queries.order_rows(spark, SMALL).columns == [name for name, _ in queries.LINE_SOURCE.columns]
