"""Shuffle counts of the core operators with broadcast joins off (as at
scale).  An extra Exchange here is a full extra shuffle on a cluster."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakezones import queries as Q
from lakezones.operators.changes import changed_rows, current_state, snapshot_diff
from lakezones.operators.rownum import attach_row_numbers, dense_row_number


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.split("\n")
            if re.search(r"\bExchange\b", line) and "BroadcastExchange" not in line]


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _orders(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    old = Q.old_orders(orders)
    versions = old.withColumn("batch_id", F.lit("b1")).withColumn("ROW_NUMBER", F.lit(1))
    return orders, old, current_state(versions, ["o_orderkey"]).select(*orders.columns)


def test_snapshot_diff_shuffles_each_side_once(no_broadcast):
    orders, old, _ = _orders(no_broadcast)
    assert len(_exchanges(snapshot_diff(orders, old))) == 2


def test_keyed_diff_reuses_the_state_partitioning(no_broadcast):
    orders, _, state = _orders(no_broadcast)
    ex = _exchanges(changed_rows(orders, state, orders.columns, base_unique=True, key=["o_orderkey"]))
    assert len(ex) == 2 and all("o_orderkey" in e and "struct" not in e for e in ex)


def test_key_only_numbering_moves_no_full_row_twice(no_broadcast):
    orders, _, state = _orders(no_broadcast)
    changed = changed_rows(orders, state, orders.columns, base_unique=True, key=["o_orderkey"])
    ex = _exchanges(attach_row_numbers(changed, orders, ["o_orderkey"]))
    # new rows by key, state by key, the checkpointed key numbers by key
    assert len(ex) == 3


def test_numbering_whole_rows_adds_no_shuffle_after_the_checkpoint(no_broadcast):
    orders = no_broadcast.read.parquet(f"{SF_SMALL}/orders.parquet")
    assert _exchanges(dense_row_number(orders, ["o_orderkey"])) == []


def test_wide_table_shuffles(no_broadcast):
    # orders and customer once each; lineitem by order key, the joined stream by part key; part once
    ex = _exchanges(Q.q_wide_table(no_broadcast, SF_SMALL))
    assert len(ex) == 6
