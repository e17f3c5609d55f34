"""Plan-shape guards: pruning, pushdown and the skew-safe join stay in place."""

from __future__ import annotations

import re

from conftest import SF_MID

from clvspark.operators.cohort import cohort
from clvspark.plans import registry as reg
from clvspark.sources.transactions import event_transactions


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_scan_reads_three_columns(spark):
    plan = _plan(cohort(reg.orders_tx(spark, SF_MID), *reg.ORDERS_COHORT))
    # besides the orders, the plan reads the written per-customer table
    schemas = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "o_custkey" in s]
    assert schemas == ["o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"]
    assert "IsNotNull(o_custkey)" in plan


def test_cohort_membership_is_salted(spark):
    plan = _plan(cohort(reg.orders_tx(spark, SF_MID), *reg.ORDERS_COHORT))
    assert "_salt" in plan and "LeftSemi" in plan


def test_event_purchase_filter_reaches_the_scan(spark):
    plan = _plan(event_transactions(spark, SF_MID))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,purchase\)", plan)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "props" not in schema and "event_id" not in schema


def test_modelling_aggregate_has_no_exchange_above_the_split_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = reg.orders_prepared(spark, SF_MID)
        plan = _plan(p._tables_plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan.split("SortMergeJoin")[0]
    assert "Exchange" not in top          # the final aggregate reuses the join's partitioning
    assert "orders.parquet" not in plan   # it starts from the written customer-day rows
