"""F3, T1, T2, G3-G5, J1, F9, F11 and the fused flow (FIXTURES §3, SURVEY §5.3)."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SF_MID, tx_frame
from pyspark.sql import functions as F

from clvspark.operators import features as fe
from clvspark.operators import splits as sp
from clvspark.operators.sampling import exact_hash_sample, hash_split_flags
from clvspark.plans import registry as reg
from clvspark.plans.lifetime_value import prepare


@pytest.mark.parametrize("n,expected", [(10, 8), (11, 9), (12, 10)])
def test_split_size_exact(spark, n, expected):
    tx = tx_frame(spark, [(i, "1997-01-01", 1) for i in range(n)])
    s = sp.split_customers(tx, 0.8, 123)
    train = {r.customer_id for r in s.train.collect()}
    test = {r.customer_id for r in s.test.collect()}
    assert len(train) == expected
    assert train.isdisjoint(test) and train | test == set(range(n))


def test_split_independent_of_partitioning(spark):
    ids = spark.range(5000).withColumnRenamed("id", "customer_id")
    a = {r.customer_id for r in exact_hash_sample(ids.repartition(1), "customer_id", 0.37).collect()}
    b = {r.customer_id for r in exact_hash_sample(ids.repartition(13), "customer_id", 0.37).collect()}
    assert a == b and len(a) == round(0.37 * 5000)


def test_split_matches_global_hash_order(spark):
    ids = spark.range(3000).withColumnRenamed("id", "customer_id")
    got = {r.customer_id for r in exact_hash_sample(ids, "customer_id", 0.8, 7).collect()}
    import hashlib
    order = sorted(range(3000), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    assert got == set(order[:2400])


def test_split_flags_cover_every_key(spark):
    ids = spark.range(777).withColumnRenamed("id", "customer_id")
    flags = hash_split_flags(ids, "customer_id", 0.5, flag="f")
    assert flags.count() == 777 and flags.filter("f").count() == round(0.5 * 777)


def test_split_edge_fractions(spark):
    ids = spark.range(50).withColumnRenamed("id", "customer_id")
    assert exact_hash_sample(ids, "customer_id", 0.0).count() == 0
    assert exact_hash_sample(ids, "customer_id", 1.0).count() == 50


def test_assess_boundary(spark):
    m = dt.date(1998, 6, 30)
    rows = [(1, str(m), 5), (2, str(m - dt.timedelta(days=90)), 7),
            (3, str(m - dt.timedelta(days=89)), 9)]
    s = sp.time_split(tx_frame(spark, rows), "90 days")
    assert {r.customer_id for r in s.training.collect()} == {2}
    assert {r.customer_id for r in s.testing.collect()} == {1, 3}
    plan = {r.customer_id: r.split_key for r in sp.cv_plan(s).collect()}
    assert plan == {1: "testing", 2: "training", 3: "testing"}


def test_modelling_table_rules(spark):
    # 1: training and assessment rows; 2: training only; 3: assessment only
    rows = [(1, "1998-01-01", 10), (1, "1998-01-03", 20), (1, "1998-06-01", 5),
            (2, "1998-02-01", 7), (3, "1998-06-15", 9)]
    s = sp.time_split(tx_frame(spark, rows), "90 days")
    out = {r.customer_id: r for r in fe.modelling_table(s).collect()}
    assert set(out) == {1, 2}                      # assessment-only customer dropped
    assert out[2].spend_90_total == 0.0 and out[2].spend_90_flag == 0.0
    assert out[1].spend_90_total == 5.0 and out[1].spend_90_flag == 1.0
    assert out[1].frequency == 2 and out[1].price_sum == 30.0 and out[1].price_mean == 15.0
    assert out[2].recency == 0.0 and out[1].recency == -29.0


def test_test_recency_can_be_positive(spark):
    train = sp.time_split(tx_frame(spark, [(1, "1998-01-01", 1), (1, "1998-06-30", 1)]), "90 days")
    test = sp.time_split(tx_frame(spark, [(2, "1998-03-01", 1), (2, "1998-09-30", 1)]), "90 days")
    ref = fe.max_date(train.training)
    row = fe.modelling_table(test, ref).first()
    assert row.recency > 0


def test_fused_flow_equals_stepwise_operators(spark):
    tx = reg.orders_tx(spark, SF_MID)
    p = prepare(tx, *reg.ORDERS_COHORT, fraction=0.8, seed=123, assess="90 days")
    # stepwise: the operators one by one, as the reference chains them
    from clvspark.operators.cohort import cohort
    coh = cohort(tx, *reg.ORDERS_COHORT)
    cs = sp.split_customers(coh, 0.8, 123)
    tr, te = sp.time_split(cs.train, "90 days"), sp.time_split(cs.test, "90 days")
    ref = fe.max_date(tr.training)
    step_train = fe.modelling_table(tr, ref)
    step_test = fe.modelling_table(te, ref)
    assert sorted(p.train_table.collect()) == sorted(step_train.collect())
    assert sorted(p.test_table.collect()) == sorted(step_test.collect())
    # train recency is never positive
    assert p.train_table.filter(F.col("recency") > 0).count() == 0
