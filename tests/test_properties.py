"""Property tests: exact draws, exact AUC, tracking identity."""

from __future__ import annotations

import hashlib
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pytest
from conftest import SF_MID
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clvspark.operators import evaluate as ev
from clvspark.operators.clv import kernels
from clvspark.operators.clv import models as cm
from clvspark.operators.sampling import exact_hash_sample
from clvspark.plans import registry as reg

SLOW = settings(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(n=st.integers(0, 400), fraction=st.sampled_from([0.0, 0.05, 0.2, 0.5, 0.8, 0.95, 1.0]),
       seed=st.integers(0, 10_000))
def test_draw_is_the_hash_order_prefix(spark, n, fraction, seed):
    ids = spark.range(n).withColumnRenamed("id", "customer_id")
    got = {r.customer_id for r in exact_hash_sample(ids, "customer_id", fraction, seed).collect()}
    k = int((Decimal(repr(fraction)) * n).quantize(Decimal(1), rounding=ROUND_HALF_EVEN))
    order = sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    assert got == set(order[:k])


@SLOW
@given(labels=st.lists(st.integers(0, 1), min_size=2, max_size=60),
       data=st.data())
def test_auc_matches_pairs(spark, labels, data):
    if len(set(labels)) < 2:
        labels = labels + [1 - labels[0]]
    scores = data.draw(st.lists(st.integers(0, 6), min_size=len(labels), max_size=len(labels)))
    df = spark.createDataFrame([(float(y), s / 6.0) for y, s in zip(labels, scores)],
                               "spend_90_flag double, pred_prob double")
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert ev.roc_auc(df, buckets=3).first().roc_auc == pytest.approx(want, abs=1e-12)


def test_expected_tracking_telescopes(spark):
    """Summed daily expectations equal each first-date cohort's E[X] at the end."""
    data = reg.orders_clv(spark, SF_MID)
    model = cm.fixed_model(cm.PNBD_PARAMS, reg.FIXED_PNBD)
    expected = (cm.tracking(model, data).filter(F.col("variable") == "pnbd")
                  .agg(F.sum("value")).first()[0])
    firsts = (data.daily.groupBy("customer_id").agg(F.min("date").alias("d"))
                  .groupBy("d").count().collect())
    end = data.daily.agg(F.max("date")).first()[0]
    ages = np.array([(end - r.d).days for r in firsts], float)
    counts = np.array([r["count"] for r in firsts], float)
    ex = kernels.pnbd_unconditional_expectation(np.array([reg.FIXED_PNBD]), ages)[0]
    assert expected == pytest.approx(float((counts * ex).sum()), rel=1e-9)


@SLOW
@given(keys=st.lists(st.integers(0, 12), min_size=1, max_size=300),
       members=st.sets(st.integers(0, 12)), how=st.sampled_from(["inner", "left_semi", "left_anti"]))
def test_salted_join_equals_plain_join(spark, keys, members, how):
    from clvspark.operators.skew import salted_join
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "customer_id long, v long")
    small = spark.createDataFrame([(m, m % 2 == 0) for m in sorted(members)],
                                  "customer_id long, flag boolean")
    got = salted_join(big, small, "customer_id", how, share=0.05, rows_per_task=7)
    want = big.join(small, "customer_id", how)
    assert sorted(got.collect()) == sorted(want.collect())
