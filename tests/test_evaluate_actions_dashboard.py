"""E1-E3, O1, F5-F7, X4-X9, U2, N2, O3, D2-D3."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clvspark.functions import formatting as fm
from clvspark.operators import actions as ac
from clvspark.operators import dashboard as db
from clvspark.operators import evaluate as ev


def _scored(spark, labels, scores):
    return spark.createDataFrame([(float(y), float(s)) for y, s in zip(labels, scores)],
                                 "spend_90_flag double, pred_prob double")


def _brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def test_auc_ties_count_half(spark):
    assert ev.roc_auc(_scored(spark, [1, 0], [0.3, 0.3])).first().roc_auc == 0.5


@pytest.mark.parametrize("buckets", [1, 4, 64])
def test_auc_equals_all_pairs(spark, buckets):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 400).tolist()
    scores = np.round(rng.random(400) * 0.3 + np.array(labels) * 0.1, 2).tolist()  # many ties
    got = ev.roc_auc(_scored(spark, labels, scores), buckets=buckets).first().roc_auc
    assert got == pytest.approx(_brute_auc(labels, scores), abs=1e-12)
    flipped = ev.roc_auc(_scored(spark, labels, [-s for s in scores]), buckets=buckets).first()
    assert flipped.roc_auc == pytest.approx(1 - got, abs=1e-12)


def test_roc_curve_points(spark):
    labels, scores = [1, 0, 1, 0], [0.9, 0.1, 0.4, 0.4]
    rows = sorted(ev.roc_curve(_scored(spark, labels, scores)).collect(), key=lambda r: r.threshold)
    got = [(r.threshold, r.specificity, r.sensitivity) for r in rows]
    assert got == [(float("-inf"), 0.0, 1.0), (0.1, 0.0, 1.0), (0.4, 0.5, 1.0),
                   (0.9, 1.0, 0.5), (float("inf"), 1.0, 0.0)]


def test_single_class_auc_is_null(spark):
    assert ev.roc_auc(_scored(spark, [0, 0, 0], [0.1, 0.2, 0.3])).first().roc_auc is None


def test_mae(spark):
    df = spark.createDataFrame([(1.0, 2.0), (4.0, 1.0)], "spend_90_total double, pred_total double")
    assert ev.mae(df).first().mae == 2.0


def _pred(spark, rows):
    return spark.createDataFrame(rows, "pred_total double, pred_prob double, spend_90_total double,"
                                       " spend_90_flag double, customer_id long, recency double,"
                                       " frequency long, price_sum double, price_mean double")


def test_action_thresholds_strict(spark):
    p = _pred(spark, [(10.0, 0.2, 0.0, 0.0, 1, -90.0, 1, 5.0, 5.0),
                      (11.0, 0.1, 10.0, 1.0, 2, -10.0, 2, 9.0, 4.5),
                      (12.0, 0.19, 9.0, 1.0, 3, -89.0, 1, 9.0, 9.0),
                      (20.0, 0.5, 0.0, 0.0, 4, -5.0, 3, 9.0, 3.0)])
    assert [r.customer_id for r in ac.recent_but_unlikely(p).collect()] == [2, 3]
    assert [r.customer_id for r in ac.missed_opportunities(p).collect()] == [4, 1]
    assert [r.customer_id for r in ac.most_likely(p, 2).collect()] == [4, 1]
    table = ac.spend_more_table(db.dashboard_base(p, with_text=False))
    assert table.columns == list(fm.ACTION_TABLE_NAMES.values())
    assert [r["Cust Id"] for r in table.collect()] == [4, 3]   # 10.0 predicted / 10 actual out


def test_dashboard_base_offset_and_text(spark):
    p = _pred(spark, [(12.5, 0.1234, 10.0, 1.0, 7, -3.0, 2, 1234.5, 617.25)])
    row = db.dashboard_base(p).first()
    assert row.spend_actual_vs_pred == 10.0 - (12.5 + 0.0001)
    assert "90-Day Spend Prob: 12.3%" in row.text
    assert "Actual vs Pred: -$2.50" in row.text
    assert "Spend History (Total): $1,234.50" in row.text


def test_formatting(spark):
    df = spark.createDataFrame([(-5.0, 0.05), (1234.567, 1.0)], "v double, p double")
    rows = df.select(fm.currency("v").alias("c"), fm.percent("p").alias("q"),
                     fm.round_half_even(F.lit(2.675), 2).alias("r")).collect()
    assert [r.c for r in rows] == ["-$5.00", "$1,234.57"]
    assert [r.q for r in rows] == ["5.0%", "100.0%"]


def test_constant_feature_scales_to_null(spark):
    df = spark.createDataFrame([("frequency", 1.0), ("frequency", 1.0), ("recency", 1.0),
                                ("recency", 3.0)], "feature string, value double")
    out = {(r.feature, r.value): r.value_scaled for r in db.scale_within(df).collect()}
    assert out[("frequency", 1.0)] is None
    assert out[("recency", 1.0)] == pytest.approx(-1 / np.sqrt(2))


def test_features_long_and_sample(spark):
    rows = [(float(i), 0.5, 1.0, 0.0, i, -float(i), i, 10.0 * i, 10.0) for i in range(1, 41)]
    base = db.dashboard_base(_pred(spark, rows), with_text=False)
    sample = db.sample_fraction(base, 0.05)
    assert sample.count() == 2
    long = db.features_long(base)
    assert long.count() == 120 and set(long.columns) == {
        "customer_id", "pred_prob", "pred_total", "spend_90_total", "spend_actual_vs_pred",
        "feature", "value"}
    quant = db.probability_by_frequency(base).filter("frequency = 3").first()
    assert quant.customers == 1 and quant.q50_prob == 0.5
