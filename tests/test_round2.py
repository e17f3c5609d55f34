"""Exact quantiles, money, smoothing, skew and spending models at the edges."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clvspark.functions.formatting import plain_number
from clvspark.functions.money import exact_sum
from clvspark.operators.clv import data as cd
from clvspark.operators.clv import models as cm
from clvspark.operators.clv.optimize import maximize
from clvspark.operators.cohort import cohort
from clvspark.operators.quantiles import rank_quantiles
from clvspark.operators.skew import hot_keys
from clvspark.operators.timeseries import smooth_trend
from clvspark.plans.lifetime_value import prepare
from clvspark.session import materialize, scratch_tables

from conftest import SF_MID, tx_frame


def test_quantiles_exact_above_ten_thousand(spark):
    n = 30_011
    df = spark.range(n).select(F.pmod(F.col("id"), F.lit(2)).alias("g"),
                               (F.pmod(F.xxhash64("id"), F.lit(50_000)) / 7).alias("v"))
    df = df.unionByName(spark.createDataFrame([(5, None), (5, 1.0), (6, None)], "g long, v double"))
    got = {r.g: r for r in rank_quantiles(df, "g", "v", {"q05": 0.05, "q50": 0.5, "q99": 0.99}).collect()}
    values = {}
    for r in df.collect():
        if r.v is not None:
            values.setdefault(r.g, []).append(r.v)
    assert set(got) == set(values)
    for g, v in values.items():
        v.sort()
        for name, q in (("q05", 0.05), ("q50", 0.5), ("q99", 0.99)):
            assert got[g][name] == v[max(1, math.ceil(q * len(v))) - 1]


def test_fine_prices_are_not_rounded(spark):
    df = spark.createDataFrame([(0.001,), (0.002,), (12345.6789,)], "p double")
    assert df.agg(exact_sum("p").alias("s")).first().s == pytest.approx(12345.6819, abs=1e-12)
    tx = tx_frame(spark, [(1, "1997-01-02", 0.004), (1, "1997-02-02", 0.004), (2, "1997-01-05", 1.0)])
    assert cd.clv_data(tx, "1997-03-01").stats.filter("customer_id = 1").first().spending == 0.004


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 12])
def test_smoothing_keeps_a_line_at_any_length(spark, n):
    day = dt.date(2000, 1, 1)
    rows = [(day + dt.timedelta(days=10 * i), 10.0 + 3 * i) for i in range(n)]
    out = smooth_trend(spark.createDataFrame(rows, "date date, total_price double")).orderBy("date").collect()
    assert [r.value_smooth for r in out] == pytest.approx([v for _, v in rows], rel=1e-6)


def test_smoothing_with_gaps(spark):
    days = [0, 1, 2, 40, 41, 200]
    rows = [(dt.date(2000, 1, 1) + dt.timedelta(days=d), float(d)) for d in days]
    out = smooth_trend(spark.createDataFrame(rows, "date date, total_price double")).orderBy("date").collect()
    assert all(math.isfinite(r.value_smooth) for r in out)


def test_salts_depend_on_rows_alone(spark):
    counts = spark.createDataFrame([(1, 90), (2, 10**6), (3, 11)], "k long, _rows long")
    assert {tuple(r) for r in hot_keys(counts, "k", rows_per_task=10).collect()} == {(1, 9), (2, 10**5), (3, 2)}


def test_whole_numbers_without_point(spark):
    df = spark.createDataFrame([(-3.0,), (2.5,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(plain_number("x")).collect()] == ["-3", "2.5", "0", None]


def test_repeat_spend_keeps_one_time_buyers(spark):
    tx = tx_frame(spark, [(1, "1997-01-02", 10.0), (1, "1997-02-02", 30.0), (2, "1997-01-05", 5.0)])
    data = cd.clv_data(tx, "1997-03-01")
    model = cm.fixed_model(cm.GG_PARAMS, (6.0, 3.8, 15.0))
    model.extra["remove_first"] = True
    spend = {r.customer_id: r.predicted_mean_spending for r in cm.predict_spending(model, data).collect()}
    assert spend[2] == pytest.approx(6.0 * 15.0 / 2.8) and spend[1] == pytest.approx(6 * (15 + 30) / (6 + 2.8))
    pnbd = cm.fixed_model(cm.PNBD_PARAMS, (0.6, 70.0, 0.65, 84.0))
    scored = {r.customer_id: r.predicted_mean_spending for r in cm.predict_pnbd(pnbd, data, model).collect()}
    assert scored == pytest.approx(spend)
    no_mean = cm.fixed_model(cm.GG_PARAMS, (6.0, 0.9, 15.0))
    no_mean.extra["remove_first"] = True
    assert {r.customer_id: r.predicted_mean_spending is None for r in cm.predict_spending(no_mean, data).collect()}[2]


def test_convergence_needs_a_small_gradient():
    inside = maximize(lambda x: -((x - 0.5) ** 2).sum(axis=1), [3.0, -2.0])
    assert inside.converged and not inside.at_bound
    outside = maximize(lambda x: x.sum(axis=1), [0.0, 0.0], bound=2.0)
    assert outside.at_bound and not outside.converged
    rough = maximize(lambda x: np.where(np.abs(x - 1).max(axis=1) < 1e-12, 1.0, x.sum(axis=1) * 1e3), [1.0])
    assert not rough.converged


def test_fit_beats_its_neighbours(spark):
    from clvspark.plans import registry as reg
    data = reg.orders_clv(spark, SF_MID)
    fit = cm.fit_pnbd(data)
    at = np.log(fit.estimates)
    around = np.exp(np.vstack([at, *(at + d for d in 0.05 * np.vstack([np.eye(4), -np.eye(4)]))]))
    from clvspark.operators.clv import kernels
    values = cm.batched_loglik(data.stats, kernels.pnbd_loglik, ("x", "t_x", "T_cal"), around)
    assert values[0] >= values[1:].max() - 1e-3 * abs(values[0])
    assert fit.fit_statistics(spark).columns == [
        "loglik", "aic", "bic", "n", "converged", "at_bound", "hessian_definite", "iterations", "message"]


def _scans(df) -> int:
    """How often the plan that ran reads the orders."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("orders.parquet")


def test_transactions_are_read_twice_at_most(spark):
    from clvspark.plans import registry as reg
    tx = reg.orders_tx(spark, SF_MID)
    flow = prepare(tx, *reg.ORDERS_COHORT, assess=reg.ORDERS_ASSESS)
    assert _scans(flow.all_table) == 0                  # from written tables only
    assert _scans(flow.part(train=True, assessment=False)) <= 1
    assert _scans(cohort(tx, *reg.ORDERS_COHORT)) <= 1
    data = reg.orders_clv(spark, SF_MID)
    assert _scans(data.daily) == 0 and _scans(data.holdout) == 0


def test_scratch_tables_go_when_their_owner_is_done(spark):
    with scratch_tables(spark) as owned:
        assert materialize(spark.range(3)).count() == 3
    assert len(owned) == 1
    at = spark._jvm.org.apache.hadoop.fs.Path(owned[0])
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
