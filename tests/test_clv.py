"""V1-V9 (FIXTURES §3-4, SURVEY §5.4)."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SF_MID, tx_frame
from pyspark.sql import functions as F

from clvspark.operators.clv import data as cd
from clvspark.operators.clv import kernels
from clvspark.operators.clv import models as cm
from clvspark.plans import registry as reg


def test_same_day_merge_and_zero_repeater(spark):
    tx = tx_frame(spark, [(1, "1997-01-01", 5), (1, "1997-01-01", 7), (1, "1997-02-01", 3),
                          (2, "1997-01-10", 4), (3, "1998-02-01", 9)])
    data = cd.clv_data(tx, "1998-01-01")
    rows = {r.customer_id: r for r in data.stats.collect()}
    assert set(rows) == {1, 2}                        # 3 starts after the split
    assert rows[1].x == 1 and rows[1].t_x == 31.0 and rows[1].spending == 7.5
    assert rows[2].x == 0 and rows[2].t_x == 0.0
    assert rows[2].T_cal == float((np.datetime64("1998-01-01") - np.datetime64("1997-01-10"))
                                  .astype(int))


def test_week_unit(spark):
    tx = tx_frame(spark, [(1, "1997-01-01", 5), (1, "1997-01-15", 7)])
    row = cd.clv_data(tx, "1997-01-29", unit="week").stats.first()
    assert (row.t_x, row.T_cal) == (2.0, 4.0)


def _brute_loglik(r, a, s, b, x, t, T, steps=200_000):
    y = np.linspace(t, T, steps + 1)
    f = (a + y) ** -(r + x) * (b + y) ** -(s + 1)
    integral = float(np.sum((f[1:] + f[:-1]) / 2 * np.diff(y)))
    head = math.lgamma(r + x) - math.lgamma(r) + r * math.log(a) + s * math.log(b)
    return head + math.log((a + T) ** -(r + x) * (b + T) ** -s + s * integral)


@pytest.mark.parametrize("params", [(0.6, 10.0, 0.65, 12.0), (2.0, 0.5, 3.0, 40.0),
                                    (0.3, 80.0, 1.0, 2.0)])
def test_pnbd_loglik_against_quadrature(params):
    xs = np.array([0, 1, 4, 17, 40])
    ts = np.array([0.0, 3.5, 20.0, 33.0, 38.0])
    Ts = np.array([10.0, 30.0, 38.0, 39.0, 39.0])
    got = kernels.pnbd_loglik(np.array([params]), xs, ts, Ts)[0]
    want = [_brute_loglik(*params, x, t, T) for x, t, T in zip(xs, ts, Ts)]
    np.testing.assert_allclose(got, want, rtol=1e-7)


def _simulate_pnbd(n, r, a, s, b, rng):
    lam = rng.gamma(r, 1.0 / a, n)
    mu = rng.gamma(s, 1.0 / b, n)
    T = rng.uniform(30.0, 39.0, n)
    death = rng.exponential(1.0 / mu)
    end = np.minimum(death, T)
    x = np.zeros(n, dtype=np.int64)
    t = np.zeros(n)
    for i in range(n):
        k = rng.poisson(lam[i] * end[i])
        if k:
            x[i] = k
            t[i] = np.max(rng.uniform(0.0, end[i], k))
    return x, t, T


def _stats_data(spark, x, t, T, spending=None):
    spending = spending if spending is not None else np.ones_like(t)
    rows = [(i, int(xi), float(ti), float(Ti), float(si))
            for i, (xi, ti, Ti, si) in enumerate(zip(x, t, T, spending))]
    stats = spark.createDataFrame(rows, "customer_id long, x long, t_x double, T_cal double,"
                                        " spending double").repartition(4)
    return cd.ClvData(None, stats, None, None, None, "week", 7.0, 2)


def test_pnbd_recovers_parameters(spark):
    rng = np.random.default_rng(42)
    truth = (0.6, 10.0, 0.65, 12.0)
    x, t, T = _simulate_pnbd(4000, *truth, rng)
    data = _stats_data(spark, x, t, T)
    model = cm.fit_pnbd(data)
    ll_true = kernels.pnbd_loglik(np.array([truth]), x, t, T).sum()
    assert model.loglik >= ll_true - 1e-6
    est = model.coef()
    assert est["r"] == pytest.approx(0.6, rel=0.25)
    assert est["alpha"] == pytest.approx(10.0, rel=0.3)
    assert est["s"] == pytest.approx(0.65, rel=0.5)
    assert est["beta"] == pytest.approx(12.0, rel=0.8)
    assert model.converged
    assert all(se > 0 for se in model.std_errors)
    p_alive = kernels.pnbd_p_alive(np.array([truth]), x, t, T)[0]
    assert np.all((p_alive >= 0) & (p_alive <= 1))


def test_gamma_gamma_recovers_parameters(spark):
    rng = np.random.default_rng(7)
    p, q, g = 6.0, 3.8, 15.0
    n = 1 + rng.poisson(2.0, 3000)
    nu = rng.gamma(q, 1.0 / g, 3000)
    z = np.array([rng.gamma(p, 1.0 / v, k).mean() for v, k in zip(nu, n)])
    data = _stats_data(spark, n - 1, np.zeros(3000), np.ones(3000), z)
    model = cm.fit_gamma_gamma(data)
    est = model.coef()
    assert est["p"] == pytest.approx(p, rel=0.2)
    assert est["q"] == pytest.approx(q, rel=0.25)
    assert est["gamma"] == pytest.approx(g, rel=0.35)
    truth_ll = kernels.gg_loglik(np.array([[p, q, g]]), n, z).sum()
    assert model.loglik >= truth_ll - 1e-6
    pred = cm.predict_spending(model, data).agg(F.avg("predicted_mean_spending")).first()[0]
    assert pred == pytest.approx(float(np.mean(z)), rel=0.1)


def test_clv_flow_on_orders(spark):
    data = reg.orders_clv(spark, SF_MID)
    model = cm.fit_pnbd(data)
    pred = cm.predict_pnbd(model, data)
    agg = pred.agg(F.min("p_alive"), F.max("p_alive"), F.min("cet"), F.count(F.lit(1))).first()
    assert 0.0 <= agg[0] <= agg[1] <= 1.0 and agg[2] >= 0 and agg[3] == data.stats.count()
    actual = cm.tracking(model, data).filter("variable = 'Actual'").agg(F.sum("value")).first()[0]
    repeats = data.daily.count() - data.daily.select("customer_id").distinct().count()
    assert actual == repeats
    summary = {r.period: r for r in cd.clv_summary(data).collect()}
    assert summary["Total"].transactions == data.daily.count()
    assert summary["Estimation"].transactions + summary["Holdout"].transactions == \
        summary["Total"].transactions


def test_text_ids_flow_through_clv_scoring(spark, tmp_path):
    from clvspark.sources.transactions import read_transactions
    lines = [f" {i:05d} 1997{m:02d}{d:02d}  1   {10 + i % 50}.25"
             for i in range(1, 40) for m, d in ((1, 5), (3, 7 + i % 9), (11, 20))]
    path = tmp_path / "tx.txt"
    path.write_text("\n".join(lines) + "\n")
    tx = read_transactions(spark, str(path))
    data = cd.clv_data(tx, "1997-06-01")
    model = cm.fixed_model(cm.PNBD_PARAMS, reg.FIXED_PNBD)
    pred = cm.predict_pnbd(model, data, cm.fixed_model(cm.GG_PARAMS, reg.FIXED_GG))
    rows = pred.collect()
    assert dict(pred.dtypes)["customer_id"] == "string" and len(rows) == 39
    assert all(r.actual_x == 1 and 0 <= r.p_alive <= 1 for r in rows)


def test_gamma_gamma_input_without_first_purchase(spark):
    tx = tx_frame(spark, [(1, "1997-01-01", 5), (1, "1997-02-01", 7), (1, "1997-03-01", 9.5),
                          (2, "1997-01-10", 4), (3, "1997-01-05", 2), (3, "1997-01-09", 6)])
    data = cd.clv_data(tx, "1998-01-01")
    rows = {r.customer_id: (r.n, r.z) for r in cm._gg_input(data, True).collect()}
    assert rows == {1: (2.0, 8.25), 3: (1.0, 6.0)}        # one-time buyer 2 has no repeats
    kept = {r.customer_id: (r.n, r.z) for r in cm._gg_input(data, False).collect()}
    assert kept[1] == (3.0, 21.5 / 3) and kept[2] == (1.0, 4.0)
