"""Analytic derivatives against differences of the likelihood, and the trust region (V3, V4, V7)."""

from __future__ import annotations

import numpy as np

from clvspark.operators.clv import kernels, scores
from clvspark.operators.clv.optimize import maximize_newton, unpacked


def _differences(f, theta, eps=1e-5):
    theta = np.asarray(theta, float)
    rows = []
    for i in range(len(theta)):
        h = eps * theta[i]
        up, down = theta.copy(), theta.copy()
        up[i] += h
        down[i] -= h
        rows.append((f(up) - f(down)) / (2 * h))
    return np.array(rows)


def _check(terms, loglik, theta, columns):
    size = len(theta)
    found = terms(theta, *columns)
    assert np.allclose(found[:, 0], loglik(np.array([theta]), *columns)[0], rtol=1e-10)
    value, gradient, hessian = unpacked(found.sum(axis=0), size)
    assert np.allclose(gradient, _differences(lambda p: loglik(np.array([p]), *columns)[0].sum(), theta), rtol=1e-5, atol=1e-5)
    scored = _differences(lambda p: terms(p, *columns).sum(axis=0)[1:1 + size], theta)
    assert np.allclose(hessian, scored, rtol=1e-4, atol=1e-4 * np.abs(hessian).max())


def test_pareto_nbd_derivatives():
    x = np.array([0, 0, 1, 5, 40, 3, 0], float)
    t = np.array([0, 0, 10.5, 200, 300, 39, 0], float)
    big_t = np.array([300, 1, 250, 300, 300, 39, 0], float)     # died never seen: T = t
    for theta in ((0.6, 70.0, 0.65, 84.0), (1.3, 12.0, 2.1, 5.0), (0.05, 3.0, 0.4, 900.0)):
        _check(scores.pnbd_terms, kernels.pnbd_loglik, theta, (x, t, big_t))


def test_gamma_gamma_derivatives():
    n, z = np.array([1, 2, 9, 1, 30.0]), np.array([5.0, 30.0, 12.5, 400.0, 33.0])
    for theta in ((6.0, 3.8, 15.0), (0.3, 0.9, 100.0), (25.0, 11.0, 2.0)):
        _check(scores.gg_terms, kernels.gg_loglik, theta, (n, z))


def test_empty_batches():
    none = np.zeros(0)
    assert scores.pnbd_terms((1, 1, 1, 1), none, none, none).shape == (0, 15)
    assert scores.gg_terms((1, 1, 1), none, none).shape == (0, 10)


def test_trust_region():
    def bumpy(x):   # a narrow bent ridge with its top at (1, 1)
        a, b = x
        f = -(100 * (b - a * a) ** 2 + (1 - a) ** 2)
        g = np.array([400 * a * (b - a * a) + 2 * (1 - a), -200 * (b - a * a)])
        h = -np.array([[1200 * a * a - 400 * b + 2, -400 * a], [-400 * a, 200.0]])
        return f, g, h
    found = maximize_newton(bumpy, [-1.2, 1.0])
    assert found.converged and np.allclose(found.x, 1, atol=1e-6)
    away = maximize_newton(lambda x: (x.sum(), np.ones(2), np.zeros((2, 2))), [0.0, 0.0], bound=2.0)
    assert not away.converged and away.at_bound and np.allclose(away.x, 2)


def test_fits_converge_on_simulated_customers(spark):
    from clvspark.operators.clv import models as cm
    rng = np.random.default_rng(8)
    n, horizon = 3000, 52.0
    rate, death = rng.gamma(0.8, 1 / 8.0, n), rng.gamma(1.2, 1 / 20.0, n)
    life = np.minimum(rng.exponential(1 / death), horizon)
    x = rng.poisson(rate * life)
    t = np.where(x > 0, life * rng.random(n) ** (1 / np.maximum(x, 1)), 0.0)
    df = spark.createDataFrame([(float(a), float(b), horizon) for a, b in zip(x, t)], "x double, t_x double, T_cal double")
    fit = cm._fit_newton(df, scores.pnbd_terms, ("x", "t_x", "T_cal"), cm.PNBD_PARAMS, (1.0, 1.0, 1.0, 1.0), n)
    assert fit.converged and not fit.at_bound and fit.hessian_definite and fit.evaluations < 40
    assert 0.5 < fit.coef()["r"] < 1.2 and 4 < fit.coef()["alpha"] < 14 and all(0 < s < e * 5 for s, e in zip(fit.std_errors, fit.estimates))
