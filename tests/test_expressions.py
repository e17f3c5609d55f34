"""Pareto/NBD scores as column expressions, against quadrature with many panels."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clvspark.operators.clv import expressions, kernels
from clvspark.plans import registry as reg

from conftest import SF_SMALL

CUSTOMERS = [(0, 0.0, 1.0), (0, 0.0, 300.0), (1, 10.0, 300.0), (3, 299.0, 300.0), (12, 150.5, 300.0),
             (40, 20.0, 30.0), (5000, 9000.0, 9500.0), (0, 0.0, 30000.0), (2, 1.0, 30000.0)]
PARAMETERS = [(0.6, 70.0, 0.65, 84.0), (0.55, 10.6, 0.61, 11.7), (2.0, 84.0, 1.0, 70.0), (1.0, 5.0, 1.0, 5.0),
              (0.3, 0.01, 0.2, 400.0), (0.3, 400.0, 0.2, 0.01), (0.5, 1e5, 3.0, 1e-4), (40.0, 1e-4, 30.0, 1e5),
              (0.05, 1e-5, 0.02, 1e5), (150.0, 3000.0, 90.0, 20000.0)]


def _fine(log_f, lo, hi, panels=400):
    """Logarithm of an integral by 20-point panels."""
    z, w = np.polynomial.legendre.leggauss(20)
    edges = np.linspace(lo, hi, panels + 1)
    half = (edges[1:] - edges[:-1]) / 2
    v = (half[:, None] * z + (edges[1:] + edges[:-1])[:, None] / 2).ravel()
    logs = log_f(v) + np.log((half[:, None] * w).ravel())
    return logs.max() + np.log(np.exp(logs - logs.max()).sum())


def _alive(params, x, t, T):
    r, a, s, b = params
    m = min(a, b)
    alive = -(r + x) * np.log(a + T) - s * np.log(b + T)
    gone = np.log(s) + _fine(lambda v: v - (r + x) * np.log(np.exp(v) - m + a) - (s + 1) * np.log(np.exp(v) - m + b),
                             np.log(t + m), np.log(T + m))
    return 1 / (1 + np.exp(min(gone - alive, 700.0)))


@pytest.mark.parametrize("params", PARAMETERS)
def test_p_alive(spark, params):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CUSTOMERS)], "i int, x long, t double, until double")
    got = {v.i: v.p for v in df.select("i", expressions.p_alive(params, F.col("x"), F.col("t"), F.col("until")).alias("p")).collect()}
    for i, c in enumerate(CUSTOMERS):
        assert got[i] == pytest.approx(_alive(params, *c), rel=1e-9, abs=1e-12), (params, c)


def test_fraction_and_quadrature_agree_at_the_border(spark):
    df = spark.createDataFrame([(0, 0.0, 50.0), (4, 20.0, 50.0)], "x long, t double, until double")
    for params in [(0.7, 1.0, 0.8, 1.0001e4 / 1.0), (0.7, 1.0, 0.8, 0.9998e4), (0.7, 1e4, 0.8, 1.0), (0.7, 0.9998e4, 0.8, 1.0)]:
        rows = df.select("*", expressions.p_alive(params, F.col("x"), F.col("t"), F.col("until")).alias("p")).collect()
        for v in rows:
            assert v.p == pytest.approx(_alive(params, v.x, v.t, v.until), rel=1e-9)


def test_residual_and_horizon(spark):
    params = (0.6, 70.0, 0.65, 84.0)
    df = spark.createDataFrame([(0, 0.0, 300.0), (7, 280.0, 300.0)], "x long, t double, until double")
    x, t, T, alive = F.col("x"), F.col("t"), F.col("until"), F.col("p")
    out = df.withColumn("p", expressions.p_alive(params, x, t, T)).select(
        "x", "t", "until", expressions.discounted_residual(params, alive, x, T, expressions.discounted_lifetime(params, T, 0.0003)).alias("dert"),
        expressions.expected_transactions(params, alive, x, T, F.lit(90.0)).alias("cet"),
        expressions.expected_transactions(params, alive, x, T, F.lit(0.0)).alias("none")).collect()
    for v in out:
        one = (np.array([params]), np.array([v.x]), np.array([v.t]), np.array([v.until]))
        assert v.dert == pytest.approx(kernels.pnbd_dert(*one, 0.0003)[0][0], rel=1e-11)
        assert v.cet == pytest.approx(kernels.pnbd_conditional_expectation(*one, 90.0)[0][0], rel=1e-11)
        assert v.none == 0.0


def test_edges(spark):
    params = (0.6, 70.0, 0.65, 84.0)
    df = spark.createDataFrame([(2, 30.0, 30.0), (None, 1.0, 2.0), (1, None, 2.0), (1, 1.0, None)], "x long, t double, until double")
    assert [v.p for v in df.select(expressions.p_alive(params, F.col("x"), F.col("t"), F.col("until")).alias("p")).collect()] == [
        1.0, None, None, None]
    assert df.limit(0).select(expressions.p_alive(params, F.col("x"), F.col("t"), F.col("until"))).count() == 0


def test_scores_run_without_python_workers(spark):
    plan = reg.q_pnbd_scores_fixed(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "MapInPandas" not in plan and "ArrowEvalPython" not in plan
