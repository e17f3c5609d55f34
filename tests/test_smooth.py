"""Penalised splines (D2), kernel densities (D3), local regression by vertices."""

from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
from pyspark.sql import functions as F

from clvspark.operators import smooth as sm


def test_spline_against_dense_least_squares(spark):
    r = random.Random(4)
    rows = [(float(r.randint(0, 30)), r.gauss(0, 0.3)) for _ in range(300)]
    rows = [(x, math.sin(x / 5) + e) for x, e in rows]
    df = spark.createDataFrame([*rows, (None, 1.0), (3.0, None)], "x double, y double").repartition(4)
    x, y = np.array(rows).T
    low, high = x.min(), x.max()

    def basis(v, segments=6):
        t = (v - low) / ((high - low) / segments)
        u = np.abs(t[:, None] - (np.arange(segments + 3) - 1))
        return np.where(u < 1, 2 / 3 - u ** 2 + u ** 3 / 2, np.where(u < 2, (2 - u) ** 3 / 6, 0))

    b, d = basis(x), np.diff(np.eye(9), n=2, axis=0)
    want = basis(x) @ np.linalg.solve(b.T @ b + 3.0 * d.T @ d, b.T @ y)
    curve = sm.fit_spline(df, "x", "y", 6, 3.0)
    got = dict(df.dropna().select("x", curve.column(F.col("x"))).collect())
    assert np.allclose([got[v] for v in x], want, atol=1e-5)
    chosen = sm.fit_spline(df, "x", "y")
    fitted = df.dropna().select("x", chosen.column(F.col("x")).alias("f")).collect()
    assert 3 < chosen.degrees < 10 and max(abs(r.f - math.sin(r.x / 5)) for r in fitted) < 0.3


def test_spline_without_spread(spark):
    one = spark.createDataFrame([(2, 0.25), (2, 0.75)], "frequency long, pred_prob double")
    assert [tuple(r) for r in sm.probability_smooth(one).collect()] == [(2, 2, 0.5)]
    assert sm.probability_smooth(one.limit(0)).count() == 0


def test_density_is_a_density(spark):
    r = random.Random(1)
    rows = [("a", r.gauss(0, 2)) for _ in range(2000)] + [("b", 5.0)] * 7 + [("b", None), ("c", 1.0), ("c", 2.0)]
    got = sm.density(spark.createDataFrame(rows, "g string, v double").repartition(3), "g", "v", 200).collect()
    a = sorted((r["at"], r["density"]) for r in got if r["g"] == "a")
    step = a[1][0] - a[0][0]
    assert abs(sum(d for _, d in a) * step - 1) < 0.02
    centre = min(a, key=lambda p: abs(p[0]))
    assert abs(centre[1] - 1 / (2 * math.sqrt(2 * math.pi))) < 0.02
    assert [r["at"] for r in got if r["g"] == "b"] == [5.0] and sum(r["g"] == "c" for r in got) == 200


def _direct(x, y, v, q):
    h = np.sort(np.abs(x - v))[q - 1]
    u = (x - v) / h
    w = np.where(np.abs(u) < 1, (1 - np.abs(u) ** 3) ** 3, 0)
    design = np.stack([np.ones_like(u), u, u * u], axis=1)
    return np.linalg.solve(design.T @ (w[:, None] * design), design.T @ (w * y))[0]


def test_vertices_agree_with_direct_evaluation(spark):
    r = random.Random(7)
    days = sorted(r.sample(range(3000), 121))
    y = [100 + 0.02 * d + 20 * math.sin(d / 400) + r.gauss(0, 3) for d in days]
    start = dt.date(1970, 1, 1)
    df = spark.createDataFrame([(start + dt.timedelta(d), v) for d, v in zip(days, y, strict=True)], "date date, total_price double")
    got = {(r["date"] - start).days: r["value_smooth"] for r in sm.smooth_by_vertices(df.repartition(3), span=0.5, margin=0.0005).collect()}
    x, values = np.array(days, float), np.array(y)
    direct = {d: _direct(x, values, float(d), 60) for d in days}
    assert max(abs(got[d] - direct[d]) for d in days) < 1.5      # blended between vertices
    cuts = sm.vertex_ranks(len(days), 0.5)
    assert len(cuts) == 15 and all(abs(got[days[m - 1]] - direct[days[m - 1]]) < 0.7 for m in cuts)
    assert abs(got[days[0]] - direct[days[0]]) < 0.2 and abs(got[days[-1]] - direct[days[-1]]) < 0.2
    line = df.withColumn("total_price", F.datediff("date", F.lit("1970-01-01")) * 2.0)
    assert all(abs(r["value_smooth"] - r["total_price"]) < 1e-6 for r in sm.smooth_by_vertices(line).collect())
    short = sm.smooth_by_vertices(df.limit(1)).collect()
    assert short[0]["value_smooth"] == short[0]["total_price"] and sm.smooth_by_vertices(df.limit(0)).count() == 0
    assert len(sm.smooth_by_vertices(df.orderBy("date").limit(3)).collect()) == 3
    plan = sm.smooth_by_vertices(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
