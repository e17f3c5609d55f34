"""Second-order trees: fit against a plain numpy version, missing values, scoring, SQL text, tables."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clvspark.operators import newton_trees as nt


def _rows(n=400, seed=3):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = round(r.uniform(0, 10), 2), r.randint(0, 6)
        y = (5.0 if a < 4 else 20.0) + 3 * b + r.gauss(0, 0.5)
        out.append((i, None if i % 11 == 0 else a, b, y, float(r.random() < (0.9 if a < 4 else 0.2))))
    return out


def _frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "id long, a double, b int, y double, flag double").repartition(parts)


def _plain(rows, label, objective, trees, depth, rate=0.3, l2=1.0):
    """Exact greedy Newton trees over all values; rows (x..., y) with None for missing. Returns predictions."""
    x = np.array([[np.nan if v is None else float(v) for v in (r[1], r[2])] for r in rows])
    y = np.array([r[label] for r in rows])
    margin = np.full(len(y), 0.0 if objective == "logistic" else 0.5)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y, p * (1 - p)) if objective == "logistic" else (margin - y, np.ones_like(y))

        def grow(at, level, g=g, h=h):
            total_g, total_h, best = g[at].sum(), h[at].sum(), None
            for f in range(2) if level < depth else ():
                known = ~np.isnan(x[:, f])
                for cut in np.unique(x[known, f]):
                    for missing_left in (True, False):
                        left = at & np.where(known, x[:, f] < cut, missing_left)
                        gl, hl = g[left].sum(), h[left].sum()
                        if hl >= 1 and total_h - hl >= 1:
                            gain = gl ** 2 / (hl + l2) + (total_g - gl) ** 2 / (total_h - hl + l2) - total_g ** 2 / (total_h + l2)
                            if best is None or gain > best[0] + 1e-9:
                                best = (gain, left)
            if best is None or best[0] <= 1e-6:
                margin[at] += -rate * total_g / (total_h + l2)
            else:
                grow(best[1], level + 1)
                grow(at & ~best[1], level + 1)

        grow(np.ones(len(y), bool), 0)
    return margin if objective == "squared" else 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("label,objective,at", [("y", "squared", 3), ("flag", "logistic", 4)])
def test_equals_exact_greedy_trees(spark, label, objective, at):
    rows = _rows()
    # one cut per distinct value: 400 rows, so 401 ranks
    model = nt.fit_newton_trees(_frame(spark, rows), label, ["a", "b"], objective, trees=3, depth=3, bins=401)
    got = dict(_frame(spark, rows).select("id", model.prediction()).collect())
    want = _plain(rows, at, objective, 3, 3)
    assert np.allclose([got[r[0]] for r in rows], want, atol=1e-6)


def test_beats_a_constant_and_does_not_depend_on_partitions(spark):
    rows = _rows()
    one, two = (nt.fit_newton_trees(_frame(spark, rows, parts), "y", ["a", "b"], depth=3, trees=8) for parts in (1, 7))
    assert nt.node_rows(one) == nt.node_rows(two)
    scored = _frame(spark, rows).select("y", one.prediction().alias("p")).collect()
    y = np.array([r.y for r in scored])
    assert np.abs(y - [r.p for r in scored]).mean() < 0.4 * np.abs(y - np.median(y)).mean()


def test_sql_text_and_tables_give_the_same_scores(spark, tmp_path):
    rows = _rows()
    model = nt.fit_newton_trees(_frame(spark, rows), "flag", ["a", "b"], "logistic", depth=3, trees=3, bins=16)
    nt.save_ensemble(model, str(tmp_path / "m"), spark)
    again = nt.load_ensemble(spark, str(tmp_path / "m"))
    assert nt.node_rows(again) == nt.node_rows(model) and (again.objective, again.base) == (model.objective, model.base)
    frame = _frame(spark, [*rows, (9999, float("nan"), None, 0.0, 0.0)])
    got = {r[0]: r[1:] for r in frame.select("id", model.prediction(), again.prediction(), F.expr(again.sql(
        lambda c: f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"))).collect()}
    con = duckdb.connect()
    table = frame.toArrow()
    con.register("t", table)
    plain = dict(con.sql("SELECT id, " + model.sql(lambda c: f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END")
                         + " FROM t").fetchall())
    assert all(abs(v - plain[i]) < 1e-12 for i, vs in got.items() for v in vs)
    assert all(0 < v < 1 for v in plain.values())


def test_hard_inputs(spark):
    rows = _rows(40)
    empty = nt.fit_newton_trees(_frame(spark, rows).limit(0), "y", ["a", "b"], trees=2)
    assert empty.trees == [] and _frame(spark, rows).select(empty.prediction().alias("p")).first().p == 0.5
    flat = nt.fit_newton_trees(_frame(spark, [(i, None, 1, 4.0, 1.0) for i in range(20)]), "y", ["a", "b"], trees=2, depth=2)
    assert [len(t) for t in flat.trees] == [1, 1]
    with pytest.raises(ValueError, match="objective"):
        nt.fit_newton_trees(_frame(spark, rows), "y", ["a"], objective="poisson")
    train = _frame(spark, rows).select(F.col("id").alias("customer_id"), F.lit(1.0).alias("spend_90_flag"), F.col("y").alias("spend_90_total"), "b")
    with pytest.raises(ValueError, match="class"):
        nt.fit_newton_models(train)


def test_gain_importance_sums_the_splits(spark):
    model = nt.fit_newton_trees(_frame(spark, _rows()), "y", ["a", "b"], depth=2, trees=2, bins=32)
    found = {r.feature: r for r in nt.gain_importance(nt.node_table(model, spark)).collect()}
    inner = [n for t in model.trees for n in t.values() if n.feature]
    assert sum(r.splits for r in found.values()) == len(inner)
    assert found["a"].gain == pytest.approx(sum(n.gain for n in inner if n.feature == "a"))
