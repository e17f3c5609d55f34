"""Pareto/NBD and Gamma/Gamma on Spark (V3-V9).

Fitting: the log-likelihood is a sum over customers. Each optimiser call
sends K parameter vectors to every partition of the (materialized, then
cached) customer statistics; ``mapInPandas`` evaluates them with numpy over Arrow batches and
returns one partial sum per vector and partition; Spark adds them up. Only
the K sums reach the driver, where the optimiser keeps its few numbers.

Scoring is column arithmetic: hypergeometric terms and quadrature as Spark
expressions for the Pareto/NBD model (``expressions``), closed forms for Gamma/Gamma.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from clvspark.operators.clv import expressions, kernels, scores
from clvspark.operators.clv.data import KEY, ClvData
from clvspark.operators.clv.optimize import (OptimResult, hessian_points, maximize, maximize_newton,
                                             unpacked)
from clvspark.session import materialize

# executors get the kernels by value; they need numpy and pandas only
cloudpickle.register_pickle_by_value(kernels)
cloudpickle.register_pickle_by_value(scores)

PNBD_PARAMS = ("r", "alpha", "s", "beta")
ROWS_PER_TASK = 20_000      # customers per task in the likelihood passes
GG_PARAMS = ("p", "q", "gamma")


def loglik_sums(df: DataFrame, kernel, columns: tuple[str, ...], params: np.ndarray,
                weight: str | None = None) -> DataFrame:
    """One pass: ``k, ll`` with the sum over all rows of ``kernel(params, *columns)``
    (times ``weight``) for each of the K parameter rows. Each task returns K
    partial sums; the K-row aggregate is all that leaves the executors."""
    params = np.ascontiguousarray(params, dtype=float)
    k = params.shape[0]

    def run(batches):
        total = np.zeros(k)
        for pdf in batches:
            if len(pdf):
                ll = kernel(params, *[pdf[c].to_numpy(dtype=float) for c in columns])
                if weight is not None:
                    ll = ll * pdf[weight].to_numpy(dtype=float)[None, :]
                total += ll.sum(axis=1)
        yield pd.DataFrame({"k": np.arange(k, dtype=np.int32), "ll": total})

    cols = (*columns, weight) if weight is not None else columns
    return (df.select(*cols).mapInPandas(run, "k int, ll double")
              .groupBy("k").agg(F.sum("ll").alias("ll")))


def batched_loglik(df: DataFrame, kernel, columns: tuple[str, ...], params: np.ndarray,
                   weight: str | None = None) -> np.ndarray:
    """The K sums of :func:`loglik_sums` as a numpy vector (K rows collected)."""
    out = np.full(np.shape(params)[0], np.nan)
    for row in loglik_sums(df, kernel, columns, params, weight).collect():
        out[row["k"]] = row["ll"]
    return out


SCORE_ROWS = 4000           # customers whose quadrature nodes are held at once


def score_sums(df: DataFrame, terms, columns: tuple[str, ...], params, weight: str | None = None) -> DataFrame:
    """One pass, one row: ``s0`` the log-likelihood at ``params``, then the sums of its first and second derivatives.

    Every task adds up its customers' terms (times ``weight``); Spark adds the tasks' rows.
    """
    params = [float(v) for v in params]
    size = 1 + len(params) + len(params) * (len(params) + 1) // 2
    names = [f"s{i}" for i in range(size)]

    def run(batches):
        total = np.zeros(size)
        for pdf in batches:
            for at in range(0, len(pdf), SCORE_ROWS):
                part = pdf.iloc[at:at + SCORE_ROWS]
                found = terms(params, *[part[c].to_numpy(dtype=float) for c in columns])
                total += found.sum(axis=0) if weight is None else part[weight].to_numpy(dtype=float) @ found
        yield pd.DataFrame([total], columns=names)

    parts = df.select(*columns, *([weight] if weight else [])).mapInPandas(run, ", ".join(f"{c} double" for c in names))
    return parts.agg(*[F.sum(c).alias(c) for c in names])


def _coef_table(spark: SparkSession, names, estimates, std_errors) -> DataFrame:
    schema = StructType([StructField("parameter", StringType(), False),
                         StructField("estimate", DoubleType(), False),
                         StructField("std_error", DoubleType(), True)])
    rows = [(n, float(e), None if s is None or not math.isfinite(s) else float(s))
            for n, e, s in zip(names, estimates, std_errors)]
    return spark.createDataFrame(rows, schema)


@dataclass(frozen=True)
class FittedModel:
    """Parameters and fit statistics of a maximum-likelihood fit (V4)."""

    names: tuple[str, ...]
    estimates: tuple[float, ...]
    std_errors: tuple[float, ...]
    loglik: float
    n: int
    converged: bool
    iterations: int
    evaluations: int
    message: str
    excluded: int = 0
    extra: dict = field(default_factory=dict)
    at_bound: bool = False
    hessian_definite: bool | None = None

    def coef(self) -> dict[str, float]:
        return dict(zip(self.names, self.estimates))

    @property
    def aic(self) -> float:
        return -2.0 * self.loglik + 2.0 * len(self.names)

    @property
    def bic(self) -> float:
        return -2.0 * self.loglik + len(self.names) * math.log(max(self.n, 1))

    def summary(self, spark: SparkSession | None = None) -> DataFrame:
        """Coefficients: parameter, estimate, std_error (a few rows)."""
        spark = spark or SparkSession.getActiveSession()
        return _coef_table(spark, self.names, self.estimates, self.std_errors)

    def fit_statistics(self, spark: SparkSession | None = None) -> DataFrame:
        spark = spark or SparkSession.getActiveSession()
        schema = StructType([StructField("loglik", DoubleType()), StructField("aic", DoubleType()),
                             StructField("bic", DoubleType()), StructField("n", LongType()),
                             StructField("converged", BooleanType()),
                             StructField("at_bound", BooleanType()),
                             StructField("hessian_definite", BooleanType()),
                             StructField("iterations", IntegerType()),
                             StructField("message", StringType())])
        return spark.createDataFrame(
            [(self.loglik, self.aic, self.bic, self.n, self.converged, self.at_bound,
              self.hessian_definite, self.iterations, self.message)], schema)


def _fit(df: DataFrame, kernel, columns, names, x0, n: int, excluded: int = 0,
         compress: bool = True, **opt) -> FittedModel:
    weight = None
    if compress:
        # customers with equal statistics have equal likelihood terms: one
        # weighted row per distinct tuple, written once for all passes
        df = materialize(df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("_w")))
        weight = "_w"
    # The passes are CPU-bound (K vectors x 64 nodes per row): spread the rows
    # by count, not by bytes, and keep this working copy cached for the loop
    # (a lost block is rebuilt from the materialized table).
    sc = df.sparkSession.sparkContext
    rows = df.count()
    parts = max(sc.defaultParallelism, math.ceil(rows / ROWS_PER_TASK))
    work = df.repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)

    def objective(log_params: np.ndarray) -> np.ndarray:
        return batched_loglik(work, kernel, columns, np.exp(log_params), weight)

    try:
        res: OptimResult = maximize(objective, np.log(np.asarray(x0, float)), **opt)
        # standard errors: finite-difference Hessian in log space, one pass
        pts, assemble = hessian_points(res.x, 1e-4)
        h_log = assemble(objective(pts))
    finally:
        work.unpersist()
    theta = np.exp(res.x)
    jac_inv = np.diag(1.0 / theta)
    try:
        cov = np.linalg.inv(-(jac_inv @ h_log @ jac_inv))
        se = tuple(float(math.sqrt(v)) if v > 0 else float("nan") for v in np.diag(cov))
    except np.linalg.LinAlgError:
        se = tuple(float("nan") for _ in names)
    definite = bool(np.isfinite(h_log).all() and (np.linalg.eigvalsh(-h_log) > 0).all())
    return FittedModel(tuple(names), tuple(float(v) for v in theta), se, float(res.value), n,
                       res.converged, res.iterations, res.evaluations, res.message, excluded,
                       at_bound=res.at_bound, hessian_definite=definite)


def _fit_newton(df: DataFrame, terms, columns, names, x0, n: int, excluded: int = 0, **opt) -> FittedModel:
    """Newton steps on the log scale within a trust region; standard errors from the observed information.

    Customers with equal statistics have equal terms, so the fit runs over the distinct ones with their counts, written
    once; a step is one pass that returns value, gradient and Hessian (10 or 15 numbers).
    """
    work = materialize(df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("_w")))
    parts = max(1, math.ceil(work.count() / ROWS_PER_TASK))
    work = work.repartition(max(parts, min(df.sparkSession.sparkContext.defaultParallelism, parts * 8))).persist(
        StorageLevel.MEMORY_AND_DISK)

    def at(log_params: np.ndarray):
        theta = np.exp(log_params)
        sums = np.array(score_sums(work, terms, columns, theta, "_w").first(), dtype=float)
        value, gradient, hessian = unpacked(np.nan_to_num(sums, nan=-np.inf) if np.isnan(sums[0]) else sums, len(theta))
        return value, gradient * theta, hessian * np.outer(theta, theta) + np.diag(gradient * theta), hessian

    last = {}

    def derivatives(log_params: np.ndarray):
        value, gradient, curvature, hessian = at(log_params)
        last[log_params.tobytes()] = hessian
        return value, gradient, curvature

    try:
        res = maximize_newton(derivatives, np.log(np.asarray(x0, float)), **opt)
    finally:
        work.unpersist()
    information = -last[res.x.tobytes()]
    definite = bool(np.isfinite(information).all() and (np.linalg.eigvalsh(information) > 0).all())
    se = tuple(float("nan") for _ in names)
    if np.isfinite(information).all() and np.linalg.matrix_rank(information) == len(names):
        se = tuple(float(math.sqrt(v)) if v > 0 else float("nan") for v in np.diag(np.linalg.inv(information)))
    return FittedModel(tuple(names), tuple(float(v) for v in np.exp(res.x)), se, float(res.value), n, res.converged,
                       res.iterations, res.evaluations, res.message, excluded, at_bound=res.at_bound,
                       hessian_definite=definite)


def information_table(model: FittedModel, df: DataFrame, kind: str = "pnbd") -> DataFrame:
    """(row_name, column_name, value) of the observed information, minus the second derivatives, at the model's
    parameters (V4): a distributed sum over the customers of ``df``."""
    terms, cols = (scores.pnbd_terms, ("x", "t_x", "T_cal")) if kind == "pnbd" else (scores.gg_terms, ("n", "z"))
    size = len(model.names)
    sums = score_sums(df, terms, cols, model.estimates)
    upper = list(zip(*np.triu_indices(size)))
    cells = [F.struct(F.lit(model.names[min(i, j)]).alias("row_name"), F.lit(model.names[max(i, j)]).alias("column_name"),
                      (-F.col(f"s{1 + size + k}")).alias("value")) for k, (i, j) in enumerate(upper)]
    return sums.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def gradient_table(model: FittedModel, df: DataFrame, kind: str = "pnbd") -> DataFrame:
    """One row: ``loglik`` and its derivative by each parameter, ``d_<name>``, at the model's parameters (V3, V7)."""
    terms, cols = (scores.pnbd_terms, ("x", "t_x", "T_cal")) if kind == "pnbd" else (scores.gg_terms, ("n", "z"))
    return score_sums(df, terms, cols, model.estimates).select(
        F.col("s0").alias("loglik"), *[F.col(f"s{i + 1}").alias(f"d_{name}") for i, name in enumerate(model.names)])


def fixed_model(names: tuple[str, ...], values) -> FittedModel:
    """A model with given parameters (no fit), for scoring with known values."""
    values = tuple(float(v) for v in values)
    return FittedModel(tuple(names), values, tuple(float("nan") for _ in values), float("nan"),
                       0, True, 0, 0, "fixed parameters")


def loglik_table(model: FittedModel, df: DataFrame, kind: str = "pnbd") -> DataFrame:
    """Total log-likelihood of ``df`` at the model's parameters, as a
    one-row DataFrame ``loglik, customers`` (a distributed sum)."""
    params = np.array([list(model.estimates)])
    if kind == "pnbd":
        kernel, cols = kernels.pnbd_loglik, ("x", "t_x", "T_cal")
    elif kind == "gg":
        kernel, cols = kernels.gg_loglik, ("n", "z")
    else:
        raise ValueError("kind must be 'pnbd' or 'gg'")

    def run(batches):
        for pdf in batches:
            if len(pdf):
                ll = kernel(params, *[pdf[c].to_numpy(dtype=float) for c in cols])[0]
                yield pd.DataFrame({"ll": [float(ll.sum())], "n": [len(pdf)]})

    parts = df.select(*cols).mapInPandas(run, "ll double, n long")
    return parts.agg(F.sum("ll").alias("loglik"), F.sum("n").alias("customers"))


def gg_input(data: ClvData, remove_first: bool = False) -> DataFrame:
    """Customers with positive mean spend: ``customer_id, n, z`` (V7 input)."""
    return _gg_input(data, remove_first).filter(F.col("z") > 0)


# --- Pareto/NBD --------------------------------------------------------------

def fit_pnbd(data: ClvData, start=(1.0, 1.0, 1.0, 1.0), compress: bool = False, method: str = "newton",
             **opt) -> FittedModel:
    """Maximum-likelihood Pareto/NBD over the customer statistics (V3, V4).

    Parameters are optimised on the log scale within ``|log| <= 12``; the
    result reports ``converged`` and the optimiser's message. ``newton`` uses
    analytic derivatives; ``differences`` only likelihoods, and ``compress``
    then evaluates each distinct ``(x, t_x, T_cal)`` once with its count (all
    zero repeaters with the same ``T_cal`` share one row).
    """
    n = data.stats.count()
    if method == "newton":
        return _fit_newton(data.stats, scores.pnbd_terms, ("x", "t_x", "T_cal"), PNBD_PARAMS, start, n, **opt)
    return _fit(data.stats, kernels.pnbd_loglik, ("x", "t_x", "T_cal"), PNBD_PARAMS, start, n,
                compress=compress, **opt)


def predict_pnbd(model: FittedModel, data: ClvData, spending: FittedModel | None = None,
                 annual_discount: float = 0.1, horizon: float | None = None) -> DataFrame:
    """Per customer: P(alive), expected transactions in the holdout (CET),
    discounted expected residual transactions (DERT), holdout actuals, and,
    with a Gamma/Gamma model, predicted mean spend and CLV = DERT x spend (V5).

    ``annual_discount`` is a continuous yearly rate, converted to the time
    unit. ``horizon`` defaults to the holdout length.
    """
    params = [model.coef()[p] for p in PNBD_PARAMS]
    delta = annual_discount * data.unit_days / 365.0
    h_col = data.holdout_length if horizon is None else F.lit(float(horizon))
    x, t, T, alive = (F.col(c) for c in ("x", "t_x", "T_cal", "p_alive"))
    # one row per length of observation: at most as many as the calendar has days
    lifetimes = data.stats.select("T_cal").distinct().withColumn("_life", expressions.discounted_lifetime(params, T, delta))
    scored = (data.stats.select(KEY, "x", "t_x", "T_cal", "spending", h_col.alias("_h"))
              .join(F.broadcast(lifetimes), "T_cal", "left")
              .withColumn("p_alive", expressions.p_alive(params, x, t, T))
              .withColumn("cet", expressions.expected_transactions(params, alive, x, T, F.col("_h")))
              .withColumn("dert", expressions.discounted_residual(params, alive, x, T, F.col("_life"))))
    out = (scored.join(data.holdout, KEY, "left")
               .select(KEY,
                       F.lit(data.estimation_end).alias("period_first"),
                       data.holdout_end.alias("period_last"),
                       h_col.alias("period_length"),
                       F.coalesce(F.col("holdout_x"), F.lit(0)).alias("actual_x"),
                       F.coalesce(F.col("holdout_spending"), F.lit(0.0))
                        .alias("actual_total_spending"),
                       "p_alive", "cet", "dert", "x", "spending"))
    if spending is not None:
        # the same n and z as the spending model was fitted on
        if spending.extra.get("remove_first", False):
            out = out.join(_gg_input(data, True, one_time=True), KEY, "left")
        else:
            out = out.withColumn("n", F.col("x") + 1).withColumn("z", F.col("spending"))
        mean = gg_mean_spend(spending, F.col("n"), F.col("z"))
        out = out.withColumn("predicted_mean_spending", mean) \
                 .withColumn("predicted_clv", F.col("dert") * mean).drop("n", "z")
    return out.drop("x", "spending")


def tracking(model: FittedModel, data: ClvData, actual_only: bool = False) -> DataFrame:
    """Repeat transactions per period of the data's unit: actual and expected (V6).

    ``period_until, variable ('Actual' | 'pnbd'), value``. Actual repeat
    transactions on a day are all (merged) transactions minus first
    purchases on that day: two calendar-sized aggregates, no per-customer
    join. Expected: each first-purchase date ``d`` with ``n_d`` customers
    contributes ``n_d (E[X(u - d)] - E[X(u - 1 - d)])`` to day ``u``; the
    pairs come from exploding each first date over the later calendar days,
    so their number is bounded by the calendar, not by the customers.
    """
    firsts = data.daily.groupBy(KEY).agg(F.min("date").alias("first_date"))
    per_first = firsts.groupBy("first_date").agg(F.count(F.lit(1)).alias("n_first"))
    per_day = data.daily.groupBy("date").agg(F.count(F.lit(1)).alias("n_all"))
    start = per_first.agg(F.min("first_date")).scalar()
    end = data.holdout_end
    calendar = (data.daily.sparkSession.range(1)
                .select(F.explode(F.sequence(start, end)).alias("period_until")))
    actual = (calendar.join(per_day, calendar.period_until == per_day.date, "left")
                      .join(per_first, calendar.period_until == per_first.first_date, "left")
                      .select("period_until", F.lit("Actual").alias("variable"),
                              (F.coalesce("n_all", F.lit(0)) - F.coalesce("n_first", F.lit(0)))
                              .cast("double").alias("value")))
    actual = actual.filter(F.col("period_until") > start)

    def per_period(by_day: DataFrame) -> DataFrame:
        """Days summed into periods of the chosen unit, counted from the first date."""
        length = int(data.unit_days)
        if length == 1:
            return by_day
        periods = F.ceil(F.datediff("period_until", start) / F.lit(float(length))).cast("int")
        return by_day.groupBy(F.date_add(start, periods * F.lit(length)).alias("period_until"), "variable").agg(
            F.sum("value").alias("value"))

    if actual_only:
        return per_period(actual)
    r, a, s, b = (model.coef()[p] for p in PNBD_PARAMS)
    days = data.unit_days

    def expected_x(t_days):
        t = t_days.cast("double") / F.lit(days)
        if abs(s - 1.0) < 1e-10:
            return F.lit(r * b / a) * F.log1p(t / F.lit(b))
        return F.lit(r * b / (a * (s - 1.0))) * (
            F.lit(1.0) - F.pow(F.lit(b) / (F.lit(b) + t), F.lit(s - 1.0)))

    pairs = per_first.select(
        "first_date", "n_first",
        F.explode(F.sequence(F.date_add("first_date", 1), end)).alias("period_until"))
    age = F.datediff("period_until", "first_date")
    expected = (pairs.groupBy("period_until")
                     .agg(F.sum(F.col("n_first") * (expected_x(age) - expected_x(age - 1)))
                          .alias("value"))
                     .select("period_until", F.lit("pnbd").alias("variable"), "value"))
    return per_period(actual.unionByName(expected))


def fit_both(data: ClvData, remove_first: bool = False) -> tuple[FittedModel, FittedModel]:
    """Pareto/NBD and Gamma/Gamma fits, submitted from two driver threads:
    they only read the statistics, so their passes can share the cluster."""
    with ThreadPoolExecutor(max_workers=2) as pool:
        pnbd = pool.submit(fit_pnbd, data)
        gg = pool.submit(fit_gamma_gamma, data, remove_first)
        return pnbd.result(), gg.result()


# --- Gamma/Gamma ---------------------------------------------------------------

def _gg_input(data: ClvData, remove_first: bool, one_time: bool = False) -> DataFrame:
    """``n`` transactions and their mean spend ``z`` per customer; with ``remove_first`` those
    of the repeat purchases, and one-time buyers (n = 0, no mean) only if ``one_time``."""
    if not remove_first:
        return data.stats.select(KEY, (F.col("x") + 1).cast("double").alias("n"),
                                 F.col("spending").alias("z"))
    # spend of the repeat transactions only: exact sums, one division
    split = F.lit(data.estimation_end)
    scale = data.money_scale
    money = (lambda c: c.cast(f"decimal(38,{scale})")) if scale is not None else (
        lambda c: c.cast("double"))
    est = data.daily.filter(F.col("date") <= split)
    firsts = est.groupBy(KEY).agg(F.min("date").alias("_d0"))
    per_customer = (est.join(firsts, KEY)
                       .groupBy(KEY)
                       .agg(F.count(F.lit(1)).alias("_n"),
                            F.sum(F.when(F.col("date") > F.col("_d0"), money(F.col("price"))))
                             .alias("_repeat")))
    repeats = (F.col("_n") - 1).cast("double")
    kept = per_customer if one_time else per_customer.filter(F.col("_n") > 1)
    return kept.select(KEY, repeats.alias("n"),
                               F.try_divide(F.col("_repeat").cast("double"), repeats).alias("z"))


def fit_gamma_gamma(data: ClvData, remove_first: bool = False, start=(1.0, 1.0, 1.0),
                    compress: bool = False, method: str = "newton", **opt) -> FittedModel:
    """Maximum-likelihood Gamma/Gamma spend model (V7); ``method`` as in :func:`fit_pnbd`.

    ``remove_first=False`` keeps the first transaction (n = x + 1), as the
    reference does. Customers with mean spend <= 0 are excluded and counted
    in ``excluded``. ``extra['finite_mean']`` is False when q <= 1.
    """
    gg = _gg_input(data, remove_first)
    counts = gg.agg(F.sum(F.when(F.col("z") > 0, 1).otherwise(0)).alias("ok"),
                    F.sum(F.when(F.col("z") <= 0, 1).otherwise(0)).alias("bad")).first()
    usable = gg.filter(F.col("z") > 0)
    ok, bad = int(counts["ok"] or 0), int(counts["bad"] or 0)
    if method == "newton":
        fitted = _fit_newton(usable, scores.gg_terms, ("n", "z"), GG_PARAMS, start, ok, excluded=bad, **opt)
    else:
        fitted = _fit(usable, kernels.gg_loglik, ("n", "z"), GG_PARAMS, start, ok, excluded=bad, compress=compress, **opt)
    fitted.extra["finite_mean"] = fitted.coef()["q"] > 1.0
    fitted.extra["remove_first"] = remove_first
    return fitted


def gg_mean_spend(model: FittedModel, n, z):
    """Expected mean spend ``p (g + n z) / (p n + q - 1)`` as a column; for ``n = 0`` the
    population mean ``p g / (q - 1)``, NULL if ``q <= 1``."""
    p, q, g = (model.coef()[k] for k in GG_PARAMS)
    n = F.coalesce(n.cast("double"), F.lit(0.0))
    mean = F.lit(p) * (F.lit(g) + n * F.coalesce(z, F.lit(0.0))) / F.nullif(
        F.lit(p) * n + F.lit(q - 1.0), F.lit(0.0))
    # without a purchase to go by: the population mean, which exists for q > 1 only
    return F.when((n > 0) | F.lit(q > 1.0), mean)


def predict_spending(model: FittedModel, data: ClvData) -> DataFrame:
    """Actual and predicted mean spend per customer (V8)."""
    gg = _gg_input(data, bool(model.extra.get("remove_first", False)), one_time=True)
    return gg.select(KEY, F.col("z").alias("actual_mean_spending"),
                     gg_mean_spend(model, F.col("n"), F.col("z")).alias("predicted_mean_spending"))


def spending_density(model: FittedModel, data: ClvData, bins: int = 50) -> DataFrame:
    """Binned actual mean spend and the model's density (V9).

    Bins are equal-width on ``[0, max z]``. The model density at a bin's
    centre is averaged over customers through their transaction counts:
    the grid is bins x distinct counts, both bounded.
    """
    gg = _gg_input(data, bool(model.extra.get("remove_first", False))).filter(F.col("z") > 0)
    total = gg.agg(F.count(F.lit(1))).scalar()
    width = gg.agg(F.max("z")).scalar() / F.lit(float(bins))
    binned = gg.withColumn("bin", F.least(F.floor(F.col("z") / width), F.lit(bins - 1))
                           .cast("int"))
    actual = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("customers"))
    per_n = gg.groupBy("n").agg(F.count(F.lit(1)).alias("c"))
    grid = per_n.select("n", "c", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")) \
                .withColumn("center", (F.col("bin") + F.lit(0.5)) * width)
    params = np.array([[model.coef()[k] for k in GG_PARAMS]])

    def run(batches):
        for pdf in batches:
            dens = kernels.gg_density(params, pdf["n"].to_numpy(float),
                                      pdf["center"].to_numpy(float))[0]
            yield pd.DataFrame({"bin": pdf["bin"].astype("int32"),
                                "w": pdf["c"].to_numpy(float) * dens})

    model_density = (grid.select("bin", "n", "c", "center").mapInPandas(run, "bin int, w double")
                         .groupBy("bin").agg(F.sum("w").alias("_w")))
    bins_df = (grid.select("bin").distinct()
                   .join(actual, "bin", "left").join(model_density, "bin", "left"))
    return bins_df.select(
        "bin",
        (F.col("bin") * width).alias("bin_start"),
        ((F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("customers", F.lit(0)).alias("customers"),
        (F.coalesce("customers", F.lit(0)).cast("double") / (total.cast("double") * width))
        .alias("actual_density"),
        (F.col("_w") / total.cast("double")).alias("model_density"))
