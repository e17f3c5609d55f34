"""The reference's three workflows as single calls.

* :func:`spend_analysis` — cohort, splits, RFM tables, both boosted-tree
  models, test scores and metrics, importances, scores for everybody and the
  three action lists; optional sinks for predictions, models and importances.
* :func:`clv_analysis` — CLV statistics and summary, Pareto/NBD and
  Gamma/Gamma fits, per-customer predictions, tracking and spending tables.
* :func:`dashboard_tables` — the tables behind every dashboard chart, from
  saved or fresh predictions.

Everything returned is a lazy DataFrame except the few tables that several
outputs read, which are materialized once (see :func:`clvspark.session.materialize`).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from clvspark.operators import actions, dashboard, evaluate, models
from clvspark.operators.clv import data as clv_data_mod
from clvspark.operators.clv import models as clv_models
from clvspark.operators.cohort import cohort_ids
from clvspark.plans.lifetime_value import Prepared, prepare
from clvspark.session import materialize
from clvspark.sources import storage


@dataclass(frozen=True)
class SpendAnalysis:
    flow: Prepared
    models: models.SpendModels
    test_predictions: DataFrame
    all_predictions: DataFrame
    mae: DataFrame
    roc_auc: DataFrame
    roc_curve: DataFrame
    importance_prob: DataFrame
    importance_total: DataFrame
    most_likely: DataFrame
    recent_but_unlikely: DataFrame
    missed_opportunities: DataFrame


def spend_analysis(tx: DataFrame, cohort_start: str | _dt.date, cohort_end: str | _dt.date,
                   fraction: float = 0.8, seed: int = 123, assess: str = "90 days",
                   output: str | None = None) -> SpendAnalysis:
    """The supervised workflow end to end. With ``output``, writes
    ``predictions/`` (W1), ``models/`` (W2) and ``importance_*/`` (W3)."""
    flow = prepare(tx, cohort_start, cohort_end, fraction=fraction, seed=seed, assess=assess)
    fitted = models.fit_models(flow.train_table)
    test_pred = materialize(models.score(fitted, flow.test_table))
    all_pred = models.score(fitted, flow.all_table)
    imp_prob = models.importance(fitted.prob, tx.sparkSession)
    imp_total = models.importance(fitted.total, tx.sparkSession)
    if output is not None:
        base = output.rstrip("/")
        storage.write_predictions(all_pred, f"{base}/predictions")
        models.save_models(fitted, f"{base}/models")
        storage.write_importance(imp_prob, f"{base}/importance_prob")
        storage.write_importance(imp_total, f"{base}/importance_total")
    return SpendAnalysis(
        flow=flow, models=fitted, test_predictions=test_pred, all_predictions=all_pred,
        mae=evaluate.mae(test_pred), roc_auc=evaluate.roc_auc(test_pred),
        roc_curve=evaluate.roc_curve(test_pred),
        importance_prob=imp_prob, importance_total=imp_total,
        most_likely=actions.most_likely(test_pred),
        recent_but_unlikely=actions.recent_but_unlikely(test_pred),
        missed_opportunities=actions.missed_opportunities(test_pred))


@dataclass(frozen=True)
class ClvAnalysis:
    data: clv_data_mod.ClvData
    summary: DataFrame
    pnbd: clv_models.FittedModel
    gamma_gamma: clv_models.FittedModel
    predictions: DataFrame
    tracking: DataFrame
    spending: DataFrame
    spending_density: DataFrame


def clv_analysis(tx: DataFrame, cohort_start: str | _dt.date, cohort_end: str | _dt.date,
                 estimation_end: str | _dt.date, unit: str = "day",
                 remove_first: bool = False) -> ClvAnalysis:
    """The probabilistic workflow end to end on the entry cohort."""
    data = clv_data_mod.clv_data(tx, estimation_end, unit=unit,
                                 customers=cohort_ids(tx, cohort_start, cohort_end))
    pnbd, gg = clv_models.fit_both(data, remove_first=remove_first)
    return ClvAnalysis(
        data=data, summary=clv_data_mod.clv_summary(data), pnbd=pnbd, gamma_gamma=gg,
        predictions=clv_models.predict_pnbd(pnbd, data, gg),
        tracking=clv_models.tracking(pnbd, data),
        spending=clv_models.predict_spending(gg, data),
        spending_density=clv_models.spending_density(gg, data))


@dataclass(frozen=True)
class DashboardTables:
    base: DataFrame
    sample: DataFrame
    probability_by_frequency: DataFrame
    features: DataFrame
    feature_distribution: DataFrame
    feature_quantiles: DataFrame
    actions: DataFrame


def dashboard_tables(predictions: DataFrame, fraction: float = 0.05,
                     seed: int = 123) -> DashboardTables:
    """Every chart's table from scored customers (all of them, as saved by
    :func:`spend_analysis`). The sample feeds the charts; the action table
    uses every customer (§1.4-15)."""
    base = dashboard.dashboard_base(predictions)
    sample = materialize(dashboard.sample_fraction(base, fraction, seed))
    features = dashboard.scaled_features(sample, with_text=True)
    return DashboardTables(
        base=base, sample=sample,
        probability_by_frequency=dashboard.probability_by_frequency(sample),
        features=features,
        feature_distribution=dashboard.feature_distribution(features),
        feature_quantiles=dashboard.feature_quantiles(features),
        actions=actions.spend_more_table(base))
