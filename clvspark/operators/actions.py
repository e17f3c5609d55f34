"""Ranked action lists over scored customers.

Every sort breaks ties by ``customer_id`` (§1.4-12). Filters come before
the sort in the plan, whatever the order they are written in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.functions.formatting import ACTION_TABLE_NAMES


def most_likely(pred: DataFrame, n: int | None = None) -> DataFrame:
    """Customers by purchase probability, most likely first (O1).

    With ``n`` it is a distributed top-k (partial top-k per partition).
    """
    ranked = pred.orderBy(F.col("pred_prob").desc(), F.col("customer_id"))
    return ranked.limit(n) if n is not None else ranked


def recent_but_unlikely(pred: DataFrame, days: int = 90, prob: float = 0.2) -> DataFrame:
    """Bought within ``days`` of the reference date but unlikely to buy again;
    least likely first (F5). Both bounds are strict."""
    return (pred.filter((F.col("recency") > -days) & (F.col("pred_prob") < prob))
                .orderBy(F.col("pred_prob"), F.col("customer_id")))


def missed_opportunities(pred: DataFrame) -> DataFrame:
    """No spend in the window, highest predicted spend first."""
    return (pred.filter(F.col("spend_90_total") == 0)
                .orderBy(F.col("pred_total").desc(), F.col("customer_id")))


def spend_more_table(pred: DataFrame, actual_below: float = 10.0,
                     pred_above: float = 10.0) -> DataFrame:
    """Customers who should be spending more, with display names.

    Expects ``spend_actual_vs_pred`` (see
    :func:`clvspark.operators.dashboard.dashboard_base`). Both bounds are
    strict. The whole table is used, not the dashboard sample (§1.4-15).
    """
    chosen = (pred.filter((F.col("spend_90_total") < actual_below)
                          & (F.col("pred_total") > pred_above))
                  .orderBy(F.col("pred_total").desc(), F.col("customer_id")))
    return chosen.select(*[F.col(src).alias(dst) for src, dst in ACTION_TABLE_NAMES.items()])
