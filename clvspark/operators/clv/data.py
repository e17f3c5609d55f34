"""CLV input: per-customer sufficient statistics (V1) and the summary (V2).

Purchases of one customer on one day are merged into one transaction
(summed spend). Customers whose first purchase falls after the end of the
estimation period are left out. With ``t`` in the time unit:

* ``x``: repeat transactions in the estimation period (transactions - 1)
* ``t_x``: last minus first estimation transaction
* ``T_cal``: end of estimation minus first transaction
* ``spending``: mean spend per (merged) estimation transaction

Everything is grouped aggregation: ``(customer, date)`` first, then
customer; partial aggregation keeps a customer with very many rows cheap.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.functions.dates import expand_partial_date
from clvspark.functions.money import DEFAULT_SCALE, exact_sum
from clvspark.session import materialize

UNIT_DAYS = {"day": 1.0, "week": 7.0}
KEY = "customer_id"


@dataclass(frozen=True)
class ClvData:
    daily: DataFrame          # customer_id, date, price (merged per day), customers of stats
    stats: DataFrame          # customer_id, x, t_x, T_cal, spending
    holdout: DataFrame        # customer_id, holdout_x, holdout_spending (customers of stats)
    estimation_end: _dt.date
    holdout_end: Column       # scalar DATE: last transaction date in the data
    unit: str
    unit_days: float
    money_scale: int | None

    @property
    def holdout_length(self) -> Column:
        """Scalar: length of the holdout period in time units."""
        return F.datediff(self.holdout_end, F.lit(self.estimation_end)).cast("double") / F.lit(
            self.unit_days)


def clv_data(tx: DataFrame, estimation_end: str | _dt.date, unit: str = "day",
             money_scale: int | None = DEFAULT_SCALE, materialized: bool = True,
             customers: DataFrame | None = None) -> ClvData:
    """Sufficient statistics of the estimation period, and holdout actuals (V1).

    ``customers`` (one column ``customer_id``, e.g. cohort ids) restricts the
    data after purchases are merged per customer and day, so the membership
    join sees at most one row per customer and day. ``materialized`` writes
    the per-day rows and the statistics as tables under the checkpoint
    folder: the fits read them once per optimiser step.
    """
    unit = unit.lower().rstrip("s")
    if unit not in UNIT_DAYS:
        raise ValueError(f"unit must be one of {tuple(UNIT_DAYS)}")
    days = UNIT_DAYS[unit]
    split = expand_partial_date(estimation_end, "start")
    daily = tx.groupBy(KEY, "date").agg(exact_sum("price", money_scale).alias("price"))
    if customers is not None:
        daily = daily.join(customers.select(KEY), KEY, "left_semi")
    if materialized:   # every table below comes from it: the transactions are not read again
        daily = materialize(daily)
    est = daily.filter(F.col("date") <= F.lit(split))
    stats = est.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
        exact_sum("price", money_scale).alias("_spend"),
    ).select(
        KEY,
        (F.col("_n") - 1).alias("x"),
        (F.datediff("_last", "_first").cast("double") / F.lit(days)).alias("t_x"),
        (F.datediff(F.lit(split), "_first").cast("double") / F.lit(days)).alias("T_cal"),
        (F.col("_spend") / F.col("_n").cast("double")).alias("spending"),
    )
    if materialized:
        stats = materialize(stats)
    known = stats.select(KEY)
    daily = daily.join(known, KEY, "left_semi")
    holdout = (daily.filter(F.col("date") > F.lit(split)).groupBy(KEY)
                    .agg(F.count(F.lit(1)).alias("holdout_x"),
                         exact_sum("price", money_scale).alias("holdout_spending")))
    holdout_end = daily.agg(F.max("date")).scalar()
    return ClvData(daily, stats, holdout, split, holdout_end, unit, days, money_scale)


SUMMARY_DIGITS = 6


def clv_summary(data: ClvData) -> DataFrame:
    """Descriptive statistics per period: Estimation, Holdout, Total (V2).

    Pinned definitions: customers with at least one transaction in the
    period; zero repeaters have exactly one; the inter-purchase time of a
    customer is (last - first) / (transactions - 1) in time units, averaged
    over customers with two or more. Standard deviations are sample ones,
    rounded to 6 decimals.
    """
    split = F.lit(data.estimation_end)
    period = F.when(F.col("date") <= split, F.lit("Estimation")).otherwise(F.lit("Holdout"))
    rows = data.daily.withColumn("period", F.explode(F.array(period, F.lit("Total"))))
    per_customer = rows.groupBy("period", KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"))
    ipt = F.when(F.col("n") > 1, F.datediff("last", "first").cast("double")
                 / F.lit(data.unit_days) / (F.col("n") - 1).cast("double"))
    by_customer = per_customer.groupBy("period").agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("first").alias("first_transaction"),
        F.max("last").alias("last_transaction"),
        F.sum("n").alias("transactions"),
        F.round(F.stddev_samp("n"), SUMMARY_DIGITS).alias("sd_transactions"),
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("zero_repeaters"),
        F.round(F.avg(ipt), SUMMARY_DIGITS).alias("mean_interpurchase"),
        F.round(F.stddev_samp(ipt), SUMMARY_DIGITS).alias("sd_interpurchase"))
    by_transaction = rows.groupBy("period").agg(
        exact_sum("price", data.money_scale).alias("total_spending"),
        F.round(F.stddev_samp("price"), SUMMARY_DIGITS).alias("sd_spending"))
    out = by_customer.join(by_transaction, "period")       # three rows each
    return out.select(
        "period", "customers", "first_transaction", "last_transaction", "transactions",
        (F.col("transactions").cast("double") / F.col("customers").cast("double"))
        .alias("mean_transactions"),
        "sd_transactions",
        (F.col("total_spending") / F.col("transactions").cast("double")).alias("mean_spending"),
        "sd_spending", "total_spending", "zero_repeaters",
        (F.lit(100.0) * F.col("zero_repeaters").cast("double") / F.col("customers").cast("double"))
        .alias("pct_zero_repeaters"),
        "mean_interpurchase", "sd_interpurchase")
