"""Targets and RFM features.

All per-customer work groups by ``customer_id`` with map-side partial
aggregation, so a customer with very many rows costs one partial row per
input task. The inputs here come from the cohort and split operators, whose
membership joins salt very active customers, so they do not arrive in one
partition per customer. The features-targets join has one row per customer
on each side. :func:`clvspark.plans.lifetime_value.prepare` computes the
same tables in a single aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.functions.dates import days_between
from clvspark.functions.money import DEFAULT_SCALE, exact_mean, exact_sum
from clvspark.operators.splits import TimeSplit

FEATURES = ("recency", "frequency", "price_sum", "price_mean")
TARGETS = ("spend_90_total", "spend_90_flag")
MODEL_COLUMNS = ("customer_id",) + FEATURES + TARGETS


def max_date(df: DataFrame, date: str = "date") -> Column:
    """Scalar maximum date."""
    return df.agg(F.max(date)).scalar()


def targets(assess: DataFrame, key: str = "customer_id", price: str = "price",
            money_scale: int | None = DEFAULT_SCALE) -> DataFrame:
    """Spend in the assessment window and a constant flag 1."""
    return assess.groupBy(key).agg(
        exact_sum(price, money_scale).alias("spend_90_total"),
        F.lit(1).alias("spend_90_flag"),
    )


def rfm(tx: DataFrame, reference_date: Column, key: str = "customer_id",
        date: str = "date", price: str = "price",
        money_scale: int | None = DEFAULT_SCALE) -> DataFrame:
    """Recency (days from ``reference_date``, <= 0 for the training side),
    frequency, total and mean spend per customer (G3)."""
    return tx.groupBy(key).agg(
        days_between(F.max(date), reference_date).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        exact_sum(price, money_scale).alias("price_sum"),
        exact_mean(price, money_scale).alias("price_mean"),
    )


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULL per column."""
    return df.na.fill(values)


def modelling_table(split: TimeSplit, reference_date: Column | None = None,
                    key: str = "customer_id", money_scale: int | None = DEFAULT_SCALE
                    ) -> DataFrame:
    """Features from the training part, targets from the assessment part.

    Features are the left side (J1, §1.4-6): customers seen only in the
    assessment window are dropped; customers without assessment purchases
    get total 0 and flag 0. ``reference_date`` defaults to the side's own
    last training date; the test table passes the *train* side's (§1.4-4).
    """
    ref = reference_date if reference_date is not None else max_date(split.training, split.date)
    feats = rfm(split.training, ref, key, split.date, money_scale=money_scale)
    tgts = targets(split.testing, key, money_scale=money_scale)
    joined = feats.join(tgts, key, "left")
    filled = fill_missing(joined, {"spend_90_total": 0.0, "spend_90_flag": 0})
    return filled.select(
        key, *FEATURES, "spend_90_total",
        F.col("spend_90_flag").cast("double").alias("spend_90_flag"),  # F11
    )


def all_customers(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test modelling rows together."""
    return train.unionByName(test)
