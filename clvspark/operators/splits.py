"""Splits: customer hold-out (F3, J3), time split (T1), split plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.functions.dates import Period, parse_period
from clvspark.operators.skew import hot_keys, row_counts, salted_join
from clvspark.operators.sampling import exact_hash_sample


@dataclass(frozen=True)
class CustomerSplit:
    """Disjoint train/test purchase rows by customer, and the train ids."""

    train: DataFrame
    test: DataFrame
    train_ids: DataFrame


def split_customers(tx: DataFrame, fraction: float = 0.8, seed: int | str = 123,
                    key: str = "customer_id") -> CustomerSplit:
    """Exactly ``round(fraction * n)`` customers to train, the rest to test.

    R's generator cannot be reproduced; the draw is the seeded hash order of
    :mod:`clvspark.operators.sampling` (exact count, partition-independent).
    """
    train_ids = exact_hash_sample(tx, key, fraction, seed)
    # very active customers are salted in both membership joins
    hot = hot_keys(row_counts(tx, key), key)
    return CustomerSplit(train=salted_join(tx, train_ids, key, "left_semi", hot=hot),
                         test=salted_join(tx, train_ids, key, "left_anti", hot=hot),
                         train_ids=train_ids)


@dataclass(frozen=True)
class TimeSplit:
    """Training rows (up to the cutoff) and assessment rows (after it)."""

    training: DataFrame
    testing: DataFrame
    cutoff: Column       # scalar: last training date
    max_date: Column     # scalar: last date of the data
    data: DataFrame      # all rows, before the split
    date: str = "date"


def time_split(tx: DataFrame, assess: str | int | Period = "90 days",
               date: str = "date") -> TimeSplit:
    """The last ``assess`` of the data is the assessment window (T1, §1.4-5).

    Pinned boundary: assess is ``date > max(date) - assess``, training is the
    rest. ``max(date)`` is a scalar subquery, computed once per side.
    """
    period = assess if isinstance(assess, Period) else parse_period(assess)
    max_date = tx.agg(F.max(date)).scalar()
    cutoff = period.subtract_from(max_date)
    return TimeSplit(training=tx.filter(F.col(date) <= cutoff),
                     testing=tx.filter(F.col(date) > cutoff),
                     cutoff=cutoff, max_date=max_date, data=tx, date=date)


def cv_plan(split: TimeSplit) -> DataFrame:
    """Every row tagged with its slice and part."""
    cutoff = split.cutoff
    return split.data.select(
        F.lit("Slice1").alias("slice_id"),
        F.when(F.col(split.date) <= cutoff, F.lit("training"))
         .otherwise(F.lit("testing")).alias("split_key"),
        "*",
    )
