"""Cohort operators: N1, G1, G6, G8, F2, F4, O2.

Membership is always a join (semi/anti), never a collected id list; the
cohort join salts very active customers. The first-purchase operator
is an aggregate plus an equi-join on ``(customer_id, date)`` instead of a
window over each customer: a customer holding a large share of all rows
would otherwise be buffered by one task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.functions.dates import expand_partial_date
from clvspark.operators.skew import hot_keys, salted_join
from clvspark.session import materialize


def date_range(df: DataFrame, date: str = "date") -> DataFrame:
    """Smallest and largest date (G1): one row ``min_date, max_date``."""
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def first_purchase_dates(tx: DataFrame, key: str = "customer_id",
                         date: str = "date") -> DataFrame:
    """One row per customer with the date of the first purchase.

    A plain grouped ``min``: map-side partial aggregation makes it
    insensitive to customers with very many rows.
    """
    return tx.groupBy(key).agg(F.min(date).alias("first_date"))


def first_purchases(tx: DataFrame, key: str = "customer_id", date: str = "date") -> DataFrame:
    """All rows on each customer's earliest date, ties kept (N1, §1.4-2)."""
    firsts = first_purchase_dates(tx, key, date).withColumnRenamed("first_date", date)
    return tx.join(firsts, [key, date], "left_semi")


def filter_by_time(df: DataFrame, date: str, start: str | _dt.date,
                   end: str | _dt.date) -> DataFrame:
    """Inclusive range with partial dates: ``"1997-03"`` ends on 03-31.

    The bounds become date literals, so the predicate reaches the scan.
    """
    lo = expand_partial_date(start, "start")
    hi = expand_partial_date(end, "end")
    return df.filter(F.col(date).between(F.lit(lo), F.lit(hi)))


def members(tx: DataFrame, ids: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows whose id is in ``ids`` (F2/J2). AQE broadcasts ``ids`` only if
    its measured size is under the broadcast threshold."""
    return tx.join(ids.select(key), key, "left_semi")


def non_members(tx: DataFrame, ids: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows whose id is not in ``ids`` (J3). Ids are non-NULL after F1."""
    return tx.join(ids.select(key), key, "left_anti")


def distinct_customers(tx: DataFrame, key: str = "customer_id") -> DataFrame:
    """Unique customer ids."""
    return tx.select(key).distinct()


def cohort_ids(tx: DataFrame, start: str | _dt.date, end: str | _dt.date,
               key: str = "customer_id", date: str = "date") -> DataFrame:
    """Customers whose first purchase falls in ``[start, end]`` (G8, first half)."""
    firsts = first_purchase_dates(tx, key, date)
    return filter_by_time(firsts, "first_date", start, end).select(key)


def cohort(tx: DataFrame, start: str | _dt.date, end: str | _dt.date,
           key: str = "customer_id", date: str = "date") -> DataFrame:
    """Full purchase history of the customers who entered in the window.

    One aggregate gives each customer's first purchase and row count; the
    membership join salts customers holding a large share of all rows
    (:mod:`clvspark.operators.skew`), so what follows stays balanced.
    """
    # one row per customer, written once: the ids and the hot keys both come from it,
    # so the transactions are read twice in all (here and by the join)
    per_customer = materialize(tx.groupBy(key).agg(F.min(date).alias("first_date"),
                                                   F.count(F.lit(1)).alias("_rows")))
    ids = filter_by_time(per_customer, "first_date", start, end).select(key)
    return salted_join(tx, ids, key, "left_semi", hot=hot_keys(per_customer, key))


def customer_histories(tx: DataFrame, n: int = 10, key: str = "customer_id") -> DataFrame:
    """Purchase rows of the first ``n`` customers by id (O2, §1.4-10).

    The ``n`` smallest ids are a distributed top-k (the limit is the feature).
    """
    ids = distinct_customers(tx, key).orderBy(key).limit(n)
    return members(tx, ids, key)
