"""Exact-size seeded selection without a global sort.

Rows are ordered by ``md5("<seed>:<key>")`` (ties by key) and the first
``k = round_half_even(fraction * n)`` are taken. The result depends neither
on partitioning nor on executor count.

A plain ``orderBy(hash).limit(k)`` is exact too but, for large ``k``,
funnels ``k`` rows through one task. Instead:

1. bucket every key by the first four hex digits of its hash (65,536
   buckets; md5 spreads distinct keys evenly),
2. count keys per bucket (a bounded table of at most 65,536 rows) and find
   the bucket in which the k-th key falls,
3. keep every key of the lower buckets by a plain filter and order only
   the keys of that one bucket (about ``n / 65,536`` of them).

The bucket table (n, k and how many keys each bucket gives) is joined back
on the bucket id as a broadcast of at most 65,536 rows; nothing passes
through the driver and the key set is computed once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX_DIGITS = 4


def hash_order_key(key: Column, seed: int | str) -> Column:
    """The sort key of the selection: lowercase hex md5 of ``"<seed>:<key>"``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_split_flags(keys: DataFrame, key: str, fraction: float, seed: int | str = 123,
                     count: Column | None = None, flag: str = "selected") -> DataFrame:
    """Every distinct key of ``keys`` with a boolean ``flag``: selected or not.

    ``count`` overrides the number to select (a scalar column); by default
    it is ``round_half_even(fraction * n)``. One plan: the key set is
    computed once (its shuffle is shared by the bucket counts and the join).
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    hashed = (keys.select(key).distinct()
              .withColumn("_h", hash_order_key(F.col(key), seed))
              .withColumn("_b", F.conv(F.substring("_h", 1, BUCKET_HEX_DIGITS), 16, 10)
                          .cast("int")))
    per_bucket = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # Bounded (<= 16**4 rows): a single ordered window is cheap here.
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = (per_bucket
              .withColumn("_upto", F.sum("_n").over(upto))
              .withColumn("_total", F.sum("_n").over(Window.partitionBy(F.lit(1)))))
    if count is None:
        # exact decimal product, rounded half to even
        frac = F.lit(Decimal(repr(float(fraction)))).cast("decimal(20,18)")
        k = F.bround(F.col("_total").cast("decimal(20,0)") * frac, 0).cast("bigint")
    else:
        k = count.cast("bigint")
    # per bucket: how many of its keys are taken (all, none, or the first `_take`)
    buckets = totals.select("_b", F.greatest(F.lit(0), F.least(
        F.col("_n"), k - (F.col("_upto") - F.col("_n")))).alias("_take"), "_n")
    tagged = hashed.join(F.broadcast(buckets), "_b")        # <= 16**4 rows
    whole = tagged.filter((F.col("_take") == 0) | (F.col("_take") == F.col("_n"))).select(
        key, (F.col("_take") > 0).alias(flag))
    # only the one bucket holding the k-th key is ordered inside
    edge = (tagged.filter((F.col("_take") > 0) & (F.col("_take") < F.col("_n")))
            .withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
            .select(key, (F.col("_r") <= F.col("_take")).alias(flag)))
    return whole.unionByName(edge)


def exact_hash_sample(keys: DataFrame, key: str, fraction: float, seed: int | str = 123,
                      count: Column | None = None) -> DataFrame:
    """The selected subset of the *distinct* keys in ``keys`` (one column ``key``)."""
    flags = hash_split_flags(keys, key, fraction, seed, count, "_selected")
    return flags.filter(F.col("_selected")).select(key)
