"""Joins of transaction rows to per-customer tables that stay balanced when
a few customers hold a large share of all rows.

A shuffle join on ``customer_id`` sends every row of one customer to one
task. AQE can split such a partition, but not when the next operator needs
the join's partitioning (an aggregate by customer right after the join),
which is exactly how these joins are used. So hot keys are salted:

* a key is *hot* when it holds more than ``rows_per_task`` rows, whatever its
  share of the table. The hot-key table grows with the data, so it is not
  forced into a broadcast: AQE decides by its measured size;
* a hot key with ``n`` rows gets ``ceil(n / rows_per_task)`` salts. Its
  transaction rows take a salt from a hash of the row (deterministic, so a
  recomputed task sees the same salt); its single per-customer row is
  repeated once per salt. Other keys have salt 0;
* the join runs on ``(key, salt)``: one scan of the transactions, and a
  hot customer's rows spread over many tasks.

The join output is partitioned by ``(key, salt)``, not by key, so an
aggregate by customer afterwards gets its own exchange with map-side
partial aggregation. The result is the same rows as a plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000


def row_counts(big: DataFrame, key: str) -> DataFrame:
    """Rows per key (partial aggregation before the shuffle)."""
    return big.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def hot_keys(counts: DataFrame, key: str, count_col: str = "_rows", share: float = 0.0,
             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys holding more than a task's worth of rows, with their number of salts.

    ``share`` > 0 asks for that share of all rows as well.
    """
    hot = counts.filter(F.col(count_col) > F.lit(rows_per_task))
    if share > 0:
        hot = hot.filter(F.col(count_col) > counts.agg(F.sum(count_col)).scalar() * F.lit(share))
    return hot.select(key, F.ceil(F.col(count_col) / F.lit(rows_per_task)).cast("int")
                      .alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                hot: DataFrame | None = None, share: float = 0.0,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys of ``big`` salted.

    ``small`` has at most one row per key; ``how`` is ``inner``,
    ``left_semi`` or ``left_anti``. ``hot`` (``key, _salts``, from
    :func:`hot_keys`) may be passed when the key counts are already known;
    otherwise they are one partial aggregation of ``big``.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError("how must be inner, left_semi or left_anti")
    if hot is None:
        hot = hot_keys(row_counts(big, key), key, share=share, rows_per_task=rows_per_task)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    big_salted = (big.join(hot, key, "left")
                     .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                                 .otherwise(F.pmod(row_hash, F.col("_salts")).cast("int")))
                     .drop("_salts"))
    small_salted = (small.join(hot, key, "left")
                         .withColumn("_salt", F.explode(F.when(
                             F.col("_salts").isNull(), F.array(F.lit(0)))
                             .otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))))
                         .drop("_salts"))
    return big_salted.join(small_salted, [key, "_salt"], how).drop("_salt")
