"""Exact rank quantiles per group, at any group size.

The q-quantile is the smallest value whose rank reaches ``ceil(q * n)``.
Equal values are counted first (partial aggregation). Approximate quantiles
then cut each group's values into ranges; range totals (a bounded number per
group) tell which range holds a rank, and only the values of that range are
put in order, so no task sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64


def rank_quantile_rows(df: DataFrame, by: str, value: str, quantiles: dict[str, float]) -> DataFrame:
    """(_g, _q, _v): one row per group and quantile name, exact for every group; NULL values do not count."""
    counts = (df.filter(F.col(value).isNotNull()).groupBy(F.col(by).alias("_g"), F.col(value).alias("_v"))
                .agg(F.count(F.lit(1)).alias("_c")))
    cuts = counts.groupBy("_g").agg(
        F.percentile_approx("_v", [i / RANGES for i in range(1, RANGES)], 1000).alias("_cuts"))
    placed = counts.join(cuts, "_g").select("_g", "_v", "_c", F.size(F.filter(
        F.array_distinct("_cuts"), lambda c: c < F.col("_v"))).alias("_r"))
    totals = placed.groupBy("_g", "_r").agg(F.sum("_c").alias("_t"))          # <= RANGES rows a group
    ranges = Window.partitionBy("_g").orderBy("_r")
    offsets = totals.select("_g", "_r", "_t", (F.sum("_t").over(ranges) - F.col("_t")).alias("_before"),
                            F.sum("_t").over(Window.partitionBy("_g")).alias("_n"))
    ranks = F.array(*[F.struct(F.lit(name).alias("q"), F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("_n")))
                               .cast("long").alias("rank")) for name, q in quantiles.items()])
    wanted = (offsets.select("_g", "_r", "_before", "_t", F.explode(ranks).alias("_w"))
                     .filter((F.col("_w.rank") > F.col("_before")) & (F.col("_w.rank") <= F.col("_before") + F.col("_t"))))
    inside = Window.partitionBy("_g", "_r").orderBy("_v")
    searched = placed.join(wanted.select("_g", "_r").distinct(), ["_g", "_r"]).withColumn("_upto", F.sum("_c").over(inside))
    return (searched.join(wanted, ["_g", "_r"]).filter(F.col("_upto") + F.col("_before") >= F.col("_w.rank"))
                    .groupBy("_g", F.col("_w.q").alias("_q")).agg(F.min("_v").alias("_v")))


def rank_quantiles(df: DataFrame, by: str, value: str, quantiles: dict[str, float]) -> DataFrame:
    """(``by``, one column per quantile name) of ``rank_quantile_rows``."""
    found = rank_quantile_rows(df, by, value, quantiles)
    return found.groupBy(F.col("_g").alias(by)).agg(
        *[F.max(F.when(F.col("_q") == name, F.col("_v"))).alias(name) for name in quantiles])
