"""Connected components of a link table, by alternating large and small stars.

Every step is a group-by and a join on the links; the links of each round
are written as a table in the shared scratch folder, which cuts the lineage.
Per round only the answer whether all is settled reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Connect each node's neighbours (larger, or not larger) to the smallest node next to it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = links  # here a > b always holds
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _flat(links: DataFrame) -> bool:
    """Whether every link leads straight to its component's smallest node."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    busy = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not busy.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).head(1)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link with the smallest node it reaches.

    Direction, repeated links and links of a node to itself do not matter;
    links with a null end are ignored.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = materialize(links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"), (x.isNull() | y.isNull()).alias("void"))
                      .filter(~F.col("void") & (F.col("a") != F.col("b"))).select("a", "b").distinct())
    while not _flat(now):
        now = materialize(_star(_star(now, large=True), large=False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
