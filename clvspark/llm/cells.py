"""Whole comparison of the members of a bucket in groups of bounded size.

A bucket is cut into blocks of about ``cell`` members by a hash of their
key; every pair of blocks (i <= j) is one group of rows, so a group holds
about two blocks, however large the bucket is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal(members: DataFrame, cell: int, *columns: str) -> DataFrame:
    """``members`` (bucket, size, key, ...) as (bucket, i, j, own, ``columns``), grouped and sorted for ``by_cell``."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("size") / cell)).cast("int")
    dealt = members.select("bucket", *columns, F.pmod(F.xxhash64("key"), blocks).cast("int").alias("own"),
                           F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    cells = dealt.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns)
    return cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "key")


def by_cell(batches, compare, build, block: int = 500):
    """``compare((bucket, i, j), rows)`` for each group's rows (own, ...); ``build`` makes a batch of what it lists.

    ``block`` rows at a time become Python objects.
    """
    held, now = [], None
    for batch in batches:
        out = []
        for at in range(0, batch.num_rows, block):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, block).columns), strict=True):
                if row[:3] != now:
                    out += compare(now, held) if held else []
                    held, now = [], row[:3]
                held.append(row[3:])
        yield build(out)
    yield build(compare(now, held) if held else [])
