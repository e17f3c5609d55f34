"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_bytes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key long, text binary): only the two columns, so no other column can clash; null text is empty."""
    return df.select(F.col(key).cast("long").alias("key"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))


def positional(df: DataFrame) -> list[str]:
    """Names c0, c1, ... for the columns of ``df``, so that no column can clash with a helper's."""
    return [f"c{i}" for i in range(len(df.columns))]


def crc_mod(key: str, n: int):
    """crc32 of the key's decimal text modulo ``n``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n
