"""Prediction source and sinks (S4, W1, W3, W4); model sink W2 is in
:mod:`clvspark.operators.models`.

The reference's hand-off from the pipeline to the dashboard is a file whose
writes are commented out (§1.4-18); here the pipeline writes parquet and
the dashboard reads it back with a fixed schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

PREDICTION_SCHEMA = StructType([
    StructField("pred_total", DoubleType()),
    StructField("pred_prob", DoubleType()),
    StructField("spend_90_total", DoubleType()),
    StructField("spend_90_flag", DoubleType()),
    StructField("customer_id", LongType()),
    StructField("recency", DoubleType()),
    StructField("frequency", LongType()),
    StructField("price_sum", DoubleType()),
    StructField("price_mean", DoubleType()),
])


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist scored customers as parquet."""
    df.write.mode(mode).parquet(path)


def read_predictions(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Load saved predictions (S4). The schema is fixed, not inferred; pass
    one when customer ids are text."""
    if schema is None:
        inferred = spark.read.parquet(path).schema
        key_type = inferred["customer_id"].dataType if "customer_id" in inferred.names else LongType()
        fields = [StructField(f.name, key_type if f.name == "customer_id" else f.dataType)
                  for f in PREDICTION_SCHEMA.fields]
        schema = StructType(fields)
    return spark.read.schema(schema).parquet(path)


def write_importance(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Persist variable importances."""
    df.write.mode(mode).parquet(path)


def export_actions_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The action table as CSV with a header (W4). Spark writes one file per
    partition; readers take the folder."""
    df.write.mode(mode).option("header", True).csv(path)


__all__ = ["PREDICTION_SCHEMA", "export_actions_csv", "read_predictions",
           "write_importance", "write_predictions"]
