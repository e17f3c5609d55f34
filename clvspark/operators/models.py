"""Spend models on Spark ML.

The reference fits boosted trees with library defaults; the mapping to
Spark ML is ``maxIter=15, maxDepth=6, stepSize=0.3, minInstancesPerNode=1,
subsamplingRate=1.0``. Spark's GBT differs from the reference's engine
(no L2 leaf penalty, no Newton steps, normalised importances), so numbers
differ; shapes, ranges and column contracts are what is kept.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from clvspark.operators.features import FEATURES

GBT_DEFAULTS = {
    "maxIter": 15,
    "maxDepth": 6,
    "stepSize": 0.3,
    "minInstancesPerNode": 1,
    "subsamplingRate": 1.0,
    "seed": 123,
}

PREDICTION_LEAD = ("pred_total", "pred_prob", "spend_90_total", "spend_90_flag")


def feature_columns(df: DataFrame, label: str, remove: tuple[str, ...] = ()) -> list[str]:
    """Every column but the label and the removed roles."""
    drop = {label, *remove}
    return [c for c in df.columns if c not in drop]


def _assembler(features: list[str], out: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def fit_spend_total(train: DataFrame, features: list[str] | None = None,
                    label: str = "spend_90_total", **params) -> PipelineModel:
    """Boosted-tree regression of the 90-day spend (M1)."""
    features = features or feature_columns(train, label, ("spend_90_flag", "customer_id"))
    gbt = GBTRegressor(featuresCol="_x_total", labelCol=label, predictionCol="pred_total",
                       **{**GBT_DEFAULTS, **params})
    return Pipeline(stages=[_assembler(features, "_x_total"), gbt]).fit(train)


def fit_spend_prob(train: DataFrame, features: list[str] | None = None,
                   label: str = "spend_90_flag", **params) -> PipelineModel:
    """Boosted-tree probability of any purchase in the window (M2).

    Two classes are required; the check is one distinct count.
    """
    classes = train.agg(F.countDistinct(label).alias("k")).first()["k"]
    if classes < 2:
        raise ValueError(f"{label} has {classes} class(es) in the training data; "
                         "the purchase-probability model needs both 0 and 1")
    features = features or feature_columns(train, label, ("spend_90_total", "customer_id"))
    gbt = (GBTClassifier(featuresCol="_x_prob", labelCol=label, predictionCol="_class",
                         **{**GBT_DEFAULTS, **params})
           .setProbabilityCol("_proba").setRawPredictionCol("_raw"))
    return Pipeline(stages=[_assembler(features, "_x_prob"), gbt]).fit(train)


@dataclass(frozen=True)
class SpendModels:
    total: PipelineModel
    prob: PipelineModel


def fit_models(train: DataFrame, parallel: bool = True, **params) -> SpendModels:
    """Fit both models on one persisted copy of the training table.

    The fits are independent; with ``parallel`` they are submitted from two
    driver threads, so their per-level jobs share the cluster instead of
    running one after the other (the models are the same either way).
    """
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not parallel:
            return SpendModels(fit_spend_total(cached, **params), fit_spend_prob(cached, **params))
        with ThreadPoolExecutor(max_workers=2) as pool:
            total = pool.submit(fit_spend_total, cached, **params)
            prob = pool.submit(fit_spend_prob, cached, **params)
            return SpendModels(total.result(), prob.result())
    finally:
        cached.unpersist()


def score(models: SpendModels, df: DataFrame) -> DataFrame:
    """Both predictions next to the features, predictions first.

    The two transforms are chained on the same rows, so no positional
    column bind is needed (§1.4-11).
    """
    rest = [c for c in df.columns if c not in PREDICTION_LEAD]
    scored = models.prob.transform(models.total.transform(df))
    scored = scored.withColumn("pred_prob", vector_to_array(F.col("_proba")).getItem(1))
    lead = [c for c in PREDICTION_LEAD if c in scored.columns]
    return scored.select(*lead, *rest)


def importance(model: PipelineModel, spark: SparkSession | None = None) -> DataFrame:
    """Ranked feature importances of a fitted pipeline.

    The vector has one entry per feature (a handful), so building the
    DataFrame from it on the driver is bounded.
    """
    assembler, tree = model.stages[0], model.stages[-1]
    names = assembler.getInputCols()
    values = tree.featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    schema = StructType([StructField("feature", StringType(), False),
                         StructField("importance", DoubleType(), False)])
    rows = sorted(zip(names, (float(v) for v in values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, schema)


def save_models(models: SpendModels, path: str) -> None:
    """Persist both models."""
    models.total.write().overwrite().save(f"{path.rstrip('/')}/spend_total")
    models.prob.write().overwrite().save(f"{path.rstrip('/')}/spend_prob")


def load_models(path: str) -> SpendModels:
    return SpendModels(PipelineModel.load(f"{path.rstrip('/')}/spend_total"),
                       PipelineModel.load(f"{path.rstrip('/')}/spend_prob"))


__all__ = ["FEATURES", "GBT_DEFAULTS", "SpendModels", "feature_columns", "fit_models",
           "fit_spend_prob", "fit_spend_total", "importance", "load_models",
           "save_models", "score"]
