"""Evaluation metrics.

ROC AUC and the ROC curve need, for every distinct score, the number of
negatives (and positives) scoring strictly lower. A window ordered over all
rows would move everything into one task, so the prefix sums are built in
three distributed steps:

1. aggregate to one row per distinct score (a score shared by a third of
   all rows is then one row),
2. cut the distinct scores into ``buckets`` contiguous ranges at approximate
   quantiles (``Bucketizer`` on a bounded list of cut points; by default as
   many buckets as the session's shuffle partitions, at least 64) and total
   each bucket: a table of at most ``buckets`` rows, whose running totals
   are the offsets of the buckets,
3. prefix-sum inside each bucket with a window partitioned by bucket and
   add the bucket's offset (joined from the bounded offsets table).

Counts are integers, so the AUC numerator is exact whatever the order of
summation; ties count one half.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clvspark.session import materialize

DEFAULT_BUCKETS = 64
_EXACT = "decimal(38,0)"


def stable_sum(c) -> F.Column:
    """Sum of doubles through DECIMAL(38,12): the same for any partitioning."""
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(col.cast("decimal(38,12)")).cast("double")


def mae(df: DataFrame, truth: str = "spend_90_total", estimate: str = "pred_total") -> DataFrame:
    """Mean absolute error, one row ``mae``."""
    err = F.abs(F.col(truth) - F.col(estimate))
    return df.agg((stable_sum(err) / F.count(err).cast("double")).alias("mae"))


def _score_counts(df: DataFrame, label: str, score: str, event: float) -> DataFrame:
    """One row per distinct score, written once: the quantile cut points and
    the prefix sums both read it, so the scores are aggregated a single time."""
    is_event = (F.col(label) == F.lit(event)).cast("bigint")
    counts = (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
                .groupBy(F.col(score).cast("double").alias("score"))
                .agg(F.sum(is_event).alias("pos"), F.sum(1 - is_event).alias("neg")))
    return materialize(counts)


def _default_buckets(df: DataFrame) -> int:
    """As many score ranges as the session plans shuffle tasks (at least 64)."""
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        parts = DEFAULT_BUCKETS
    return max(DEFAULT_BUCKETS, parts)


def _below_counts(counts: DataFrame, buckets: int | None) -> DataFrame:
    """Add ``pos_below``/``neg_below``: totals over strictly smaller scores."""
    buckets = buckets or _default_buckets(counts)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = counts.approxQuantile("score", probs, 1.0 / (4 * buckets)) if buckets > 1 else []
    inner = sorted(set(cuts) - {float("-inf"), float("inf")}) or [0.0]   # Bucketizer needs 3+
    splits = [float("-inf")] + inner + [float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket",
                          handleInvalid="keep").transform(counts)
    bucket_totals = bucketed.groupBy("_bucket").agg(F.sum("pos").alias("_bp"),
                                                    F.sum("neg").alias("_bn"))
    # at most `buckets` rows: a single ordered window is cheap here
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucket_totals.select(
        "_bucket",
        F.coalesce(F.sum("_bp").over(before), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_on"))
    inside = Window.partitionBy("_bucket").orderBy("score").rowsBetween(
        Window.unboundedPreceding, -1)
    within = bucketed.select(
        "score", "pos", "neg", "_bucket",
        F.coalesce(F.sum("pos").over(inside), F.lit(0)).alias("_ip"),
        F.coalesce(F.sum("neg").over(inside), F.lit(0)).alias("_in"))
    return (within.join(F.broadcast(offsets), "_bucket")   # <= `buckets` rows
                  .select("score", "pos", "neg",
                          (F.col("_op") + F.col("_ip")).alias("pos_below"),
                          (F.col("_on") + F.col("_in")).alias("neg_below")))


def roc_auc(df: DataFrame, label: str = "spend_90_flag", score: str = "pred_prob",
            event: float = 1.0, buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties counted one half; one row ``roc_auc``.

    ``event`` is the label value of the event class (the second level).
    """
    below = _below_counts(_score_counts(df, label, score, event), buckets)
    num = F.sum((F.col("pos") * (2 * F.col("neg_below") + F.col("neg"))).cast(_EXACT))
    p = F.sum("pos").cast(_EXACT)
    n = F.sum("neg").cast(_EXACT)
    return below.agg((num.cast("double") / F.nullif((2 * p * n).cast("double"), F.lit(0.0)))
                     .alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "spend_90_flag", score: str = "pred_prob",
              event: float = 1.0, buckets: int | None = None) -> DataFrame:
    """Threshold, specificity, sensitivity per distinct score, plus the
    ``-inf`` (all predicted events) and ``+inf`` (none) end points (E3).

    A row with threshold ``t`` predicts an event for ``score >= t``.
    """
    counts = _score_counts(df, label, score, event)
    below = _below_counts(counts, buckets)
    totals = counts.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    p_all = totals.select("_P").scalar()
    n_all = totals.select("_N").scalar()
    points = below.select(
        F.col("score").alias("threshold"),
        (F.col("neg_below").cast("double") / F.nullif(n_all, F.lit(0)).cast("double"))
        .alias("specificity"),
        ((p_all - F.col("pos_below")).cast("double") / F.nullif(p_all, F.lit(0)).cast("double"))
        .alias("sensitivity"))
    spark = df.sparkSession
    ends = spark.range(2).select(
        F.when(F.col("id") == 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
         .alias("threshold"),
        F.col("id").cast("double").alias("specificity"),
        (1 - F.col("id")).cast("double").alias("sensitivity"))
    return ends.unionByName(points)
