"""Tables behind the dashboard's charts.

The web page is not built; each chart's data is a DataFrame here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clvspark.functions.formatting import (currency, labelled, percent, plain_number,
                                           round_half_even, template)
from clvspark.operators.cohort import members
from clvspark.operators.quantiles import rank_quantiles
from clvspark.operators.sampling import exact_hash_sample

# Fixed value: the reference subtracts the prediction plus this constant (§1.4-13).
PRED_OFFSET = 0.0001
DASHBOARD_FEATURES = ("recency", "frequency", "price_sum")
DASHBOARD_IDS = ("customer_id", "pred_prob", "pred_total", "spend_90_total",
                 "spend_actual_vs_pred")


def spend_actual_vs_pred() -> F.Column:
    """Actual minus (predicted + 0.0001)."""
    return F.col("spend_90_total") - (F.col("pred_total") + F.lit(PRED_OFFSET))


# The tooltip's labels.
def _head_lines() -> list[F.Column]:
    return [
        labelled("Customer ID", F.col("customer_id")),
        labelled("90-Day Spend Prob", percent("pred_prob", 1)),
        labelled("90-Day Spend Pred", currency("pred_total")),
        labelled("Actual 90-Day Spend", currency("spend_90_total")),
        labelled("Actual vs Pred", currency("spend_actual_vs_pred")),
        F.lit("---"),
    ]


def dashboard_base(pred: DataFrame, with_text: bool = True) -> DataFrame:
    """Predictions plus ``spend_actual_vs_pred`` and a tooltip ``text``."""
    out = pred.withColumn("spend_actual_vs_pred", spend_actual_vs_pred())
    if not with_text:
        return out
    text = template(*_head_lines(),
                    labelled("Recency", plain_number("recency")),
                    labelled("Spend History (Total)", currency("price_sum")),
                    labelled("Avg Purchase", currency("price_mean")))
    return out.withColumn("text", text)


def sample_fraction(df: DataFrame, fraction: float = 0.05, seed: int = 123,
                    key: str = "customer_id") -> DataFrame:
    """Exactly ``round(fraction * n)`` rows, seeded (O3); ``key`` must be unique."""
    return members(df, exact_hash_sample(df, key, fraction, seed), key)


def features_long(sample: DataFrame, features=DASHBOARD_FEATURES,
                  ids=DASHBOARD_IDS) -> DataFrame:
    """Wide features to ``feature, value`` rows (U2); values as DOUBLE."""
    wide = sample.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot(list(ids), list(features), "feature", "value")


def scale_within(df: DataFrame, by: str = "feature", value: str = "value",
                 out: str = "value_scaled", digits: int | None = None,
                 few_groups: bool = False) -> DataFrame:
    """z-score within each group with the sample standard deviation.

    Group statistics are an aggregate joined back on the group key (a
    window would hold a whole group in one task). A constant group has
    sd 0 and gives NULL instead of a division error (§1.4-14). ``digits``
    rounds the result (the sums behind mean and sd depend on the order in
    which partitions combine, in the last bits). ``few_groups`` declares the
    number of groups small by construction: the statistics are then
    broadcast, since a shuffle join on a handful of keys would put each
    whole group into one task.
    """
    stats = df.groupBy(by).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    joined = df.join(F.broadcast(stats) if few_groups else stats, by)
    scaled = (F.col(value) - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))
    if digits is not None:
        scaled = F.round(scaled, digits)
    return joined.withColumn(out, scaled).drop("_mean", "_sd")


SCALED_DIGITS = 6


def scaled_features(sample: DataFrame, with_text: bool = False) -> DataFrame:
    """The long, scaled feature table of the feature chart (U2 + N2), z-scores
    to 6 decimals."""
    # three features: one statistics row each
    long = scale_within(features_long(sample), digits=SCALED_DIGITS, few_groups=True)
    if not with_text:
        return long
    line = F.concat(F.col("feature"), F.lit(": "),
                    plain_number(round_half_even("value", 2)))
    return long.withColumn("text", template(*_head_lines(), line))


def _quantile_names(quantiles, suffix: str = "") -> dict[str, float]:
    return {f"q{int(round(q * 100)):02d}{suffix}": q for q in quantiles}


def probability_by_frequency(pred: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Per purchase frequency: customers, mean and exact quartiles of the
    purchase probability (D2; the chart's smoothed curve, re-aimed)."""
    names = _quantile_names(quantiles, "_prob")
    agg = pred.groupBy("frequency").agg(F.count(F.lit(1)).alias("customers"),
                                        F.avg("pred_prob").alias("mean_prob"))
    exact = rank_quantiles(pred, "frequency", "pred_prob", names)
    return agg.join(exact, "frequency", "left").select("frequency", "customers", "mean_prob", *names)


def feature_distribution(scaled: DataFrame, bin_width: float = 0.5) -> DataFrame:
    """Histogram of the scaled value per feature (D3; the violin, re-aimed)."""
    start = F.floor(F.col("value_scaled") / F.lit(bin_width)) * F.lit(bin_width)
    return (scaled.filter(F.col("value_scaled").isNotNull())
                  .groupBy("feature", start.cast("double").alias("bin_start"))
                  .agg(F.count(F.lit(1)).alias("customers")))


def feature_quantiles(scaled: DataFrame, quantiles=(0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Exact quantiles of the scaled value per feature (D3)."""
    names = _quantile_names(quantiles)
    agg = scaled.groupBy("feature").agg(F.count("value_scaled").alias("customers"))
    exact = rank_quantiles(scaled, "feature", "value_scaled", names)
    return agg.join(exact, "feature", "left").select("feature", "customers", *names)
