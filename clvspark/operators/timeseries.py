"""Calendar summaries (G2) and trend smoothing."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clvspark.functions.dates import period_start
from clvspark.functions.money import DEFAULT_SCALE, exact_sum
from clvspark.session import materialize


def summarize_by_time(df: DataFrame, date: str = "date", by: str = "month",
                      aggs: dict | None = None) -> DataFrame:
    """Floor ``date`` to the period start and aggregate; no gap filling.

    ``aggs`` maps output names to Column aggregates; the default is the
    reference's ``total_price = sum(price)`` (exact money sum).
    """
    if aggs is None:
        aggs = {"total_price": exact_sum("price", DEFAULT_SCALE)}
    return (df.groupBy(period_start(F.col(date), by).alias(date))
              .agg(*[c.alias(name) for name, c in aggs.items()]))


def _det3(a, b, c, d, e, f, g, h, i):
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def smooth_trend(series: DataFrame, date: str = "date", value: str = "total_price",
                 span: float = 0.75, degree: int = 2, out: str = "value_smooth",
                 digits: int | None = None) -> DataFrame:
    """Local polynomial regression (loess) next to the series.

    At each period the ``q = floor(span * n)`` nearest periods are fitted by
    weighted least squares of ``degree`` (0, 1 or 2) with tricube weights
    ``(1 - (d/h)^3)^3``, ``h`` being the q-th smallest distance; the fit at
    the period itself is the smoothed value (direct evaluation; the
    reference's library interpolates between fitted vertices, so digits may
    differ).

    The input is a calendar series (one row per period, e.g. after
    :func:`summarize_by_time`), bounded by the calendar and not by the data.
    The q nearest periods always lie within ``q - 1`` rows on either side, so
    each row sees a frame of at most ``2q - 1`` rows: no pairs beyond that.
    ``n`` is one count of that series. Where fewer points have weight than
    the degree needs, the fit there drops to the degree they support.
    """
    if degree not in (0, 1, 2) or not 0 < span <= 1:
        raise ValueError("degree must be 0, 1 or 2 and span within (0, 1]")
    series = materialize(series)   # small; counted and smoothed without running its flow twice
    n = series.count()
    if n == 0:
        return series.withColumn(out, F.lit(None).cast("double"))
    q = min(n, max(int(math.floor(span * n)), degree + 1))
    x0 = F.datediff(F.col(date), F.lit("1970-01-01")).cast("double")
    frame = Window.orderBy(date).rowsBetween(-(q - 1), q - 1)   # series-sized, see above
    pts = F.collect_list(F.struct(x0.alias("x"), F.col(value).cast("double").alias("y"))) \
           .over(frame)
    staged = series.withColumn("_x0", x0).withColumn("_pts", pts)
    h = F.element_at(F.array_sort(F.transform("_pts", lambda p: F.abs(p["x"] - F.col("_x0")))),
                     q)
    staged = staged.withColumn("_h", F.when(h > 0, h).otherwise(F.lit(1.0)))

    def moment(k: int, with_y: bool):
        def term(acc, p):
            u = (p["x"] - F.col("_x0")) / F.col("_h")
            d = F.abs(u)
            w = F.when(d < 1, F.pow(1 - F.pow(d, 3), 3)).otherwise(F.lit(0.0))
            t = w * F.pow(u, k) if k else w
            return acc + (t * p["y"] if with_y else t)
        return F.aggregate("_pts", F.lit(0.0), term)

    s = [moment(k, False) for k in range(5)]
    t = [moment(k, True) for k in range(3)]
    staged = staged.withColumns({**{f"_s{k}": c for k, c in enumerate(s)},
                                 **{f"_t{k}": c for k, c in enumerate(t)}})
    s, t = [F.col(f"_s{k}") for k in range(5)], [F.col(f"_t{k}") for k in range(3)]
    # the degree that the points with weight support: a determinant next to zero means fewer
    # points than coefficients, and the next lower degree is fitted
    small = F.lit(1e-9)
    det2 = s[0] * s[2] - s[1] * s[1]
    det3 = _det3(s[0], s[1], s[2], s[1], s[2], s[3], s[2], s[3], s[4])
    fit = F.when(s[0] > 0, F.try_divide(t[0], s[0])).otherwise(F.col(value).cast("double"))
    if degree >= 1:
        line = F.try_divide(s[2] * t[0] - s[1] * t[1], det2)
        fit = F.when(det2 > small * s[0] * s[2], line).otherwise(fit)
    if degree == 2:
        curve = F.try_divide(_det3(t[0], s[1], s[2], t[1], s[2], s[3], t[2], s[3], s[4]), det3)
        fit = F.when(det3 > small * s[0] * s[2] * s[4], curve).otherwise(fit)
    if digits is not None:
        fit = F.round(fit, digits)
    return staged.withColumn(out, fit).drop(
        "_x0", "_pts", "_h", *[f"_s{k}" for k in range(5)], *[f"_t{k}" for k in range(3)])
