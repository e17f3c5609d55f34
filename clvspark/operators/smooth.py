"""Smooth curves from sums: penalised splines (D2), kernel densities (D3), local regression by vertices.

Every curve is determined by a bounded number of sums over the rows, taken
in one aggregate; the driver solves a system whose size is a parameter, and
the curve comes back as a column expression or a table of grid points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.operators.quantiles import rank_quantile_rows, rank_quantiles
from clvspark.session import materialize


# --- penalised regression spline (D2) -----------------------------------------

def spline_basis(x: Column, low: float, high: float, segments: int) -> list[Column]:
    """The ``segments + 3`` cubic B-splines over ``segments`` equal parts of [low, high]."""
    t = (x - F.lit(low)) / F.lit((high - low) / segments)
    out = []
    for j in range(segments + 3):
        u = F.abs(t - F.lit(float(j - 1)))
        out.append(F.when(u < 1, F.lit(2.0 / 3.0) - u * u + u * u * u / 2).when(
            u < 2, (2 - u) * (2 - u) * (2 - u) / 6).otherwise(F.lit(0.0)))
    return out


@dataclass(frozen=True)
class PenalisedSpline:
    """A fitted curve; a constant one has no weights but ``level`` (NULL without rows)."""

    low: float
    high: float
    segments: int
    weights: tuple[float, ...]
    penalty: float
    degrees: float
    level: float | None = None

    def column(self, x: Column) -> Column:
        if not self.weights:
            return F.lit(self.level).cast("double")
        terms = [F.lit(w) * b for w, b in zip(self.weights, spline_basis(x, self.low, self.high, self.segments), strict=True)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        return total


def fit_spline(df: DataFrame, x: str, y: str, segments: int = 7, penalty: float | None = None,
               ridge: float = 1e-8) -> PenalisedSpline:
    """Least squares of ``y`` on cubic B-splines of ``x`` with a penalty on second differences of the weights.

    One aggregate gives X'X, X'y and y'y (``segments + 3`` columns). Without a
    ``penalty`` it is chosen from 61 powers of ten between 1e-3 and 1e6 by
    generalised cross-validation. Rows with a NULL x or y do not count.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).first()
    low, high, n = ends["low"], ends["high"], ends["n"]
    if n == 0 or low == high:
        return PenalisedSpline(low or 0.0, high or 0.0, segments, (), 0.0, min(n, 1), ends["mean"])
    size = segments + 3
    based = rows.select("y", *[b.alias(f"b{j}") for j, b in enumerate(spline_basis(F.col("x"), low, high, segments))])
    sums = based.agg(*[F.sum(F.col(f"b{i}") * F.col(f"b{j}")).alias(f"s{i}_{j}") for i in range(size) for j in range(i, min(size, i + 4))],
                     *[F.sum(F.col(f"b{i}") * F.col("y")).alias(f"t{i}") for i in range(size)],
                     F.sum(F.col("y") * F.col("y")).alias("yy")).first()
    xx = np.zeros((size, size))
    for i in range(size):
        for j in range(i, min(size, i + 4)):   # splines further apart do not overlap
            xx[i, j] = xx[j, i] = sums[f"s{i}_{j}"]
    xy = np.array([sums[f"t{i}"] for i in range(size)])
    rough = np.diff(np.eye(size), n=2, axis=0)
    rough = rough.T @ rough

    def solved(lam: float) -> tuple[np.ndarray, float, float]:
        system = xx + lam * rough + ridge * np.eye(size)
        w = np.linalg.solve(system, xy)
        degrees = float(np.trace(np.linalg.solve(system, xx)))
        left = max(float(sums["yy"] - 2 * w @ xy + w @ xx @ w), 0.0)
        return w, degrees, n * left / max(n - degrees, 1e-9) ** 2

    if penalty is None:
        penalty = min(10.0 ** np.arange(-3, 6.01, 0.15), key=lambda lam: solved(lam)[2])
    w, degrees, _ = solved(float(penalty))
    return PenalisedSpline(low, high, segments, tuple(map(float, w)), float(penalty), degrees)


def probability_smooth(pred: DataFrame, segments: int = 7, penalty: float | None = None) -> DataFrame:
    """Per purchase frequency the smoothed purchase probability (the curve of the probability chart, D2)."""
    curve = fit_spline(pred, "frequency", "pred_prob", segments, penalty)
    counted = pred.filter(F.col("frequency").isNotNull()).groupBy("frequency").agg(F.count(F.lit(1)).alias("customers"))
    return counted.withColumn("prob_smooth", curve.column(F.col("frequency").cast("double")))


# --- kernel density (D3) --------------------------------------------------------

def density(df: DataFrame, by: str, value: str, points: int = 128) -> DataFrame:
    """(``by``, at, density): a Gaussian kernel density of every group on ``points`` equal steps from its least to its
    largest value (the outline of a violin).

    The bandwidth is ``0.9 * min(sd, IQR / 1.34) * n^-0.2`` with exact rank
    quartiles (sd where the IQR is 0, 1 where both are). Values are shared
    between their two neighbouring grid points, so what is smoothed is a
    table of ``points`` masses per group, whatever the number of rows. Groups
    are assumed few. NULL values do not count; a group of equal values gets
    one point.
    """
    rows = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).dropna()
    shape = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
                                  F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("sd"))
    quartiles = rank_quantiles(rows, "g", "v", {"q1": 0.25, "q3": 0.75})
    robust = (F.col("q3") - F.col("q1")) / 1.34
    spread = F.when(robust > 0, F.least("sd", robust)).when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    shape = shape.join(quartiles, "g").select(
        "g", "n", "low", ((F.col("high") - F.col("low")) / (points - 1)).alias("step"),
        (0.9 * spread * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("width"))
    shape = materialize(shape)
    placed = rows.join(F.broadcast(shape), "g").select("g", F.when(F.col("step") > 0, (F.col("v") - F.col("low")) / F.col("step")).otherwise(
        F.lit(0.0)).alias("t")).withColumn("cell", F.least(F.floor("t"), F.lit(points - 2)).cast("int"))
    share = F.col("t") - F.col("cell")
    masses = placed.select("g", F.explode(F.array(
        F.struct(F.col("cell").alias("at"), (1 - share).alias("mass")), F.struct((F.col("cell") + 1).alias("at"), share.alias("mass")))).alias(
        "m")).groupBy("g", F.col("m.at").alias("i")).agg(F.sum("m.mass").alias("mass"))
    grid = shape.withColumn("j", F.explode(F.sequence(F.lit(0), F.when(F.col("step") > 0, F.lit(points - 1)).otherwise(F.lit(0)))))
    gap = (F.col("i") - F.col("j")) * F.col("step") / F.col("width")
    smoothed = grid.join(masses, "g").groupBy("g", "j", "low", "step", "n", "width").agg(
        F.sum(F.col("mass") * F.exp(-gap * gap / 2)).alias("total"))
    return smoothed.select(F.col("g").alias(by), (F.col("low") + F.col("j") * F.col("step")).alias("at"),
                           (F.col("total") / (F.col("n") * F.col("width") * math.sqrt(2 * math.pi))).alias("density"))


# --- local regression by vertices (N3) ------------------------------------------

def vertex_ranks(n: int, span: float, cell: float = 0.2) -> list[int]:
    """Ranks m (1-based) after which a cell of the points is cut in two: cells of more than ``span * cell * n`` points are."""
    most = max(1, math.floor(span * cell * n))
    cuts, cells = [], [(1, n)]
    while cells:
        low, high = cells.pop()
        if high - low + 1 > most and high > low:
            middle = (low + high) // 2
            cuts.append(middle)
            cells += [(low, middle), (middle + 1, high)]
    return sorted(cuts)


def smooth_by_vertices(series: DataFrame, date: str = "date", value: str = "total_price", span: float = 0.75,
                       out: str = "value_smooth", margin: float = 0.005, digits: int | None = None) -> DataFrame:
    """Local quadratic regression fitted at the vertices of a k-d partition and blended in between.

    The dates are cut at medians until no cell holds more than a fifth of the
    span's points; a vertex stands between the two points around each cut, and
    one a little outside either end. At a vertex the ``q = floor(span * n)``
    nearest points are fitted with tricube weights, which gives value and
    slope; between two vertices the curve is the cubic with their values and
    slopes. The number of vertices depends on the span alone, so all that is
    taken from the series are ranks and sums per vertex: no window runs over
    it. Dates must be distinct. Fewer than four points, or a vertex whose
    points cannot carry the quadratic, give a fit of lower degree there.
    """
    series = materialize(series)
    rows = series.select(F.datediff(F.col(date), F.lit("1970-01-01")).cast("double").alias("x"),
                         F.col(value).cast("double").alias("y")).dropna()
    ends = rows.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    n = ends["n"]
    if n < 2:
        return series.withColumn(out, F.col(value).cast("double"))
    ranks = sorted({r for m in vertex_ranks(n, span) for r in (m, m + 1)})
    names = {f"r{r}": (r - 0.5) / n for r in ranks}           # ceil of it times n is r
    at = {r["_q"]: r["_v"] for r in rank_quantile_rows(rows.withColumn("one", F.lit(1)), "one", "x", names).collect()} if names else {}
    wide = margin * (ends["high"] - ends["low"])
    vertices = sorted({ends["low"] - wide, ends["high"] + wide,
                       *((at[f"r{m}"] + at[f"r{m + 1}"]) / 2 for m in vertex_ranks(n, span))})
    q = min(n, max(math.floor(span * n), 3))
    number = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(v).alias("at")) for i, v in enumerate(vertices)])).alias("v")
    pairs = rows.select("x", "y", number).select("v.i", (F.col("x") - F.col("v.at")).alias("d"), "y")
    reach = {r["_g"]: r["_v"] for r in rank_quantile_rows(
        pairs.withColumn("far", F.abs("d")), "i", "far", {"h": (q - 0.5) / n}).collect()}
    u = F.col("d") / F.get(F.array(*[F.lit(float(reach[i] or 1.0)) for i in range(len(vertices))]), F.col("i"))
    weighed = pairs.select("i", "y", u.alias("u")).withColumn(
        "w", F.when(F.abs("u") < 1, F.pow(1 - F.pow(F.abs("u"), 3), 3)).otherwise(F.lit(0.0)))
    power = lambda k: F.pow("u", F.lit(float(k)))
    sums = {r["i"]: r for r in weighed.groupBy("i").agg(
        *[F.sum(F.col("w") * power(k)).alias(f"s{k}") for k in range(5)],
        *[F.sum(F.col("w") * power(k) * F.col("y")).alias(f"t{k}") for k in range(3)]).collect()}
    fits = [_local_fit(sums[i], float(reach[i] or 1.0)) for i in range(len(vertices))]
    return series.withColumn(out, _blended(F.datediff(F.col(date), F.lit("1970-01-01")).cast("double"), vertices, fits, digits))


def _local_fit(sums, reach: float) -> tuple[float, float]:
    """Value and slope at a vertex, of the highest degree (at most 2) that the points carry."""
    s, t = [sums[f"s{k}"] for k in range(5)], [sums[f"t{k}"] for k in range(3)]
    for degree in (2, 1, 0):
        system = np.array([[s[i + j] for j in range(degree + 1)] for i in range(degree + 1)])
        if degree == 0 or np.linalg.det(system) > 1e-9 * np.prod(np.diag(system)):
            found = np.linalg.solve(system, t[:degree + 1]) if system[0, 0] > 0 else np.zeros(1)
            return float(found[0]), float(found[1]) / reach if degree else 0.0
    return 0.0, 0.0


def _blended(x: Column, vertices: list[float], fits: list[tuple[float, float]], digits: int | None) -> Column:
    """The cubic of each cell in Hermite form."""
    curve = F.lit(None).cast("double")
    for k in range(len(vertices) - 1, 0, -1):
        low, width = vertices[k - 1], vertices[k] - vertices[k - 1]
        (a, da), (b, db) = fits[k - 1], fits[k]
        t = (x - F.lit(low)) / F.lit(width)
        piece = ((1 + 2 * t) * (1 - t) * (1 - t) * F.lit(a) + t * (1 - t) * (1 - t) * F.lit(da * width)
                 + t * t * (3 - 2 * t) * F.lit(b) + t * t * (t - 1) * F.lit(db * width))
        curve = F.when(x < F.lit(vertices[k]), piece).otherwise(curve)
    return F.round(curve, digits) if digits is not None else curve
