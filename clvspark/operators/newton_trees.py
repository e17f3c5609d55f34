"""Second-order boosted trees on Spark (M1, M2), their scoring, importance and tables.

Each tree takes Newton steps: with g and h the first and second derivative
of the loss at the present margin, a leaf's weight is ``-G / (H + l2)`` and a
split gains ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)`` (G, H sums over a
node). Both children need ``H >= min_child_weight``; a split is kept if it
gains more than ``gamma``. The library defaults of the reference's booster
are the defaults here (15 trees, depth 6, rate 0.3, l2 1, base 0.5).

Distribution: features are cut at exact rank quantiles once and the rows
written as (label, bin numbers, margin). A level is one aggregate, the sums
of g and h per (node, feature, bin), at most ``2^level * features * (bins +
1)`` rows, from which the driver picks the splits. A tree's margins are one
more narrow pass, written as a table, so lineage stays short. g and h are
rounded to fixed-point numbers before they are summed: integer sums do not
depend on the order of partitions, so a fit is the same for any of them.

Missing values (NULL, NaN) have a bin of their own and go to the side on
which they gain more. Nodes are numbered 0, and 2i + 1, 2i + 2 below i.
"""

from __future__ import annotations

import math
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, StringType, StructField,
                               StructType)

from clvspark.operators.features import FEATURES
from clvspark.operators.models import PREDICTION_LEAD, feature_columns
from clvspark.operators.quantiles import rank_quantile_rows
from clvspark.session import materialize

#: The node table (W2): inner nodes have a split, leaves a weight.
NODE_SCHEMA = StructType([
    StructField("tree", IntegerType(), False), StructField("node", IntegerType(), False),
    StructField("feature", StringType()), StructField("threshold", DoubleType()),
    StructField("missing_left", BooleanType()), StructField("gain", DoubleType()),
    StructField("cover", DoubleType()), StructField("weight", DoubleType())])

OBJECTIVES = ("squared", "logistic")


@dataclass(frozen=True)
class Node:
    """Rows with ``feature < threshold`` go left; a leaf has no feature but a weight."""

    feature: str | None = None
    threshold: float | None = None
    missing_left: bool = True
    gain: float | None = None
    cover: float | None = None
    weight: float | None = None


@dataclass
class TreeEnsemble:
    """margin = base + the sum of the leaves a row falls into; ``trees`` map node numbers to nodes."""

    objective: str
    base: float
    trees: list[dict[int, Node]] = field(default_factory=list)

    def margin(self, of=None) -> Column:
        """The margin as one expression over feature columns; ``of(feature)`` gives a feature's column.

        The nodes are arrays that a row walks through, not nested conditions: those of whole ensembles outgrow
        what the JVM compiles into one method.
        """
        of = of or known_value
        names = sorted({n.feature for tree in self.trees for n in tree.values() if n.feature})
        number = {name: i for i, name in enumerate(names)}
        walk, roots = Walk(), []
        for tree in self.trees:
            roots.append(walk.add({i: (number[n.feature], n.threshold, n.missing_left) for i, n in tree.items() if n.feature}))
        weights = F.array(*[F.lit(float(tree[i].weight or 0.0)) for tree, at in zip(self.trees, roots) for i in at])
        values = F.array(*[of(name) for name in names]) if names else F.array().cast("array<double>")
        base = F.lit(float(self.base))
        if not roots:
            return base
        return F.aggregate(F.array(*[F.lit(at[0]) for at in roots]), base,
                           lambda total, root: total + F.get(weights, walk.leaf(values, root)))

    def prediction(self, of=None) -> Column:
        """The margin, or for the logistic objective the probability of 1."""
        margin = self.margin(of)
        return 1 / (1 + F.exp(-margin)) if self.objective == "logistic" else margin

    def sql(self, of=str) -> str:
        """``prediction`` as SQL text over DOUBLE columns without NaN."""
        def number(x: float) -> str:
            return f"CAST('{float(x)!r}' AS DOUBLE)"

        def walk(tree: dict[int, Node], i: int) -> str:
            node = tree[i]
            if node.feature is None:
                return number(node.weight)
            test = f"coalesce({of(node.feature)} < {number(node.threshold)}, {str(node.missing_left).lower()})"
            return f"CASE WHEN {test} THEN {walk(tree, 2 * i + 1)} ELSE {walk(tree, 2 * i + 2)} END"

        margin = " + ".join([number(self.base), *(walk(tree, 0) for tree in self.trees)])
        return f"1 / (1 + exp(-({margin})))" if self.objective == "logistic" else margin


def known_value(name: str) -> Column:
    """A feature as DOUBLE, NaN as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


class Walk:
    """Trees flattened to arrays: per place the tested value's number (-1 in a leaf), threshold, side of missing
    values and the places of both children."""

    def __init__(self) -> None:
        self.tests: list[tuple[int, float, bool, int, int]] = []
        self.depth = 0

    def add(self, splits: dict[int, tuple[int, float, bool]]) -> dict[int, int]:
        """Adds a tree of splits by node number; returns the place of each of its nodes, the root's first."""
        nodes = sorted({0} | {child for i in splits for child in (2 * i + 1, 2 * i + 2)})
        at = {i: len(self.tests) + k for k, i in enumerate(nodes)}
        for i in nodes:
            test = splits.get(i)
            self.tests.append((*test, at[2 * i + 1], at[2 * i + 2]) if test else (-1, 0.0, True, at[i], at[i]))
        self.depth = max(self.depth, (max(nodes) + 1).bit_length() - 1)
        return at

    def leaf(self, values: Column, root: Column) -> Column:
        """The place where a row with these values (an array, NULL where missing) ends."""
        value, threshold, missing_left, left, right = (F.array(*[F.lit(x) for x in column]) for column in zip(*self.tests))

        def step(i: Column, _) -> Column:
            is_left = F.coalesce(F.get(values, F.get(value, i)) < F.get(threshold, i), F.get(missing_left, i))
            return F.when(is_left, F.get(left, i)).otherwise(F.get(right, i))

        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), root, step) if self.depth else root


def quantile_cuts(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Per feature the distinct values at ranks ``ceil(k / bins * n)``, k = 1 .. bins - 1 (at most ``bins - 1`` numbers)."""
    long = df.select(*[known_value(f).alias(f) for f in features]).unpivot([], features, "feature", "value")
    found = rank_quantile_rows(long, "feature", "value", {f"q{k}": k / bins for k in range(1, bins)}).select("_g", "_v").distinct()
    cuts: dict[str, list[float]] = {f: [] for f in features}
    for r in found.collect():
        cuts[r["_g"]].append(r["_v"])
    return {f: sorted(values) for f, values in cuts.items()}


def _bin(name: str, cuts: list[float]) -> Column:
    """The number of cuts at or below the value; NULL for a missing one."""
    value = known_value(name)
    bounds = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    return F.when(value.isNotNull(), F.size(F.filter(bounds, lambda c: c <= value)))


def _best_split(g: np.ndarray, h: np.ndarray, cuts: np.ndarray, l2: float, min_child_weight: float):
    """(gain, feature, cut, missing left, GL, HL, GR, HR) of a node; g, h are (features, 1 + bins), the
    missing bin first, and ``cuts`` the number of cuts of each feature."""
    total_g, total_h = g[0].sum(), h[0].sum()
    below_g, below_h = np.cumsum(g[:, 1:], axis=1)[:, :-1], np.cumsum(h[:, 1:], axis=1)[:, :-1]
    best = None
    for missing_left in (True, False):
        gl = below_g + (g[:, :1] if missing_left else 0)
        hl = below_h + (h[:, :1] if missing_left else 0)
        gr, hr = total_g - gl, total_h - hl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - total_g ** 2 / (total_h + l2)
        allowed = (hl >= min_child_weight) & (hr >= min_child_weight) & (np.arange(gain.shape[1]) < cuts[:, None])
        gain = np.where(allowed, gain, -np.inf)
        if gain.size:
            at = np.unravel_index(int(np.argmax(gain)), gain.shape)  # the first of equals: lowest feature, lowest cut
            if best is None or gain[at] > best[0]:
                best = (float(gain[at]), *map(int, at), missing_left, float(gl[at]), float(hl[at]), float(gr[at]), float(hr[at]))
    return best


def fit_newton_trees(train: DataFrame, label: str, features: list[str] | None = None, objective: str = "squared",
                     trees: int = 15, depth: int = 6, rate: float = 0.3, l2: float = 1.0, gamma: float = 1e-6,
                     min_child_weight: float = 1.0, bins: int = 256, base_score: float = 0.5) -> TreeEnsemble:
    """Boost ``trees`` trees on ``label``; ``base_score`` is a prediction (a probability for ``logistic``)."""
    if objective not in OBJECTIVES:
        raise ValueError(f"objective must be one of {OBJECTIVES}")
    features = features or list(FEATURES)
    base = math.log(base_score / (1 - base_score)) if objective == "logistic" else float(base_score)
    cuts = quantile_cuts(train, features, bins)
    rows = materialize(train.filter(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), F.array(*[_bin(f, cuts[f]) for f in features]).alias("bins"),
        F.lit(base).alias("margin")))
    n = rows.count()
    ensemble = TreeEnsemble(objective, base)
    if n == 0:
        return ensemble
    margin, y = F.col("margin"), F.col("y")
    p = 1 / (1 + F.exp(-margin))
    g = p - y if objective == "logistic" else margin - y
    h = F.greatest(p * (1 - p), F.lit(1e-16)) if objective == "logistic" else F.lit(1.0)
    limits = np.array([len(cuts[f]) for f in features])
    width = int(limits.max()) + 2

    def fixed_point(bound: float) -> float:
        """A power of two with ``n * bound`` of it below 2^62."""
        return 2.0 ** min(40, math.floor(62 - math.log2(n * max(bound, 1e-300))))

    # no leaf weighs more than rate * max|g|, so a tree lets |g| grow by that factor at most
    bound = 1.0 if objective == "logistic" else float(rows.agg(F.max(F.abs(g))).first()[0])
    scale_h = fixed_point(1.0)
    for _ in range(trees):
        scale_g = fixed_point(bound)
        bound *= 1.0 if objective == "logistic" else 1 + rate
        parts = rows.select("bins", F.round(g * scale_g).cast("long").alias("g"), F.round(h * scale_h).cast("long").alias("h"))
        tree: dict[int, Node] = {}
        open_nodes, splits = [0], {}

        def placed(of_node: dict[int, float] | None = None) -> Column:
            """The node a row stands in, or what ``of_node`` has for it."""
            walk = Walk()
            at = walk.add(splits)
            of_place = F.array(*[F.lit(i if of_node is None else of_node[i]) for i in at])
            return F.get(of_place, walk.leaf(F.col("bins"), F.lit(0)))

        for _ in range(depth):
            sums = parts.withColumn("node", placed()).filter(F.col("node").isin(open_nodes)).select(
                "node", F.posexplode("bins").alias("feature", "bin"), "g", "h").groupBy("node", "feature", "bin").agg(
                F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            table = defaultdict(lambda: np.zeros((2, len(features), width)))
            for r in sums:
                at_bin = 0 if r["bin"] is None else r["bin"] + 1
                table[r["node"]][:, r["feature"], at_bin] = r["g"] / scale_g, r["h"] / scale_h
            following = []
            for i in open_nodes:
                total_g, total_h = map(float, table[i][:, 0].sum(axis=1))
                found = _best_split(*table[i], limits, l2, min_child_weight)
                if i == 0:
                    tree[0] = Node(cover=total_h, weight=-rate * total_g / (total_h + l2))
                if found is None or not found[0] > gamma:
                    continue
                gain, at, cut, missing_left, gl, hl, gr, hr = found
                name = features[at]
                tree[i] = Node(name, cuts[name][cut], missing_left, gain, total_h)
                splits[i] = (at, float(cut + 1), missing_left)   # bin numbers below it go left
                for child, cg, ch in ((2 * i + 1, gl, hl), (2 * i + 2, gr, hr)):
                    tree[child] = Node(cover=ch, weight=-rate * cg / (ch + l2))
                    following.append(child)
            open_nodes = following
            if not open_nodes:
                break
        ensemble.trees.append(tree)
        step = placed({i: float(node.weight or 0.0) for i, node in tree.items()})
        rows = materialize(rows.withColumn("margin", F.col("margin") + step))
    return ensemble


@dataclass(frozen=True)
class NewtonModels:
    total: TreeEnsemble
    prob: TreeEnsemble


def fit_newton_models(train: DataFrame, **params) -> NewtonModels:
    """Both spend models (M1, M2) on the modelling table; the features leave out the ids and the other target."""
    classes = train.agg(F.countDistinct("spend_90_flag").alias("k")).first()["k"]
    if classes < 2:
        raise ValueError(f"spend_90_flag has {classes} class(es) in the training data; "
                         "the purchase-probability model needs both 0 and 1")
    removed = {"spend_90_total": ("spend_90_flag", "customer_id"), "spend_90_flag": ("spend_90_total", "customer_id")}
    with ThreadPoolExecutor(max_workers=2) as pool:   # the fits are independent: their small jobs share the cluster
        fits = [pool.submit(fit_newton_trees, train, label, feature_columns(train, label, removed[label]), objective, **params)
                for label, objective in (("spend_90_total", "squared"), ("spend_90_flag", "logistic"))]
        return NewtonModels(*(fit.result() for fit in fits))


def score_newton(models: NewtonModels, df: DataFrame) -> DataFrame:
    """Both predictions before the targets and the other columns (P1-P4, F8): one narrow pass, no Python."""
    scored = df.withColumns({"pred_total": models.total.prediction(), "pred_prob": models.prob.prediction()})
    lead = [c for c in PREDICTION_LEAD if c in scored.columns]
    return scored.select(*lead, *[c for c in df.columns if c not in PREDICTION_LEAD])


def node_rows(ensemble: TreeEnsemble) -> list[tuple]:
    return [(t, i, n.feature, n.threshold, n.missing_left if n.feature else None, n.gain, n.cover, n.weight)
            for t, tree in enumerate(ensemble.trees) for i, n in sorted(tree.items())]


def node_table(ensemble: TreeEnsemble, spark: SparkSession | None = None) -> DataFrame:
    """The nodes as rows (at most ``trees * 2^(depth + 1)``)."""
    return (spark or SparkSession.getActiveSession()).createDataFrame(node_rows(ensemble), NODE_SCHEMA)


def save_ensemble(ensemble: TreeEnsemble, path: str, spark: SparkSession | None = None) -> None:
    """The model as a table (W2); objective and base are columns of every row."""
    node_table(ensemble, spark).withColumns({"objective": F.lit(ensemble.objective), "base": F.lit(ensemble.base)}).write.mode(
        "overwrite").parquet(path)


def load_ensemble(spark: SparkSession, path: str) -> TreeEnsemble:
    """The saved model; its nodes are few, so they are collected."""
    rows = spark.read.parquet(path).orderBy("tree", "node").collect()
    trees: dict[int, dict[int, Node]] = defaultdict(dict)
    for r in rows:
        trees[r["tree"]][r["node"]] = Node(r["feature"], r["threshold"], bool(r["missing_left"]), r["gain"], r["cover"], r["weight"])
    return TreeEnsemble(rows[0]["objective"], rows[0]["base"], [trees[t] for t in sorted(trees)])


def gain_importance(nodes: DataFrame) -> DataFrame:
    """Per feature of a node table the gains of its splits, summed and not normalised, their number and cover."""
    return nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(
        F.sum("gain").alias("gain"), F.sum("cover").alias("cover"), F.count(F.lit(1)).alias("splits"))
