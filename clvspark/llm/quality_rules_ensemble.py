"""A quality classifier as a sparse ensemble of rules.

1. Every text becomes a row of statistics, in Arrow batches.
2. Boosted trees over the labelled rows propose rules: each path from a root
   to a node is a conjunction of comparisons on statistics.
3. A logistic model with a lasso penalty weighs the rules (0/1) and the
   scaled statistics; most weights become zero.
4. What is left is compiled into one Spark column expression over the
   statistics; scoring is a narrow pass over the corpus.

Learning uses about ``max_rows`` labelled rows, chosen by a hash of the key;
trees and weights are fitted by Spark ML. Inputs of a score are statistics
of the text only.

Defined results: null and empty texts have all statistics 0 and get a score
like any other; repeated rows get equal scores; without labelled rows, or
with one label only, every score is the share of label 1 (0.5 if none).
Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clvspark.llm import text_statistics
from clvspark.llm.text_statistics import STATISTICS
from clvspark.session import materialize


def statistics(docs: DataFrame, text: str, *kept: Column) -> DataFrame:
    """``kept`` columns c0, c1, ... and the statistics of every row; null texts count as empty."""
    source = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(kept)],
                         F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = StructType([*source.schema.fields[:-1], *[StructField(s, DoubleType()) for s in STATISTICS]])
    names, columns = STATISTICS, schema.names

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            found = np.empty((batch.num_rows, len(names)))
            for at in range(batch.num_rows):  # one text at a time: a batch of words is never held
                found[at] = text_statistics.measured(texts[at].as_py())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(np.ascontiguousarray(x)) for x in found.T]], names=columns)

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most, threshold)."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, of) -> Column:
        out = F.lit(True)
        for name, at_most, threshold in self.tests:
            out = out & ((of(name) <= threshold) if at_most else (of(name) > threshold))
        return out


@dataclass
class RuleEnsemble:
    """score = 1 / (1 + exp(-(intercept + sum of weights of true rules + linear terms)))."""

    intercept: float
    rules: list[tuple[Rule, float]]
    linear: list[tuple[str, float]]

    def score(self, of) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(rule.column(of), F.lit(weight)).otherwise(F.lit(0.0))
        for name, weight in self.linear:
            total = total + of(name) * F.lit(weight)
        return 1 / (1 + F.exp(-total))


def _paths(node, tests=()) -> list[Rule]:
    """The rules of a fitted tree: one for each path to an inner node's child."""
    if node.subtreeDepth() == 0:
        return []
    split = node.split()
    name, threshold = STATISTICS[split.featureIndex()], float(split.threshold())
    found = []
    for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
        path = (*tests, (name, at_most, threshold))
        found.append(Rule(_simplified(path)))
        found += _paths(child, path)
    return found


def _simplified(path) -> tuple:
    """Of several tests of one statistic in one direction only the tightest matters."""
    tight: dict[tuple[str, bool], float] = {}
    for name, at_most, threshold in path:
        now = tight.get((name, at_most))
        tight[name, at_most] = threshold if now is None else (min if at_most else max)(now, threshold)
    return tuple(sorted((n, a, t) for (n, a), t in tight.items()))


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = 20_000,
        trees: int = 10, depth: int = 3, penalty: float = 0.002, seed: int = 13) -> RuleEnsemble:
    """Learn from ``labelled`` (key, text, label 0/1; null labels do not count)."""
    known = labelled.filter(F.col(label).isin(0, 1))
    share = min(1.0, max_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    rows = materialize(statistics(chosen, text, F.col(label).cast("double")).withColumnRenamed("c0", "label"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        one = next(iter(counts), 0.5)
        return RuleEnsemble({0.0: -20.0, 1.0: 20.0}.get(one, 0.0), [], [])
    n = sum(counts.values())
    # both classes weigh alike while rules are sought; the weights below see the rows as they are
    balanced = rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(n / (2 * counts[1.0]))).otherwise(
        F.lit(n / (2 * counts[0.0])))).coalesce(2).persist()
    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="x")
    grown = GBTClassifier(featuresCol="x", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth,
                          stepSize=0.3, subsamplingRate=0.8, seed=seed, maxBins=64).fit(vector.transform(balanced))
    rules = list(dict.fromkeys(r for t in grown.trees for r in _paths(t._java_obj.rootNode())))
    of = lambda name: F.col(name)
    spread = rows.agg(*[F.coalesce(F.stddev(s), F.lit(0.0)).alias(s) for s in STATISTICS]).first()
    varied = [s for s in STATISTICS if spread[s] and math.isfinite(spread[s])]
    table = balanced.select("label", F.array(
        *[r.column(of).cast("double") for r in rules], *[F.col(s) * F.lit(0.4 / spread[s]) for s in varied]).alias("a"))
    lasso = LogisticRegression(featuresCol="x", labelCol="label", elasticNetParam=1.0, regParam=penalty, maxIter=40,
                               standardization=False).fit(table.select("label", array_to_vector("a").alias("x")))
    balanced.unpersist()
    weights = [float(w) for w in lasso.coefficients.toArray()]
    return RuleEnsemble(float(lasso.intercept), [(r, w) for r, w in zip(rules, weights, strict=False) if w],
                        [(s, w * 0.4 / spread[s]) for s, w in zip(varied, weights[len(rules):], strict=True) if w])


def score(docs: DataFrame, model: RuleEnsemble, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row; the compiled rules run over the statistics in the same pass."""
    rows = statistics(docs, text, F.col(key))
    return rows.select(F.col("c0").alias(key), F.least(F.greatest(model.score(F.col), F.lit(0.0)), F.lit(1.0)).alias("score"))
