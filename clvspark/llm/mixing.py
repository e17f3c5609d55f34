"""Soft-membership mixing of sources to target weights, in DataFrame operations only.

1. A classifier learnt from a labelled table (naive Bayes over hashed words)
   gives every document a posterior over the domains. A word's evidence is
   averaged, as if a text had ``evidence`` words at most, so that long texts
   keep soft memberships.
2. Document i with n_i words and posterior p_i adds a_i = n_i p_i expected
   words to the domains for each copy of it. Wanted are the rates
   r_i >= ``least`` with sum_i r_i a_i = target that lie nearest to 1, each
   document weighing with its words: least sum_i n_i (r_i - 1)^2 / 2. They
   have the form::

       r_i = max(least, 1 + p_i . y)

   with one y for all documents, so no rates are stored or joined and a long
   text moves no further than a short one. y is the minimum of the dual, a
   convex function of D numbers, by projected Newton rounds in the metric of
   the Gram matrix of the rows off the bound, sum_i n_i p_i p_i', with a line
   search: a round that makes it worse is dropped for a shorter one. A small
   proximal term keeps the metric regular; it is centred anew until the
   totals meet the target to the tolerance.

Each round is one distributed sum of 1 + D + D (D + 1) / 2 numbers.

A target can lie out of reach: at ``least`` 1 other domains' documents bring
a little of a domain that may not grow. Rounds then end when centring anew no
longer halves the miss. ``Mixture`` holds target and reached totals and
``arrived``; ``mix`` returns both totals and ``resampled`` warns.

The driver holds D numbers per round, a D x D matrix and the word table of
D times ``buckets`` numbers; D is at most ``max_domains``.

Defined results: a null or empty text has no words, the classifier's priors
as posterior, and keeps rate 1; repeated rows get equal rates; without
labelled rows there is one domain holding everything. Other columns are
ignored.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clvspark.llm.frames import positional
from clvspark.session import materialize

_SPACE = r"[\x20\x09-\x0D]+"


def words(text: str) -> Column:
    """The whitespace-separated words of a text, lower-cased; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), _SPACE), lambda w: w != "")


@dataclass
class DomainModel:
    """Log priors (D,) and log likelihoods (D, buckets) of hashed words."""

    domains: list[str]
    priors: list[float]
    likelihoods: np.ndarray
    evidence: float

    def posterior(self, found: Column) -> Column:
        """array<double> over the domains for an array of words."""
        buckets = self.likelihoods.shape[1]
        # one constant per domain, folded by the optimizer; a literal per number would be slow to build
        tables = [F.split(F.lit(",".join(map(repr, row.tolist()))), ",").cast("array<double>") for row in self.likelihoods]
        zero = F.array(*[F.lit(0.0)] * len(self.domains))

        def add(acc: Column, w: Column) -> Column:
            at = F.pmod(F.hash(w), F.lit(buckets))
            return F.array(*[F.get(acc, F.lit(d)) + F.get(t, at) for d, t in enumerate(tables)])

        def normal(logs: Column) -> Column:
            top = F.array_max(logs)
            raised = F.transform(logs, lambda x: F.exp(x - top))
            return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda s, v: s + v))

        def scored(sums: Column) -> Column:
            share = F.least(F.lit(1.0), F.lit(self.evidence) / F.greatest(F.size(found), F.lit(1)))
            return F.array(*[F.lit(p) + F.get(sums, F.lit(d)) * share for d, p in enumerate(self.priors)])

        return _let(F.aggregate(found, zero, add), lambda sums: _let(scored(sums), normal))


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fit_domains(labelled: DataFrame, key: str = "doc_id", text: str = "text", domain: str = "lang",
                buckets: int = 4096, max_documents: int = 20_000, max_domains: int = 64, evidence: float = 20.0,
                seed: int = 5) -> DomainModel:
    """Naive Bayes from about ``max_documents`` labelled rows, chosen by a hash of the key."""
    known = labelled.filter(F.col(domain).isNotNull())
    share = min(1.0, max_documents / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    per_word = chosen.select(F.col(domain).cast("string").alias("domain"), F.explode(words(text)).alias("w")).groupBy(
        "domain", F.pmod(F.hash("w"), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    rows = chosen.groupBy(F.col(domain).cast("string").alias("domain")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "domain").limit(max_domains + 1).collect()
    if len(rows) > max_domains:
        raise ValueError(f"more than {max_domains} domains")
    domains = sorted(r["domain"] for r in rows) or ["all"]
    number = {d: i for i, d in enumerate(domains)}
    counts = np.zeros((len(domains), buckets))
    for r in per_word.collect():
        counts[number[r["domain"]], r["bucket"]] = r["n"]
    smooth = counts + 0.5
    sizes = {r["domain"]: r["n"] for r in rows}
    total = sum(sizes.values()) or 1
    return DomainModel(domains, [math.log(sizes.get(d, 1) / total) if sizes else 0.0 for d in domains],
                       np.log(smooth / smooth.sum(axis=1, keepdims=True)), evidence)


@dataclass
class Mixture:
    """The fitted rates as a rule: ``y``, with the expected words wanted and reached."""

    domains: list[str]
    y: list[float]
    least: float
    target: list[float]
    reached: list[float]
    arrived: bool

    def rate(self, mass: Column) -> Column:
        """The rate of a document with expected words ``mass`` (array<double>)."""
        return F.greatest(F.lit(self.least), _unbounded(mass, self.y))


def _total(mass: Column) -> Column:
    """Words of a document, for dividing by: a text without words has no mass to divide."""
    return F.greatest(F.aggregate(mass, F.lit(0.0), lambda s, v: s + v), F.lit(1e-9))


def _unbounded(mass: Column, y: list[float]) -> Column:
    return 1.0 + sum((F.get(mass, F.lit(d)) * F.lit(float(v)) for d, v in enumerate(y)), F.lit(0.0)) / _total(mass)


def smoothed_target(totals: np.ndarray, power: float = 0.7) -> np.ndarray:
    """Domain weights proportional to total ** power: rarer domains get more than their share."""
    raised = np.where(totals > 0, totals, 0.0) ** power
    return raised / raised.sum() if raised.sum() else raised


def fit_rates(masses: DataFrame, domains: list[str], weights: dict[str, float] | None = None, least: float = 0.0,
              budget: float | None = None, rounds: int = 200, tolerance: float = 1e-6, ridge: float = 1e-5) -> Mixture:
    """Rates for ``masses`` (column ``mass`` array<double>) so that expected words reach the target weights.

    ``weights`` default to ``smoothed_target``. ``budget`` is the expected
    number of words wanted; by default the present number, or, when
    ``least`` >= 1, the smallest at which no domain has to shrink. The miss of
    a domain is measured by its target or its present number, whichever is
    larger; ``rounds`` only guards against an endless loop.
    """
    d = len(domains)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    item = lambda i: F.get("mass", F.lit(i))

    def sums(y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """At y: the dual's sum over rows, expected words, and the Gram matrix of the rows off the bound."""
        u = _unbounded(F.col("mass"), y)
        parts = masses.select("mass", u.alias("u"), F.greatest(F.lit(least), u).alias("r"), _total(F.col("mass")).alias("n"))
        row = parts.agg(F.sum(F.expr(f"n * (r * r / 2 + {float(least)!r}D * (u - r))")).alias("value"),
                        *[F.sum(item(i) * F.col("r")).alias(f"s{i}") for i in range(d)],
                        *[F.sum(F.when(F.col("u") >= least, item(i) * item(j) / F.col("n"))).alias(f"g{i}_{j}") for i, j in pairs]).first()
        matrix = np.zeros((d, d))
        for i, j in pairs:
            matrix[i, j] = matrix[j, i] = row[f"g{i}_{j}"] or 0.0
        return row["value"] or 0.0, np.array([row[f"s{i}"] or 0.0 for i in range(d)]), matrix

    now = masses.agg(*[F.sum(item(i)).alias(f"s{i}") for i in range(d)]).first()
    now = np.array([now[f"s{i}"] or 0.0 for i in range(d)])
    wanted = np.array([weights.get(x, 0.0) for x in domains]) if weights else smoothed_target(now)
    wanted = wanted / wanted.sum() if wanted.sum() else wanted
    if budget is None:
        shrink = [now[i] / wanted[i] for i in range(d) if wanted[i] > 0]
        budget = max([now.sum() * least, *[x * least for x in shrink]]) if least >= 1 else now.sum()
    target = wanted * budget
    y = np.zeros(d)
    value, reached, gram = sums(y)
    size = np.maximum(np.maximum(target, now), 1e-12 * max(1.0, now.sum()))
    near = ridge * np.maximum(now, 1e-12 * max(1.0, now.sum()))  # the proximal term's weights
    centre, before = y, math.inf
    for _ in range(rounds):
        miss = np.abs((reached - target) / size).max()
        if miss <= tolerance:
            break
        slope = reached - target + near * (y - centre)
        if np.abs(slope / size).max() <= max(tolerance / 10, 1e-3 * miss):  # settled round this centre
            if miss > 0.5 * before:
                break
            centre, before = y, miss
            continue
        step = -np.linalg.solve(gram + np.diag(near), slope)
        level = value - target @ y + near @ (y - centre) ** 2 / 2
        share = 1.0
        while True:
            new = y + share * step
            new_value, new_reached, new_gram = sums(new)
            new_level = new_value - target @ new + near @ (new - centre) ** 2 / 2
            new_slope = new_reached - target + near * (new - centre)
            if new_level <= level + 1e-4 * share * (slope @ step) or np.abs(new_slope / size).max() <= 0.5 * np.abs(slope / size).max():
                y, value, reached, gram = new, new_value, new_reached, new_gram
                break
            share /= 2
            if share < 1e-6:
                break
        if share < 1e-6:
            break
    miss = np.abs((reached - target) / size).max()
    return Mixture(domains, y.tolist(), least, target.tolist(), reached.tolist(), bool(miss <= tolerance))


def masses_of(model: DomainModel, text: str, use) -> Column:
    """``use(n, posterior, mass)`` of a text: its words, posterior and expected words per domain, each computed once."""
    return _let(words(text), lambda w: _let(model.posterior(w), lambda p: _let(
        F.transform(p, lambda x: x * F.size(w)), lambda mass: use(F.size(w).cast("long"), p, mass))))


def domain_masses(docs: DataFrame, model: DomainModel, text: str, *kept: str) -> DataFrame:
    """``kept`` with words, posterior and mass of every row, written as a table."""
    one = masses_of(model, text, lambda n, p, mass: F.struct(n.alias("words"), p.alias("posterior"), mass.alias("mass")))
    return materialize(docs.select(*kept, F.inline(F.array(one))))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", domain: str = "lang",
        weights: dict[str, float] | None = None, least: float = 0.0, **options) -> DataFrame:
    """Every row's likeliest domain with its membership, words and rate, and that domain's totals wanted and reached."""
    model = fit_domains(docs, key, text, domain, **options)
    masses = domain_masses(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), model, "_text", "_key")
    mixture = fit_rates(masses, model.domains, weights, least)
    best = F.array_position("posterior", F.array_max("posterior")).cast("int") - 1
    of = lambda values: F.get(F.array(*map(F.lit, values)), best)
    return masses.select(F.col("_key").alias(key), of(model.domains).alias("domain"),
                         F.array_max("posterior").alias("membership"), F.col("words").alias("n_words"),
                         mixture.rate(F.col("mass")).alias("rate"), of(mixture.target).alias("domain_target"),
                         of(mixture.reached).alias("domain_reached"))


def resampled(docs: DataFrame, key: str = "doc_id", text: str = "text", domain: str = "lang",
              weights: dict[str, float] | None = None, least: float = 1.0, seed: int = 3, **options) -> DataFrame:
    """``docs`` with each row repeated by its rate: the whole part, and one more with the rest's probability.

    The draw is a hash of key and text, so a rerun gives the same rows. With
    ``least`` = 1 every document stays at least once.
    """
    model = fit_domains(docs, key, text, domain, **options)
    mixture = fit_rates(domain_masses(docs, model, text), model.domains, weights, least)
    if not mixture.arrived:
        totals = zip(mixture.domains, mixture.target, mixture.reached, strict=True)
        warnings.warn("mixing: target out of reach; words wanted and reached: " + ", ".join(
            f"{x} {t:.0f} {r:.0f}" for x, t, r in totals), stacklevel=2)
    names = positional(docs)
    own_key, own_text = names[docs.columns.index(key)], names[docs.columns.index(text)]
    draw = F.pmod(F.xxhash64(F.col(own_key), F.col(own_text), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = masses_of(model, own_text, lambda n, p, mass: F.array_repeat(
        F.lit(0), F.floor(mixture.rate(mass) + 1e-9 + draw).cast("int")))
    return docs.toDF(*names).select("*", F.explode(copies).alias("copy")).select(*names).toDF(*docs.columns)
