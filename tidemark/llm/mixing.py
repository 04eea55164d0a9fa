"""Mixing sources to target weights when documents belong to domains softly.

A classifier fitted on a labelled table gives every document its posterior over the domains. Each document gets
a nonnegative rate so that the expected tokens of each domain, the sum of rate x tokens x posterior, meet the
targets in the sense of least squares. The rates start at one and follow projected gradient steps; a step's
direction is the gradient, scaled by the Gram matrix of the documents that are not at zero, and by the
inverse of a document's tokens, so that long and short texts with equal posteriors get equal rates.

Only sums over all documents, one for each domain and pair of domains, go to the driver. A document's rate
follows from its posterior and the steps so far, so no state is kept between them.

Edge cases: a null or empty text has no tokens; its rate follows from its posterior as for any other, but it
counts for nothing. Targets of domains that the labelled table does not have are left out; targets are
scaled to sum to one. An empty table, or a labelled table with fewer than two domains, leaves all rates at one.
Repeated rows are documents of their own; other columns stay, whatever their names; one named as the result is replaced.
"""

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import unit_hash
from tidemark.session import release, settle

FEATURES = 1 << 14


def _spaced(text: Column) -> Column:
    """The text with one space for any white space (space, tab, line breaks) between words, none at its ends."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", " " * 5)
    return F.trim(F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " +", " ")).otherwise(flat))


def words(text: Column) -> Column:
    """What stands between white space, ``[^\\x20\\x09-\\x0D]+``."""
    return F.filter(F.split(_spaced(text), " "), lambda w: w != "")


def n_words(text: Column) -> Column:
    """How many words, by the spaces between them."""
    spaced = _spaced(text)
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("double")


class Domains:
    """The fitted classifier: names of the domains, and the model that gives their posteriors."""

    def __init__(self, names: list[str], model: PipelineModel | None):
        self.names, self.model = names, model

    def posteriors(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``__tokens`` and the array ``__p``, a posterior for each of ``names``."""
        counted = docs.withColumn("__words", words(F.col(text_col)))
        if self.model is None:
            p = F.array(*[F.lit(1.0) for _ in self.names]) if self.names else F.array().cast("array<double>")
            return counted.withColumn("__tokens", n_words(F.col(text_col))).withColumn("__p", p).drop("__words")
        scored = self.model.transform(counted)
        return scored.withColumn("__tokens", n_words(F.col(text_col))).withColumn("__p", vector_to_array("__probability")).drop(
            "__words", "__counts", "__features", "__raw", "__probability", "__prediction"
        )


def fit(labelled: DataFrame, per_domain: int = 1000) -> Domains:
    """Learn from about ``per_domain`` different rows of (id, text, domain) for each domain, picked by a hash of id and text.
    The classifier is a multinomial logistic regression on hashed words."""
    known = labelled.filter(F.col("domain").isNotNull() & F.col("text").isNotNull())
    counts = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    names = sorted(counts)
    if len(names) < 2:
        return Domains(names, None)
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, per_domain / n))])
    number = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, float(i))])
    sample = settle(
        known.filter(unit_hash("id", "text", seed=10) < share[F.col("domain")]).dropDuplicates(["id", "text", "domain"]).select(words(F.col("text")).alias("__words"), number[F.col("domain")].alias("label"))
    )
    hashing = HashingTF(inputCol="__words", outputCol="__counts", numFeatures=FEATURES, binary=True)
    scaling = Normalizer(inputCol="__counts", outputCol="__features")
    features = settle(scaling.transform(hashing.transform(sample)).select("label", "__features"))
    release(labelled.sparkSession)
    model = LogisticRegression(
        featuresCol="__features", rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction", regParam=1e-4, maxIter=40, family="multinomial"
    ).fit(features)
    return Domains(names, PipelineModel([hashing, scaling, model]))


def rate(p: Column, steps: list[list[float]]) -> Column:
    """The rate after the steps: from one, less the posterior's part in each step, never below zero."""
    out = F.lit(1.0)
    if not steps:
        return out
    listed = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    part = lambda step: sum((p[i] * step[i] for i in range(len(steps[0]))), F.lit(0.0))
    return F.aggregate(listed, out, lambda r, step: F.greatest(F.lit(0.0), r - part(step)))


def solve(docs: DataFrame, targets: np.ndarray, budget: float | None, iterations: int = 30, tolerance: float = 1e-6) -> tuple[list[list[float]], np.ndarray, np.ndarray]:
    """Steps of the projected gradient for rows of (__tokens, __p), with the domains' wanted and reached tokens."""
    d = len(targets)
    steps: list[list[float]] = []
    goal = reached = np.zeros(d)
    for turn in range(iterations + 1):
        if turn % 8 == 7:
            release(docs.sparkSession)  # every pass is a job with code of its own
        r, p, n = F.col("__rate"), F.col("__p"), F.col("__tokens")
        sums = [F.sum(r * n * p[i]) for i in range(d)]
        gram = [F.sum(F.when(r > 0, n * p[i] * p[j])) for i in range(d) for j in range(i, d)]
        row = docs.withColumn("__rate", rate(p, steps)).agg(*sums, *gram).first()
        values = [0.0 if x is None else float(x) for x in row]
        reached = np.array(values[:d])
        if not steps:  # the natural tokens
            if reached.sum() <= 0:
                return [], reached, reached
            total = budget if budget is not None else max((s / t for s, t in zip(reached, targets) if t > 0), default=reached.sum())
            goal = total * targets
        if np.abs(reached - goal).max() <= tolerance * max(1.0, goal.sum()) or len(steps) == iterations:
            break
        g, at = np.zeros((d, d)), d
        for i in range(d):
            for j in range(i, d):
                g[i, j] = g[j, i] = values[at]
                at += 1
        step = np.linalg.lstsq(g + 1e-9 * np.trace(g) / d * np.eye(d), reached - goal, rcond=None)[0]
        steps.append(step.tolist())
    return steps, goal, reached


def mix(docs: DataFrame, domains: Domains, targets: Mapping[str, float] | float, budget: float | None = None, text_col: str = "text", keep: Sequence[str] | None = None, into: str = "mixed") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with a struct, named by ``into``: tokens, p (posteriors in the
    order of ``domains.names``), domain and rate.

    ``targets`` are shares by domain, or a number: the natural shares to that power. ``budget`` is the wanted number of
    tokens, by default the least for which no domain shrinks.
    """
    # The kept columns travel in a struct, so that none has a name of those made here.
    kept = list(docs.columns if keep is None else keep)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(None).cast("struct<>")
    scored = settle(domains.posteriors(docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))).select("row", "__tokens", "__p"))
    names = domains.names
    steps: list[list[float]] = []
    if len(names) > 1:
        if isinstance(targets, Mapping):
            wanted = np.array([max(0.0, float(targets.get(n, 0.0))) for n in names])
        else:
            row = scored.agg(*[F.sum(F.col("__tokens") * F.col("__p")[i]) for i in range(len(names))]).first()
            wanted = np.array([float(x or 0.0) for x in row]) ** targets
        if wanted.sum() > 0:
            steps, _, _ = solve(scored.select("__tokens", "__p"), wanted / wanted.sum(), budget)
    listed = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    likeliest = F.when(F.size("__p") > 0, F.element_at(listed, F.array_position("__p", F.array_max("__p")).cast("int")))
    mixed = F.struct(F.col("__tokens").cast("long").alias("tokens"), F.col("__p").alias("p"), likeliest.alias("domain"), rate(F.col("__p"), steps).alias("rate"))
    return scored.select(*[F.col("row")[c].alias(c) for c in kept if c != into], mixed.alias(into))


def copies(rate: Column, *key: Column | str) -> Column:
    """A whole number of copies: the rate, its fraction rounded up for a share of the rows by a hash of ``key``."""
    return (F.floor(rate) + (unit_hash(*key, seed=11) < rate - F.floor(rate)).cast("long")).cast("int")
