"""Isolation forest: small trees on hashed samples, applied to every row."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.ranks import percentiles
from tidemark.ml.features import standardized
from tidemark.session import settle

_TREE = (
    "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, "
    "depth array<int>, size array<int>"
)


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a tree of n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def _hash_limit(wanted: int, total: int) -> int:
    """The hash below which surely ``wanted`` of ``total`` rows lie, but not many more."""
    share = min(1.0, (1.3 * wanted + 10 * math.sqrt(wanted)) / total)
    return min(int(-(2**63) + share * 2**64), 2**63 - 1)


def _samples(scaled: DataFrame, names: Sequence[str], key: str, trees: int, rows: int, seed: int, total: int):
    """(tree, features): for each tree its own sample of all rows, chosen by hash, at most ``rows`` per tree.

    A hash limit leaves little more than the samples before anything is sorted or shuffled.
    """
    limit = F.lit(_hash_limit(rows, total))
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.struct(tree.alias("tree"), F.xxhash64(F.col(key), F.lit(seed), tree).alias("draw")),
    )
    drawn = (
        scaled.select(key, *names, F.explode(F.filter(draws, lambda x: x["draw"] <= limit)).alias("__drawn"))
        .select(key, *names, F.col("__drawn.tree").alias("tree"), F.col("__drawn.draw").alias("__draw"))
    )
    order = Window.partitionBy("tree").orderBy("__draw", key)
    return (
        drawn.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= rows).select("tree", key, *names)
    )


def _grow(names: Sequence[str], key: str, seed: int):
    """A function that builds one tree from the rows of its sample."""

    def build(sample: pd.DataFrame) -> pd.DataFrame:
        tree = int(sample["tree"].iloc[0])
        x = sample.sort_values(key)[list(names)].to_numpy()
        random = np.random.default_rng([seed, tree])
        deepest = math.ceil(math.log2(max(len(x), 2)))
        feature, cut, left, right, depth, size = [], [], [], [], [], []

        def node(rows: np.ndarray, level: int) -> int:
            at = len(feature)
            for values, start in ((feature, -1), (cut, 0.0), (left, -1), (right, -1), (depth, level), (size, len(rows))):
                values.append(start)
            low, high = rows.min(axis=0), rows.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level >= deepest or len(rows) <= 1 or len(varied) == 0:
                return at
            axis = int(random.choice(varied))
            place = float(random.uniform(low[axis], high[axis]))
            under = rows[:, axis] <= place
            if under.all():
                return at
            feature[at], cut[at] = axis, place
            left[at] = node(rows[under], level + 1)
            right[at] = node(rows[~under], level + 1)
            return at

        node(x, 0)
        return pd.DataFrame(
            [[tree, feature, cut, left, right, depth, size]],
            columns=["tree", "feature", "cut", "left", "right", "depth", "size"],
        )

    return build


def _scorer(forest: list, sample_size: int):
    """A vectorised function from feature columns to the anomaly score in (-1, 0)."""
    trees = [
        (
            np.array(t["feature"]), np.array(t["cut"]), np.array(t["left"]), np.array(t["right"]),
            np.array(t["depth"]) + np.array([mean_path(n) for n in t["size"]]),
        )
        for t in forest
    ]
    scale = mean_path(sample_size) * len(trees)

    @F.pandas_udf("double")
    def score(columns: pd.DataFrame) -> pd.Series:
        x = columns.to_numpy(dtype=float)
        total = np.zeros(len(x))
        everyone = np.arange(len(x))
        for feature, cut, left, right, length in trees:
            at = np.zeros(len(x), dtype=int)
            moving = everyone
            while len(moving):
                moving = moving[feature[at[moving]] >= 0]
                here = at[moving]
                under = x[moving, feature[here]] <= cut[here]
                at[moving] = np.where(under, left[here], right[here])
            total += length[at]
        return pd.Series(-np.power(2.0, -total / scale) if scale else np.full(len(x), -0.5))

    return score


def isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    *,
    key: str,
    contamination: Sequence[float] = fixed.CONTAMINATION_LEVELS,
    trees: int = fixed.ISOLATION_TREES,
    sample_rows: int = fixed.ISOLATION_ROWS,
    seed: int = fixed.ML_SEED,
) -> DataFrame:
    """All columns of the rows without nulls, with ``Score`` (low is odd) and the flag ``Anomalia``.

    The contamination that flags fewest rows, but some, is chosen; the flag's limit is the exact
    percentile of the scores. The forest is bounded by ``trees`` and ``sample_rows``, whatever the data.
    """
    scaled = settle(standardized(df, features))
    names = [f"z_{name}" for name in features]
    total = scaled.count()
    size = min(sample_rows, total)
    samples = _samples(scaled, names, key, trees, size, seed, total)
    forest = samples.groupBy("tree").applyInPandas(_grow(names, key, seed), _TREE).collect()
    score = _scorer(sorted(forest, key=lambda tree: tree["tree"]), size)
    scored = settle(scaled.withColumn("Score", score(F.struct(*names))).drop(*names))
    limits = dict(zip(contamination, percentiles(scored, "Score", list(contamination))))
    flagged = scored.agg(
        *[F.count_if(F.col("Score") < limit).alias(str(i)) for i, limit in enumerate(limits.values())]
    ).first()
    # The level that flags fewest rows, but at least one.
    found = [(n, limit) for n, limit in zip(flagged, limits.values()) if n > 0]
    limit = min(found)[1] if found else min(limits.values())
    return scored.withColumn("Anomalia", F.col("Score") < F.lit(limit))
