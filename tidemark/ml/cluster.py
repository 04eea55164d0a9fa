"""K-Means and bisecting K-Means with the number of clusters chosen by silhouette."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import fixed_values as fixed
from tidemark.ml.features import cluster_features, training_tasks
from tidemark.session import in_parallel, settle


@dataclass
class Clusters:
    """Rows with their ``cluster``, the best k, its silhouette, and the silhouette of every k tried."""

    rows: DataFrame
    k: int
    silhouette: float
    scores: dict[int, float] = field(default_factory=dict)


def _best_k(ready: DataFrame, points: DataFrame, make, ks: Sequence[int], threads: int) -> Clusters:
    evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features", metricName="silhouette", weightCol="weight")

    def attempt(k: int):
        model = make(k).setWeightCol("weight").fit(points)
        labelled = model.transform(points)
        if labelled.select("cluster").distinct().limit(2).count() < 2:
            return k, None, model  # the silhouette needs two clusters
        return k, evaluator.evaluate(labelled), model

    tried = {k: (score, model) for k, score, model in in_parallel(attempt, ks, threads) if score is not None}
    if not tried:
        raise ValueError("no number of clusters gave two clusters")
    best = max(tried, key=lambda k: (tried[k][0], -k))
    return Clusters(tried[best][1].transform(ready), best, tried[best][0], {k: score for k, (score, _) in tried.items()})


def _points(ready: DataFrame) -> DataFrame:
    """The different feature vectors with their number of rows as ``weight``, dealt and ordered by their values alone.

    Training then sees the same partitions in the same order however the rows came, so its random draws and with them the
    clusters are the same; and rows of one vector, however many, are one point.
    """
    listed = ready.select(vector_to_array("features").alias("x")).groupBy("x").agg(F.count("*").cast("double").alias("weight"))
    listed = settle(listed)
    dealt = listed.repartition(training_tasks(listed.count()), "x").sortWithinPartitions("x")
    return dealt.select(array_to_vector("x").alias("features"), "weight")


def _candidates(rows: int, max_k: int) -> range:
    if rows < 4:
        raise ValueError(f"{rows} rows are too few to cluster")
    return range(2, min(max_k, rows // 2) + 1)


def _search(df: DataFrame, features: Sequence[str], make, max_k: int, threads: int) -> Clusters:
    ready = cluster_features(df, features)
    ks = _candidates(ready.count(), max_k)
    points = _points(ready).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _best_k(ready, points, make, ks, threads)
    finally:
        points.unpersist()  # the chosen model labels the rows without it


def k_means(
    df: DataFrame,
    features: Sequence[str],
    *,
    max_k: int = fixed.KMEANS_MAX_K,
    seed: int = fixed.ML_SEED,
    threads: int = 4,
) -> Clusters:
    """K-Means for k = 2..max_k on all rows; the k with the best silhouette wins."""

    def make(k: int) -> KMeans:
        return KMeans(
            k=k, featuresCol="features", predictionCol="cluster", seed=seed,
            maxIter=fixed.KMEANS_MAX_ITER, tol=fixed.KMEANS_TOL,
        )

    return _search(df, features, make, max_k, threads)


def bisecting_k_means(
    df: DataFrame,
    features: Sequence[str],
    *,
    max_k: int = fixed.KMEANS_MAX_K,
    seed: int = fixed.ML_SEED,
    threads: int = 4,
) -> Clusters:
    """Bisecting K-Means with the same search for k."""

    def make(k: int) -> BisectingKMeans:
        return BisectingKMeans(
            k=k, featuresCol="features", predictionCol="cluster", seed=seed, maxIter=fixed.KMEANS_MAX_ITER
        )

    return _search(df, features, make, max_k, threads)


def cluster_members(rows: DataFrame, features: Sequence[str], *, cluster: str = "cluster") -> DataFrame:
    """Features, the cluster as text ('Noise' for -1), and the first other text column."""
    others = [
        f.name
        for f in rows.schema.fields
        if f.name not in features and f.name != cluster and isinstance(f.dataType, StringType)
    ]
    name = F.when(F.col(cluster) == -1, fixed.NOISE_NAME).otherwise(F.col(cluster).cast("string"))
    return rows.select(*features, name.alias("Cluster"), *others[:1])
