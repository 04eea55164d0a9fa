"""DBSCAN, components, order numbers, exact ranks and isolation forest against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.ordinal import with_ordinal
from tidemark.functions.ranks import percentile, values_at_ranks
from tidemark.ml import dbscan as density
from tidemark.ml.components import components
from tidemark.ml.isolation import isolation_forest, mean_path


def brute_dbscan(points, eps, least):
    """Labels by definition: clusters in the order of their first core point, border to the first."""
    near = [
        [j for j, q in enumerate(points) if sum((a - b) ** 2 for a, b in zip(p, q)) <= eps * eps] for p in points
    ]
    core = [len(n) >= least for n in near]
    labels = [-1] * len(points)
    number = 0
    for start in range(len(points)):
        if labels[start] != -1 or not core[start]:
            continue
        stack, members = [start], {start}
        while stack:
            for other in near[stack.pop()]:
                if core[other] and other not in members:
                    members.add(other)
                    stack.append(other)
        for member in members:
            labels[member] = number
        number += 1
    for i in range(len(points)):
        if not core[i]:
            labels[i] = min((labels[j] for j in near[i] if core[j]), default=-1)
    return labels


def spark_dbscan(spark, points, eps, least):
    names = [f"f{i}" for i in range(len(points[0]))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], ["key", *names])
    found = density.dbscan(df, names, key="key", eps=eps, min_samples=least)
    return [row["cluster"] for row in found.select("key", "cluster").orderBy("key").collect()]


def blobs(seed, dims, n):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-2, 2, size=(4, dims))
    spread = [0.05, 0.15, 0.3, 0.6]
    rows = [centres[i % 4] + rng.normal(0, spread[i % 4], dims) for i in range(n)]
    rows += [rows[0]] * 7  # equal points
    return [tuple(float(round(v, 3)) for v in row) for row in rows]


@pytest.mark.parametrize(
    "dims, n, eps, least, few",
    [(1, 150, 0.05, 4, 32), (2, 300, 0.2, 5, 32), (2, 300, 0.2, 5, 2), (3, 250, 0.5, 6, 1), (2, 120, 0.3, 1, 2)],
)
def test_dbscan_equals_brute_force(spark, monkeypatch, dims, n, eps, least, few):
    """``few`` small forces the splitting of boxes that otherwise only crowded cells need."""
    monkeypatch.setattr(density, "FEW_SPOTS", few)
    points = blobs(dims * 100 + n, dims, n)
    random.Random(3).shuffle(points)
    assert spark_dbscan(spark, points, eps, least) == brute_dbscan(points, eps, least)


def test_dbscan_dense_cells_just_apart(spark, monkeypatch):
    """Crowded neighbours whose boxes are in reach: one pair touches, one does not."""
    monkeypatch.setattr(density, "FEW_SPOTS", 2)
    rng = np.random.default_rng(5)
    left = [(float(x), float(y)) for x, y in rng.uniform(0, 0.5, (80, 2))]
    touching = [(float(x), float(y)) for x, y in rng.uniform((1.2, 0), (1.7, 0.5), (80, 2))]
    for gap in (0.0, 0.4):
        points = left + [(x + gap, y) for x, y in touching]
        assert spark_dbscan(spark, points, 0.9, 5) == brute_dbscan(points, 0.9, 5)


def test_border_point_joins_the_first_cluster(spark):
    left = [(-1.0, 0.0), (-1.1, 0.0), (-1.2, 0.0), (-0.9, 0.1)]
    right = [(1.0, 0.0), (1.1, 0.0), (1.2, 0.0), (0.9, 0.1)]
    middle = [(0.0, 0.0)]
    for points in (left + right + middle, middle + right + left):
        assert spark_dbscan(spark, points, 1.0, 4) == brute_dbscan(points, 1.0, 4)


def test_all_noise_and_single_cluster(spark):
    apart = [(float(i * 10), 0.0) for i in range(12)]
    assert spark_dbscan(spark, apart, 1.0, 2) == [-1] * 12
    assert spark_dbscan(spark, [(1.0, 1.0)] * 12, 1.0, 5) == [0] * 12


def test_too_many_features(spark):
    with pytest.raises(ValueError):
        spark_dbscan(spark, [tuple(float(i) for i in range(7))], 1.0, 2)


def test_dbscan_search_takes_the_best(spark):
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(blobs(9, 2, 200))]
    df = spark.createDataFrame(points, ["key", "x", "y"])
    rows, chosen = density.dbscan_search(df, ["x", "y"], key="key", eps=(0.3, 0.5), min_samples=(5, 10))
    assert rows.count() == len(points)
    assert chosen["n_clusters"] == rows.filter("cluster >= 0").select("cluster").distinct().count() >= 2
    assert chosen["n_noise"] == rows.filter("cluster < 0").count()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 130)] + [(500, 200)]
    nodes = sorted(set(itertools.chain(*edges))) + [999]
    random.Random(1).shuffle(edges)
    found = components(
        spark.createDataFrame([(n,) for n in nodes], "node bigint"), spark.createDataFrame(edges, "u bigint, v bigint")
    )
    expected = {n: 0 if n <= 60 else 100 if n < 200 else 999 if n == 999 else 200 for n in nodes}
    assert {r["node"]: r["label"] for r in found.collect()} == expected


def test_ordinal_numbers_every_row_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    found = with_ordinal(df, ["v"], "n").orderBy("v").collect()
    assert [r["n"] for r in found] == list(range(5000))


def test_exact_ranks_by_brackets(spark, monkeypatch):
    import tidemark.functions.ranks as ranks

    monkeypatch.setattr(ranks, "SORT_AT_MOST", 20)
    rng = np.random.default_rng(2)
    values = [float(v) for v in np.round(rng.exponential(10, 3000), 2)] + [7.5] * 1500
    values += [None, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = sorted(v for v in values if v is not None)
    wanted = [0, 1, 1200, 2250, 4498, 4499]
    assert values_at_ranks(df, "v", wanted) == [kept[i] for i in wanted]
    assert percentile(df, "v", 0.5) == pytest.approx(float(np.percentile(kept, 50)))
    assert percentile(df.filter("v < 0"), "v", 0.5) is None


def test_isolation_forest_flags_the_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (600, 2)))]
    rows += [(1000 + i, 12.0 + i, -11.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, ["key", "x", "y"])
    once = isolation_forest(df, ["x", "y"], key="key")
    again = isolation_forest(df.repartition(13), ["x", "y"], key="key")
    first = {r["key"]: (r["Score"], r["Anomalia"]) for r in once.collect()}
    second = {r["key"]: (r["Score"], r["Anomalia"]) for r in again.collect()}
    assert first.keys() == second.keys() == {r[0] for r in rows}
    assert all(second[k][0] == pytest.approx(first[k][0], abs=1e-9) for k in first)
    assert all(first[1000 + i][1] for i in range(5))
    lowest = sorted(first, key=lambda k: first[k][0])[:5]
    assert set(lowest) == {1000 + i for i in range(5)}
    flagged = sum(flag for _, flag in first.values())
    assert 0 < flagged <= 0.05 * len(rows) + 1
    assert all(-1 < score < 0 for score, _ in first.values())


def test_isolation_forest_samples_from_a_pool(spark):
    """With many rows the trees share out one hashed sample."""
    df = spark.range(3000).select("id", (F.col("id") % 97).cast("double").alias("x"))
    found = isolation_forest(df, ["x"], key="id", trees=10, sample_rows=32)
    assert found.count() == 3000


def test_mean_path():
    assert [mean_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert mean_path(256) == pytest.approx(10.2448, abs=1e-3)
