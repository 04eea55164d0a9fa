"""Density clustering (DBSCAN) as joins of grid cells, exact and without comparing all points.

A cell has the side eps / sqrt(d): all points in it are neighbours of each other. Equal points are one
*spot* with a weight. A cell with at least ``min_samples`` points is *dense*: all its points are core
points of one cluster, so they are never compared with each other. What is left to find out,

* which points of thin cells have enough neighbours, and
* which cells with core points touch,

is decided from the bounding boxes of cells where possible. A box that is partly in reach is split into
smaller boxes, and points are compared only when few are left in a box. No step pairs the points of a
crowded cell with those of another one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import product
from operator import add

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.ordinal import with_ordinal
from tidemark.ml.components import components
from tidemark.ml.features import standardized
from tidemark.session import in_parallel, settle

MAX_FEATURES = 6  # neighbour blocks grow as 3^features
FEW_SPOTS = 32  # boxes up to this size are compared point by point
SPLIT = 4  # a box is split into this many parts per axis


class _Grid:
    """Column expressions for points ``x0..`` and boxes ``lo0.., hi0..`` of a grid."""

    def __init__(self, eps: float, dims: int):
        self.eps, self.dims = eps, dims
        self.axes = range(dims)
        # A hair smaller, so that rounding cannot put two points of a cell out of reach.
        self.side = eps / math.sqrt(dims) * (1 - 1e-9)
        self.reach = int(math.floor(eps / self.side)) + 1  # cells this far apart may still touch

    def coordinates(self) -> list[str]:
        return [f"x{i}" for i in self.axes]

    def cell(self, level: int = 0) -> Column:
        """The cell of a point, or its part at a deeper level."""
        width = self.side / SPLIT**level
        return F.array(*[F.floor(F.col(f"x{i}") / F.lit(width)) for i in self.axes])

    def box(self) -> list[Column]:
        """Aggregates: points, spots and bounding box of a group of spots."""
        sizes = [F.sum("w").alias("n"), F.count(F.lit(1)).alias("m")]
        edges = [(F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}")) for i in self.axes]
        return sizes + [column for pair in edges for column in pair]

    def point_box(self, of: str) -> list[Column]:
        """A point as a box of no size."""
        return [F.col(f"x{i}").alias(f"{side}{i}_{of}") for i in self.axes for side in ("lo", "hi")]

    def named(self, of: str) -> list[Column]:
        """The columns of a box, marked as the box of one side of a pair."""
        names = ["n", "m", *[f"{side}{i}" for i in self.axes for side in ("lo", "hi")]]
        return [F.col(name).alias(f"{name}_{of}") for name in names]

    def nearest(self) -> Column:
        """Squared distance of the closest places of boxes a and b."""
        gaps = [
            F.greatest(
                F.lit(0.0), F.col(f"lo{i}_b") - F.col(f"hi{i}_a"), F.col(f"lo{i}_a") - F.col(f"hi{i}_b")
            )
            for i in self.axes
        ]
        return reduce(add, [gap * gap for gap in gaps])

    def furthest(self) -> Column:
        """Squared distance of the most distant places of boxes a and b."""
        spans = [
            F.greatest(F.col(f"hi{i}_b") - F.col(f"lo{i}_a"), F.col(f"hi{i}_a") - F.col(f"lo{i}_b"))
            for i in self.axes
        ]
        return reduce(add, [span * span for span in spans])

    def within(self, squared: Column) -> Column:
        return squared <= F.lit(self.eps * self.eps)

    def points_near(self, one: str, other: str) -> Column:
        """Whether the points whose coordinates carry these suffixes are neighbours."""
        steps = [F.col(f"x{i}{one}") - F.col(f"x{i}{other}") for i in self.axes]
        return self.within(reduce(add, [step * step for step in steps]))


def _cell_pairs(cells: DataFrame, grid: _Grid) -> DataFrame:
    """Ordered pairs (a, b) of different cells whose boxes are in reach, found by blocks of cells."""
    block = F.transform("cell", lambda c: F.floor(c / F.lit(grid.reach)))
    sided = cells.withColumn("block", block)
    steps = F.array(*[F.array(*[F.lit(s).cast("bigint") for s in step]) for step in product((-1, 0, 1), repeat=grid.dims)])
    around = F.transform(steps, lambda step: F.zip_with(step, F.col("block"), lambda s, b: s + b))
    left = sided.select(F.col("cell").alias("cell_a"), *grid.named("a"), F.explode(around).alias("block"))
    right = sided.select(F.col("cell").alias("cell_b"), *grid.named("b"), "block")
    return (
        left.join(right, "block")
        .filter((F.col("cell_a") != F.col("cell_b")) & grid.within(grid.nearest()))
        .drop("block")
    )


def _parts(spots: DataFrame, grid: _Grid, level: int, of: str) -> DataFrame:
    """The boxes that cells are split into at a level: (cell_of, part_of, whole_of, box)."""
    parent = F.transform(f"part_{of}", lambda p: F.floor(p / F.lit(SPLIT)))
    return (
        spots.groupBy(F.col("cell").alias(f"cell_{of}"), grid.cell(level).alias(f"part_{of}"))
        .agg(*grid.box())
        .select(f"cell_{of}", f"part_{of}", parent.alias(f"whole_{of}"), *grid.named(of))
    )


def _spots_of_parts(spots: DataFrame, grid: _Grid, level: int, of: str) -> DataFrame:
    """The spots of the boxes of a level: (cell_of, part_of, x0_of.., w_of)."""
    return spots.select(
        F.col("cell").alias(f"cell_{of}"),
        grid.cell(level).alias(f"part_{of}"),
        F.col("w").alias(f"w_{of}"),
        *[F.col(f"x{i}").alias(f"x{i}_{of}") for i in grid.axes],
    )


def _touching_points(thin: DataFrame, dense: DataFrame, pairs: DataFrame, grid: _Grid) -> DataFrame:
    """(x0.., cell_b, hits): how many points of each dense cell are neighbours of each thin-cell spot."""
    xs = grid.coordinates()
    near_dense = pairs.filter("dense_b").select("cell_a", "cell_b", *[c for c in pairs.columns if c.endswith("_b") and c not in ("cell_b", "dense_b")])
    frontier = (
        thin.select(*xs, F.col("cell").alias("cell_a"), *grid.point_box("a"))
        .join(near_dense, "cell_a")
        .withColumn("part_b", F.col("cell_b"))
        .drop("cell_a")
    )
    found = []
    level, close = 0, dense.filter(F.col("m_cell") <= FEW_SPOTS)
    while True:
        frontier = settle(frontier.filter(grid.within(grid.nearest())).withColumn("inside", grid.within(grid.furthest())))
        found.append(frontier.filter("inside").select(*xs, "cell_b", F.col("n_b").alias("hits")))
        open_ = frontier.filter("NOT inside")
        few = open_.filter(F.col("m_b") <= FEW_SPOTS).select(*xs, "cell_b", "part_b")
        compared = few.join(_spots_of_parts(close, grid, level, "b"), ["cell_b", "part_b"]).filter(
            grid.points_near("", "_b")
        )
        found.append(compared.select(*xs, "cell_b", F.col("w_b").alias("hits")))
        many = open_.filter(F.col("m_b") > FEW_SPOTS)
        if not many.take(1):
            break
        level += 1
        close = dense.join(many.select(F.col("cell_b").alias("cell")).distinct(), "cell", "left_semi")
        frontier = (
            many.select(*xs, *[f"{s}{i}_a" for i in grid.axes for s in ("lo", "hi")], "cell_b", F.col("part_b").alias("whole_b"))
            .join(_parts(close, grid, level, "b"), ["cell_b", "whole_b"])
            .drop("whole_b")
        )
    hits = reduce(DataFrame.unionByName, found)
    return settle(hits.groupBy(*xs, "cell_b").agg(F.sum("hits").alias("hits")))


def _touching_dense(dense: DataFrame, undecided: DataFrame, grid: _Grid) -> DataFrame:
    """(cell_a, cell_b) of the undecided pairs of dense cells that have two points in reach."""
    boxes = [f"{s}{i}_{o}" for o in ("a", "b") for i in grid.axes for s in ("lo", "hi")]
    frontier = undecided.select("cell_a", "cell_b", "m_a", "m_b", *boxes).withColumns(
        {"part_a": F.col("cell_a"), "part_b": F.col("cell_b")}
    )
    found = []
    level = 0
    close = {of: dense.filter(F.col("m_cell") <= FEW_SPOTS) for of in ("a", "b")}
    while True:
        frontier = settle(frontier.filter(grid.within(grid.nearest())).withColumn("inside", grid.within(grid.furthest())))
        open_ = frontier.filter("NOT inside")
        few = (F.col("m_a") <= FEW_SPOTS) & (F.col("m_b") <= FEW_SPOTS)
        compared = (
            open_.filter(few)
            .select("cell_a", "part_a", "cell_b", "part_b")
            .join(_spots_of_parts(close["a"], grid, level, "a"), ["cell_a", "part_a"])
            .join(_spots_of_parts(close["b"], grid, level, "b"), ["cell_b", "part_b"])
            .filter(grid.points_near("_a", "_b"))
        )
        touching = settle(
            frontier.filter("inside").select("cell_a", "cell_b").unionByName(compared.select("cell_a", "cell_b")).distinct()
        )
        found.append(touching)
        many = settle(open_.filter(~few).join(touching, ["cell_a", "cell_b"], "left_anti"))
        if not many.take(1):
            return reduce(DataFrame.unionByName, found)
        level += 1
        close = {
            of: dense.join(many.select(F.col(f"cell_{of}").alias("cell")).distinct(), "cell", "left_semi")
            for of in ("a", "b")
        }
        frontier = (
            many.select("cell_a", "cell_b", F.col("part_a").alias("whole_a"), F.col("part_b").alias("whole_b"))
            .join(_parts(close["a"], grid, level, "a"), ["cell_a", "whole_a"])
            .join(_parts(close["b"], grid, level, "b"), ["cell_b", "whole_b"])
            .drop("whole_a", "whole_b")
        )


def _located(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """The rows, each in a struct ``row``, with their ``key`` and coordinates ``x0..``: no column can clash with these."""
    if not 1 <= len(features) <= MAX_FEATURES:
        raise ValueError(f"1 to {MAX_FEATURES} features are supported, not {len(features)}")
    # Adding 0.0 turns -0.0 into 0.0, so that equal points have equal keys.
    places = [(F.col(name).cast("double") + F.lit(0.0)).alias(f"x{i}") for i, name in enumerate(features)]
    row = F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")
    return df.dropna(subset=list(features)).select(row, F.col(key).alias("key"), *places)


def _spots(located: DataFrame, dims: int) -> DataFrame:
    """Distinct points, their weight and the smallest key among their rows."""
    xs = [f"x{i}" for i in range(dims)]
    return settle(located.groupBy(*xs).agg(F.count(F.lit(1)).alias("w"), F.min("key").alias("first")))


def _spot_clusters(places: DataFrame, dims: int, eps: float, min_samples: int, output: str) -> DataFrame:
    """The cluster of every spot: (x0.., w, output)."""
    grid = _Grid(eps, dims)
    xs = grid.coordinates()
    spots = places.withColumn("cell", grid.cell())
    cells = settle(spots.groupBy("cell").agg(*grid.box(), F.min("first").alias("first")))
    sizes = cells.select("cell", F.col("n").alias("n_cell"), F.col("m").alias("m_cell"))
    placed = settle(spots.join(sizes, "cell"))
    dense, thin = placed.filter(F.col("n_cell") >= min_samples), placed.filter(F.col("n_cell") < min_samples)
    dense_cells = cells.filter(F.col("n") >= min_samples).select("cell", F.col("first").alias("node"))
    pairs = settle(
        _cell_pairs(cells, grid).withColumns(
            {"dense_a": F.col("n_a") >= min_samples, "dense_b": F.col("n_b") >= min_samples}
        )
    )

    # Neighbours of the spots in thin cells; such a cell has fewer than min_samples points.
    touching = _touching_points(thin, dense, pairs.filter("NOT dense_a"), grid)
    side = lambda of: thin.select(
        F.col("cell").alias(f"cell_{of}"), F.col("w").alias(f"w_{of}"), *[F.col(x).alias(f"{x}_{of}") for x in xs]
    )
    near = settle(
        pairs.filter("NOT dense_a AND NOT dense_b")
        .select("cell_a", "cell_b")
        .join(side("a"), "cell_a")
        .join(side("b"), "cell_b")
        .filter(grid.points_near("_a", "_b"))
    )
    of_a, of_b = [F.col(f"{x}_a").alias(x) for x in xs], [F.col(f"{x}_b").alias(x) for x in xs]
    counts = (
        touching.select(*xs, "hits")
        .unionByName(near.select(*of_a, F.col("w_b").alias("hits")))
        .unionByName(thin.select(*xs, F.col("n_cell").alias("hits")))
        .groupBy(*xs)
        .agg(F.sum("hits").alias("hits"))
    )
    thin_core = settle(thin.join(counts.filter(F.col("hits") >= min_samples), xs).select(*xs, "cell", "first"))

    # Cells with core points are the nodes, named by the smallest key of a core point.
    nodes = settle(
        dense_cells.unionByName(thin_core.groupBy("cell").agg(F.min("first").alias("node")))
    )
    dense_pairs = pairs.filter("dense_a AND dense_b AND cell_a < cell_b")
    sure = dense_pairs.filter(grid.within(grid.furthest())).select("cell_a", "cell_b")
    core = thin_core.select(*xs)
    thin_dense = touching.join(thin_core.select(*xs, F.col("cell").alias("cell_a")), xs).select("cell_a", "cell_b")
    thin_thin = (
        near.join(core.select(*[F.col(x).alias(f"{x}_a") for x in xs]), [f"{x}_a" for x in xs], "left_semi")
        .join(core.select(*[F.col(x).alias(f"{x}_b") for x in xs]), [f"{x}_b" for x in xs], "left_semi")
        .select("cell_a", "cell_b")
    )
    names = nodes.select("cell", "node")

    def edges_of(cell_edges: DataFrame) -> DataFrame:
        return (
            cell_edges.join(names.select(F.col("cell").alias("cell_a"), F.col("node").alias("u")), "cell_a")
            .join(names.select(F.col("cell").alias("cell_b"), F.col("node").alias("v")), "cell_b")
            .select("u", "v")
        )

    first_edges = settle(edges_of(sure.unionByName(thin_dense).unionByName(thin_thin)).distinct())
    joined = components(nodes, first_edges)
    # Only dense cells still apart need a closer look.
    apart = nodes.join(joined, "node").select("cell", "label")
    undecided = (
        dense_pairs.filter(~grid.within(grid.furthest()))
        .join(apart.select(F.col("cell").alias("cell_a"), F.col("label").alias("la")), "cell_a")
        .join(apart.select(F.col("cell").alias("cell_b"), F.col("label").alias("lb")), "cell_b")
        .filter("la <> lb")
    )
    undecided = settle(undecided)
    if undecided.take(1):
        of_u, of_v = (joined.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")) for end in ("u", "v"))
        more = edges_of(_touching_dense(dense, undecided, grid)).join(of_u, "u").join(of_v, "v")
        merged = components(
            joined.select(F.col("label").alias("node")).distinct(),
            more.select(F.col("lu").alias("u"), F.col("lv").alias("v")),
        )
        merged = merged.select(F.col("node").alias("label"), F.col("label").alias("top"))
        joined = joined.join(merged, "label").select("node", F.col("top").alias("label"))

    # Numbers of the clusters in the order of their smallest core key, which is the label itself.
    numbers = with_ordinal(joined.select("label").distinct(), ["label"], "number")
    numbered = settle(
        nodes.join(joined, "node").join(numbers, "label").select("cell", F.col("number").cast("int").alias("number"))
    )
    border = (
        touching.join(numbered.withColumnRenamed("cell", "cell_b"), "cell_b").select(*xs, "number")
        .unionByName(
            near.join(thin_core.select(*[F.col(x).alias(f"{x}_b") for x in xs]), [f"{x}_b" for x in xs])
            .join(numbered.withColumnRenamed("cell", "cell_b"), "cell_b")
            .select(*of_a, "number")
        )
        .unionByName(thin.join(numbered, "cell").select(*xs, "number"))
        .groupBy(*xs)
        .agg(F.min("number").alias("number"))
    )
    core_numbers = thin_core.join(numbered, "cell").select(*xs, F.col("number").alias("own"))
    thin_numbers = (
        thin.select(*xs, "w")
        .join(border, xs, "left")
        .join(core_numbers, xs, "left")
        .select(*xs, "w", F.coalesce("own", "number", F.lit(-1)).alias(output))
    )
    dense_numbers = dense.join(numbered, "cell").select(*xs, "w", F.col("number").alias(output))
    return settle(dense_numbers.unionByName(thin_numbers))


def dbscan(
    df: DataFrame, features: Sequence[str], *, key: str, eps: float, min_samples: int, output: str = "cluster"
) -> DataFrame:
    """All columns and the cluster of each row, -1 for noise.

    ``features`` are columns on a common scale (see ``dbscan_standardized``) and ``key`` names every
    row. Clusters are numbered by the smallest key of their core points; a border point between
    clusters joins the one with the smallest number.
    """
    located, dims = _located(df, features, key), len(features)
    return _labelled(located, _spot_clusters(_spots(located, dims), dims, eps, min_samples, "cluster"), dims, output)


def _labelled(located: DataFrame, clusters: DataFrame, dims: int, output: str) -> DataFrame:
    """The rows with their cluster; a column of that name is replaced."""
    names = [name for name in located.schema["row"].dataType.fieldNames() if name != output]
    found = located.join(clusters.drop("w"), [f"x{i}" for i in range(dims)])
    return found.select(*[F.col("row")[name].alias(name) for name in names], F.col("cluster").alias(output))


def dbscan_standardized(
    df: DataFrame, features: Sequence[str], *, key: str, eps: float, min_samples: int, output: str = "cluster"
) -> DataFrame:
    """``dbscan`` on standardised features; the scaled columns stay as ``z_<feature>``."""
    scaled = settle(standardized(df, features))
    return dbscan(
        scaled, [f"z_{name}" for name in features], key=key, eps=eps, min_samples=min_samples, output=output
    )


def dbscan_search(
    df: DataFrame,
    features: Sequence[str],
    *,
    key: str,
    eps: Sequence[float] = fixed.DBSCAN_EPS,
    min_samples: Sequence[int] = fixed.DBSCAN_MIN_SAMPLES,
    threads: int = 8,
) -> tuple[DataFrame, dict[str, float]]:
    """The clustering with the best silhouette among those of two clusters or more, and its parameters.

    Noise counts as a class of its own. The silhouette uses squared distances, which Spark computes in
    one pass over the weighted spots; the usual one compares all pairs of points.
    """
    dims = len(features)
    located = _located(settle(standardized(df, features)), [f"z_{name}" for name in features], key)
    places = _spots(located, dims)
    vectors = VectorAssembler(inputCols=[f"x{i}" for i in range(dims)], outputCol="__features")
    silhouette = ClusteringEvaluator(featuresCol="__features", predictionCol="class", weightCol="w")

    def attempt(chosen: tuple[float, int]):
        clusters = _spot_clusters(places, dims, *chosen, "cluster")
        sizes = clusters.agg(
            F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("clusters"),
            F.sum(F.when(F.col("cluster") < 0, F.col("w")).otherwise(0)).alias("noise"),
        ).first()
        if sizes["clusters"] < 2:
            return None
        classes = vectors.transform(clusters).withColumn("class", F.col("cluster").cast("double"))
        found = {
            "eps": chosen[0], "min_samples": chosen[1], "n_clusters": sizes["clusters"], "n_noise": sizes["noise"],
            "silhouette": silhouette.evaluate(classes.withColumn("w", F.col("w").cast("double"))),
        }
        return clusters, found

    tried = [one for one in in_parallel(attempt, list(product(eps, min_samples)), threads) if one]
    if not tried:
        raise ValueError("no parameters tried gave two clusters")
    clusters, chosen = max(tried, key=lambda one: one[1]["silhouette"])
    return _labelled(located, clusters, dims, "cluster"), chosen
