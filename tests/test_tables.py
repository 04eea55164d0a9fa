"""Profiles, chart data, features, models and metrics on small tables."""

import datetime
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.functions.columns import box_centre_axis, point_axis, post_time, whole_words
from tidemark.ml import cluster, features, metrics, supervised
from tidemark.operators import charts, profile


def test_column_profile(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (9.0, None), (None, "a")], "n double, t string")
    row = profile.column_profile(df, "n").first()
    assert (row["total_rows"], row["filled"], row["empty"], row["distinct_values"]) == (4, 3, 1, 3)
    assert (row["min"], row["max"], row["mean"], row["median"]) == (1.0, 9.0, 4.0, 2.0)
    assert profile.column_profile(df, "t").first()["distinct_values"] == 2
    assert profile.column_profile(df, "n", exact=False).first()["median"] == 2.0
    assert [r["value"] for r in profile.distinct_examples(df, "t").collect()] == ["a", "b"]
    long = spark.createDataFrame([("x" * 101,), ("y" * 100,)], "t string")
    assert [r["value"] for r in profile.distinct_examples(long, "t").collect()] == ["x" * 100 + "...", "y" * 100]


def test_searches(spark):
    df = spark.createDataFrame([(1, "Ab", None), (2, "b", "xAy"), (3, None, "q")], "id int, t string, u string")
    hits = profile.search_column(df, "t", "B", key="id", n=1).collect()
    assert [(r["id"], r["total_hits"]) for r in hits] == [(1, 2)]
    assert profile.search_column(df, "id", 3, key="id").first()["id"] == 3
    assert sorted(r["id"] for r in profile.search_text(df, "^a|xa").collect()) == [1, 2]


def test_sample_is_stable(spark):
    df = spark.range(1000)
    one, two = (
        [r["id"] for r in profile.sample_rows(d, key="id", n=20).collect()] for d in (df, df.repartition(9))
    )
    assert one == two and len(set(one)) == 20
    assert [r["id"] for r in profile.sample_rows(df, key="id", n=20, seed=7).collect()] != one


def test_stats_and_info(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", None)], "n int, t string, d date")
    stats = profile.result_stats(df).first()
    assert tuple(stats) == (2, 3, 3, 1, 1)
    info = profile.table_info(df).collect()
    assert [(r["position"], r["column_name"], r["data_type"], r["total_rows"]) for r in info] == [
        (1, "n", "int", 2), (2, "t", "string", 2), (3, "d", "date", 2),
    ]


def test_chart_data(spark):
    day = datetime.datetime
    df = spark.createDataFrame(
        [(day(2020, 1, 2, 5), "a", 1.0), (day(2020, 1, 2, 9), None, 2.0), (None, "b", 4.0), (day(2020, 1, 1), "a", None)],
        "ts timestamp, t string, v double",
    )
    first, second = datetime.date(2020, 1, 1), datetime.date(2020, 1, 2)
    assert [tuple(r) for r in charts.chart_data(df, "ts").collect()] == [(first, 1), (second, 2)]
    assert [tuple(r) for r in charts.chart_data(df, "ts", "v").collect()] == [(first, 0.0), (second, 3.0)]
    assert charts.chart_data(df, "ts", "t").columns == ["ts", "Conteggio_t"]
    assert [tuple(r) for r in charts.chart_data(df, "t").collect()] == [("a", 2), ("b", 1)]
    assert sorted(tuple(r) for r in charts.chart_data(df, "t", "v").collect()) == [("a", 1.0), ("b", 4.0)]
    assert charts.chart_data(df, "v", "t").count() == 2


def test_chart_cuts(spark):
    df = spark.range(600).select(F.format_string("k%03d", "id").alias("x"), (F.col("id") % 300).alias("y"))
    assert charts.bar_points(df, "x", "y").count() == 500
    assert charts.line_points(df, "x", "y").first()["x"] == "k599"
    slices = charts.pie_slices(df.withColumn("c", F.col("y") % 11), "c", "y").collect()
    assert len(slices) == 10
    assert charts.pie_slices(df.withColumn("c", F.col("y") % 11), "c").count() == 11


@pytest.mark.parametrize("values, kind", [(50, "crosstab"), (51, "density")])
def test_heat_map_kind(spark, values, kind):
    df = spark.range(200).select((F.col("id") % values).alias("x"), (F.col("id") % 3).alias("y"))
    found = charts.heat_map(df, "x", "y")
    assert ("x_bin" in found.columns) == (kind == "density")
    total = found.agg(F.sum("n")).first()[0] if kind == "density" else sum(sum(r[1:]) for r in found.collect())
    assert total == 200


def test_density_of_one_value(spark):
    df = spark.range(5).select(F.lit(3.0).alias("x"), F.col("id").alias("y"))
    assert {(r["x_bin"], r["y_bin"]) for r in charts.density(df, "x", "y").collect()} == {(0, 0), (0, 12), (0, 25), (0, 37), (0, 49)}


def test_column_functions(spark):
    df = spark.createDataFrame(
        [("[1.5, -2]", "[[[0, 0], [0, 4], [6, 4]]]", "Sat Aug 26 21:39:07 +0000 2017"), ("nonsense", None, "xx")],
        "p string, b string, t string",
    )
    rows = df.select(
        point_axis(F.col("p"), 0), point_axis(F.col("p"), 1), box_centre_axis(F.col("b"), 0),
        box_centre_axis(F.col("b"), 1), post_time(F.col("t")),
    ).collect()
    assert tuple(rows[0]) == (1.5, -2.0, 3.0, 2.0, datetime.datetime(2017, 8, 26, 21, 39, 7))
    assert tuple(rows[1]) == (None,) * 5
    words = spark.createDataFrame([("sos!",), ("ésos",), ("#fay",), ("x sosa",)], "t string")
    assert [r[0] for r in words.select(F.col("t").rlike(whole_words(["sos", "#fay"]))).collect()] == [True, False, True, False]


def test_supervised_features(spark):
    rows = [(float(i), True, "t", 1) for i in range(60)] + [(math.inf, False, "u", 0), (math.nan, True, "u", 0), (None, True, "u", 0)]
    df = spark.createDataFrame(rows, "n double, b boolean, t string, y int")
    ready = features.supervised_features(df, ["n", "b", "t"], "y")
    assert ready.count() == 62
    odd = ready.filter("y = 0").select(vector_to_array("features").alias("f")).collect()
    assert all(r["f"][0] == 0.0 and len(r["f"]) == 258 for r in odd)
    with pytest.raises(ValueError):
        features.supervised_features(df.limit(49), ["n"], "y")
    with pytest.raises(ValueError):
        features.supervised_features(df, ["gone"], "y")


def test_cluster_features_and_codes(spark):
    df = spark.createDataFrame([("b", 1)] * 5 + [("a", 2)] * 5 + [("c", 3)] * 6 + [(None, 4)], "t string, n int")
    ready = features.cluster_features(df, ["t", "n"]).select("t", vector_to_array("features").alias("f")).distinct()
    assert {r["t"]: r["f"][0] for r in ready.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}
    with pytest.raises(ValueError):
        features.cluster_features(df.limit(9), ["n"])


def test_standardized_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0, "b"), (3.0, 5.0, "a"), (None, 5.0, "a")], "x double, c double, t string")
    rows = features.standardized(df, ["x", "c", "t"]).orderBy("x").collect()
    assert [(r["z_x"], r["z_c"], r["z_t"]) for r in rows] == [(-1.0, 0.0, 1.0), (1.0, 0.0, -1.0)]


def test_k_means_finds_three_groups(spark):
    rows = [(float(g * 100 + i % 7), float(g * 50 - i % 5), f"r{g}") for g in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "x double, y double, name string")
    for search in (cluster.k_means, cluster.bisecting_k_means):
        found = search(df, ["x", "y"], max_k=5)
        assert found.k == 3 and found.silhouette == max(found.scores.values())
        members = cluster.cluster_members(found.rows, ["x", "y"])
        assert members.columns == ["x", "y", "Cluster", "name"]
        assert members.groupBy("name").agg(F.count_distinct("Cluster").alias("n")).filter("n > 1").count() == 0


def test_noise_has_a_name(spark):
    rows = cluster.cluster_members(spark.createDataFrame([(1.0, -1), (2.0, 0)], "x double, cluster int"), ["x"])
    assert [r["Cluster"] for r in rows.orderBy("x").collect()] == ["Noise", "0"]


def learnable(spark, n=300):
    return spark.range(n).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 3).alias("b"),
        (F.col("id") % 17 > 8).cast("int").alias("y"),
    )


def test_forest_and_boosting_use_their_grid(spark):
    forest = supervised.random_forest(learnable(spark), ["a", "b"], "y", key="id", trees=(3, 7), depths=(2,))
    assert forest.score > 0.95 and forest.model.getNumTrees == forest.parameters["numTrees"] in (3, 7)
    assert forest.model.numClasses == 2
    boosted = supervised.boosted_trees(learnable(spark), ["a", "b"], "y", key="id", rounds=(3,), depths=(2,))
    assert boosted.score > 0.95
    matrix = metrics.confusion_matrix(boosted.predictions, [0.0, 1.0]).collect()
    assert sum(sum(r[1:]) for r in matrix) == boosted.predictions.count()


def test_linear_regression_and_kind_mismatch(spark):
    df = learnable(spark).withColumn("target", F.col("a") * 3 + F.col("id"))
    fitted = supervised.linear_regression(df, ["a", "id"], "target", key="id")
    assert fitted.score < 1.0
    for wrong in (
        lambda: supervised.linear_regression(df, ["a"], "y"),
        lambda: supervised.random_forest(df, ["a"], "target"),
    ):
        with pytest.raises(ValueError):
            wrong()


@pytest.mark.parametrize("values, kind", [(1, "regression"), (2, "classification"), (10, "classification"), (11, "regression")])
def test_problem_kind(spark, values, kind):
    df = spark.range(40).select((F.col("id") % values).alias("y"))
    assert supervised.problem_kind(df, "y").first()["kind"] == kind


def test_split_sides(spark):
    for key in ("id", None):
        train, test = supervised.split(spark.range(500), key=key)
        assert train.count() + test.count() == 500 and train.intersect(test).count() == 0
        assert 350 < train.count() < 450
    assert 50 < supervised.split(spark.range(90), key="id")[0].count() < 76
    with pytest.raises(ValueError):
        supervised.split(spark.range(12), key="id")


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(2, 0)] * 2
    df = spark.createDataFrame(pairs, "label int, prediction int")
    report = {r["Class"]: r for r in metrics.classification_report(df).collect()}
    assert (report[0]["Precision"], report[0]["Recall"], report[0]["Support"]) == (0.6, 0.75, 4)
    assert (report[2]["Precision"], report[2]["Recall"], report[2]["F1"]) == (0.0, 0.0, 0.0)
    scores = metrics.classification_scores(df).first()
    assert scores["accuracy"] == 5 / 8
    numbers = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    assert tuple(metrics.regression_metrics(numbers).first()) == (0.5, 0.5, 0.5)
    same = spark.createDataFrame([(1.0, 2.0)], "label double, prediction double")
    assert metrics.regression_metrics(same).first()["r2"] is None
