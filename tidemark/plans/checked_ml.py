"""Registered machine learning (M): features, models, clusters, anomalies and their tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.ml import cluster, dbscan, features, isolation, metrics, supervised
from tidemark.operators import reports
from tidemark.plans.checked_reports import PHRASES, TEXTS, URGENCY
from tidemark.plans.posts import posts, table
from tidemark.plans.registry import ORACLES, checked
from tidemark.session import settle

CUSTOMER_FEATURES = ["c_acctbal", "c_nationkey"]
HELP_FEATURES = ["Latitude", "Longitude", "PunteggioUrgenza"]


def stored(rows: DataFrame) -> DataFrame:
    """A training table, made once: models pass over it many times. Its order means nothing."""
    return settle(rows.hint("rebalance"))


def viral_set(spark, sf_dir) -> DataFrame:
    return stored(reports.viral_labels(posts(spark, sf_dir)))


def help_set(spark, sf_dir) -> DataFrame:
    """The help requests without their texts, which no model here reads."""
    found = reports.help_requests(
        posts(spark, sf_dir), phrases=PHRASES, urgency=URGENCY, need_point=False, text_fields=TEXTS
    )
    return stored(found.select(*HELP_FEATURES, "Utente"))


def scored_table(result: supervised.Fitted) -> DataFrame:
    """Label and prediction of the rows held out, with the chosen parameters and the score."""
    chosen = ", ".join(f"{name}={value}" for name, value in sorted(result.parameters.items()))
    return result.predictions.select(
        "label", "prediction", F.lit(chosen).alias("parameters"), F.lit(float(result.score)).alias("score")
    )


@checked("m1_cluster_features")
def m1(spark, sf_dir):
    ready = features.cluster_features(help_set(spark, sf_dir), [*HELP_FEATURES, "Utente"])
    return ready.select(*HELP_FEATURES, "Utente", vector_to_array("features").alias("features"))


@checked(
    "m1b_text_numbers",
    """
    WITH ranked AS (
      SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS code
      FROM events GROUP BY event_type)
    SELECT event_id, CAST(code AS double) AS type_code FROM events JOIN ranked USING (event_type)
    """,
)
def m1b(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return features.encode_text(rows, "event_type", "type_code", by_frequency=True).select("event_id", "type_code")


@checked("m2_supervised_features")
def m2(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("rich", (F.col("c_acctbal") > 5000).cast("int"))
    ready = features.supervised_features(rows, ["c_nationkey", "c_mktsegment"], "rich")
    return ready.select("c_custkey", "rich", vector_to_array("features").alias("features"))


@checked("m3_k_means")
def m3(spark, sf_dir):
    found = cluster.k_means(help_set(spark, sf_dir), HELP_FEATURES)
    return found.rows.select(*HELP_FEATURES, "cluster", F.lit(found.k).alias("k"), F.lit(found.silhouette).alias("silhouette"))


@checked("m4_bisecting_k_means")
def m4(spark, sf_dir):
    found = cluster.bisecting_k_means(help_set(spark, sf_dir), HELP_FEATURES)
    return found.rows.select(*HELP_FEATURES, "cluster", F.lit(found.k).alias("k"), F.lit(found.silhouette).alias("silhouette"))


@checked("m5_random_forest")
def m5(spark, sf_dir):
    return scored_table(
        supervised.random_forest(viral_set(spark, sf_dir), ["Followers", "is_verified"], "is_viral", key="tweet_id")
    )


@checked("m6_boosted_trees")
def m6(spark, sf_dir):
    return scored_table(
        supervised.boosted_trees(viral_set(spark, sf_dir), ["Followers", "is_verified"], "is_viral", key="tweet_id")
    )


@checked("m7_linear_regression")
def m7(spark, sf_dir):
    names = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), *names, "l_extendedprice")
    return scored_table(supervised.linear_regression(rows, names, "l_extendedprice", key="line"))


@checked(
    "m8_problem_kind",
    """
    SELECT 'quality' AS target, true AS is_numeric, count(DISTINCT quality) AS distinct_values,
      CASE WHEN count(DISTINCT quality) BETWEEN 2 AND 10 THEN 'classification' ELSE 'regression' END AS kind FROM labels
    UNION ALL SELECT 'value', true, count(DISTINCT value), CASE WHEN count(DISTINCT value) BETWEEN 2 AND 10
      THEN 'classification' ELSE 'regression' END FROM events
    UNION ALL SELECT 'event_type', false, count(DISTINCT event_type), 'classification' FROM events
    """,
)
def m8(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    kinds = supervised.problem_kind(table(spark, sf_dir, "labels"), "quality")
    return kinds.unionByName(supervised.problem_kind(events, "value")).unionByName(
        supervised.problem_kind(events, "event_type")
    )


@checked(
    "m9_split",
    """
    SELECT event_id, CASE WHEN md5(event_id || ':42') < (SELECT CASE WHEN count(*) < 100 THEN 'b3333333' ELSE 'cccccccd' END FROM events)
      THEN 'train' ELSE 'test' END AS side FROM events
    """,
)
def m9(spark, sf_dir):
    train, test = supervised.split(table(spark, sf_dir, "events").select("event_id"), key="event_id")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


DBSCAN_SQL = """
WITH RECURSIVE scale AS (
  SELECT avg(c_acctbal) AS mx, stddev_pop(c_acctbal) AS sx, avg(c_nationkey) AS my, stddev_pop(c_nationkey) AS sy
  FROM customer),
pts AS (SELECT c_custkey AS id, (c_acctbal - mx) / sx AS x, (c_nationkey - my) / sy AS y FROM customer, scale),
near AS (SELECT a.id, b.id AS other FROM pts a JOIN pts b
  ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {eps} * {eps}),
core AS (SELECT id FROM near GROUP BY id HAVING count(*) >= {least}),
links AS (SELECT n.id, n.other FROM near n JOIN core c ON n.id = c.id JOIN core d ON n.other = d.id),
reach(node, root) AS (
  SELECT id, id FROM core
  UNION
  SELECT l.other, r.root FROM reach r JOIN links l ON l.id = r.node WHERE r.root < l.other),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
numbers AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS num FROM (SELECT DISTINCT root FROM roots)),
own AS (SELECT node, num FROM roots JOIN numbers USING (root)),
border AS (SELECT n.id, min(o.num) AS num FROM near n JOIN own o ON n.other = o.node GROUP BY n.id)
SELECT p.id AS c_custkey, CAST(coalesce(o.num, b.num, -1) AS integer) AS cluster
FROM pts p LEFT JOIN own o ON o.node = p.id LEFT JOIN border b ON b.id = p.id
"""


@checked("m10_dbscan", DBSCAN_SQL.format(eps=0.1, least=4))
def m10(spark, sf_dir):
    rows = dbscan.dbscan_standardized(
        table(spark, sf_dir, "customer"), CUSTOMER_FEATURES, key="c_custkey", eps=0.1, min_samples=4
    )
    return rows.select("c_custkey", "cluster")


@checked("m10b_dbscan_search")
def m10b(spark, sf_dir):
    places = help_set(spark, sf_dir).select(*HELP_FEATURES).distinct()
    named = places.withColumn("place", F.concat_ws("/", *HELP_FEATURES))
    rows, chosen = dbscan.dbscan_search(named, HELP_FEATURES, key="place")
    return rows.select(
        *HELP_FEATURES, "cluster", *[F.lit(value).alias(name) for name, value in sorted(chosen.items())]
    )


@checked("m11_isolation_forest")
def m11(spark, sf_dir):
    volume = reports.volume_by_minute(posts(spark, sf_dir)).withColumn("minute", F.concat_ws(" ", "Data", "Orario"))
    return isolation.isolation_forest(volume, ["Data", "Orario", "Volume_Tweet"], key="minute")


@checked(
    "m12_standardized",
    """
    WITH codes AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code
        FROM (SELECT DISTINCT event_type FROM events)),
    coded AS (SELECT event_id, value, CAST(code AS double) AS code FROM events JOIN codes USING (event_type))
    SELECT event_id, round((value - (SELECT avg(value) FROM coded)) / (SELECT stddev_pop(value) FROM coded), 6) AS z_value,
      round((code - (SELECT avg(code) FROM coded)) / (SELECT stddev_pop(code) FROM coded), 6) AS z_event_type
    FROM coded
    """,
)
def m12(spark, sf_dir):
    rows = features.standardized(table(spark, sf_dir, "events"), ["value", "event_type"])
    return rows.select("event_id", F.round("z_value", 6).alias("z_value"), F.round("z_event_type", 6).alias("z_event_type"))


@checked(
    "m13_classification_report",
    """
    WITH classes AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels),
    t AS (SELECT c, count(*) FILTER (quality = c AND toxic = c) AS hits, count(*) FILTER (toxic = c) AS predicted,
        count(*) FILTER (quality = c) AS support FROM classes, labels GROUP BY c)
    SELECT c AS "Class", round(CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END, 9) AS "Precision",
      round(CASE WHEN support > 0 THEN hits / support ELSE 0 END, 9) AS "Recall",
      round(CASE WHEN predicted + support > 0 THEN 2 * hits / (predicted + support) ELSE 0 END, 9) AS "F1",
      support AS "Support" FROM t
    """,
)
def m13(spark, sf_dir):
    report = metrics.classification_report(table(spark, sf_dir, "labels"), "quality", "toxic")
    return report.withColumns({name: F.round(name, 9) for name in ("Precision", "Recall", "F1")})


@checked(
    "m13b_classification_scores",
    """
    WITH classes AS (SELECT DISTINCT quality AS c FROM labels),
    t AS (SELECT c, count(*) FILTER (quality = c AND toxic = c) AS hits, count(*) FILTER (toxic = c) AS predicted,
        count(*) FILTER (quality = c) AS support FROM classes, labels GROUP BY c)
    SELECT round(sum(hits) / sum(support), 9) AS accuracy,
      round(sum(2 * hits / (predicted + support) * support) / sum(support), 9) AS weighted_f1 FROM t
    """,
)
def m13b(spark, sf_dir):
    scores = metrics.classification_scores(table(spark, sf_dir, "labels"), "quality", "toxic")
    return scores.select(F.round("accuracy", 9).alias("accuracy"), F.round("weighted_f1", 9).alias("weighted_f1"))


@checked(
    "m14_confusion_matrix",
    """
    SELECT quality AS label, count(*) FILTER (toxic = 0) AS "0", count(*) FILTER (toxic = 1) AS "1"
    FROM labels GROUP BY quality
    """,
)
def m14(spark, sf_dir):
    return metrics.confusion_matrix(table(spark, sf_dir, "labels"), [0, 1], "quality", "toxic")


@checked(
    "m15_regression_metrics",
    """
    WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1400 AS f FROM lineitem)
    SELECT round(avg((y - f) * (y - f)), 2) AS mse, round(1 - avg((y - f) * (y - f)) / var_pop(y), 9) AS r2,
      round(avg(abs(y - f)), 4) AS mae FROM p
    """,
)
def m15(spark, sf_dir):
    guessed = table(spark, sf_dir, "lineitem").withColumn("guess", F.col("l_quantity") * 1400)
    found = metrics.regression_metrics(guessed, "l_extendedprice", "guess")
    return found.select(F.round("mse", 2).alias("mse"), F.round("r2", 9).alias("r2"), F.round("mae", 4).alias("mae"))


@checked(
    "m16_cluster_members",
    f"""
    SELECT c_acctbal, c_nationkey, CASE WHEN cluster = -1 THEN 'Noise' ELSE CAST(cluster AS varchar) END AS "Cluster", c_name
    FROM ({DBSCAN_SQL.format(eps=0.1, least=4)}) JOIN customer USING (c_custkey)
    """,
)
def m16(spark, sf_dir):
    rows = dbscan.dbscan_standardized(
        table(spark, sf_dir, "customer"), CUSTOMER_FEATURES, key="c_custkey", eps=0.1, min_samples=4
    )
    return cluster.cluster_members(rows, CUSTOMER_FEATURES)


@checked("m17_anomaly_table")
def m17(spark, sf_dir):
    return isolation.isolation_forest(table(spark, sf_dir, "customer"), ["c_acctbal", "c_nationkey", "c_mktsegment"], key="c_custkey")


HELP_SQL = ORACLES["q6b_help_requests_any_place"]
VIRAL_SQL = ORACLES["q9_viral_labels"]
#: Rows held out of a table with that many rows or more: the hash of the key lies above the training share.
HELD_OUT = "md5({key} || ':42') >= 'cccccccd'"


@checked(
    "m1c_feature_columns",
    f"""
    WITH help AS (SELECT * FROM ({HELP_SQL}) WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND "PunteggioUrgenza" IS NOT NULL AND "Utente" IS NOT NULL),
    codes AS (SELECT "Utente" AS u, row_number() OVER (ORDER BY count(*) DESC, "Utente") - 1 AS code FROM help GROUP BY "Utente")
    SELECT "Latitude", "Longitude", "Utente", CAST("PunteggioUrgenza" AS double) AS urgency, CAST(code AS double) AS author_code
    FROM help JOIN codes ON u = "Utente"
    """,
)
def m1c(spark, sf_dir):
    """The vector's parts as columns: numbers as they are, authors by falling frequency."""
    ready = features.cluster_features(help_set(spark, sf_dir), [*HELP_FEATURES, "Utente"])
    parts = ready.withColumn("parts", vector_to_array("features"))
    named = [F.col("parts")[i].alias(name) for i, name in enumerate(["Latitude", "Longitude", "urgency", "author_code"])]
    return parts.select("Utente", *named)


@checked(
    "m2b_feature_columns",
    """
    SELECT c_custkey, CAST(c_acctbal > 5000 AS integer) AS rich, CAST(c_nationkey AS double) AS nation, CAST(1 AS double) AS hashed,
      count(*) OVER (PARTITION BY c_mktsegment) AS of_segment
    FROM customer WHERE c_mktsegment IS NOT NULL AND c_nationkey IS NOT NULL
    """,
)
def m2b(spark, sf_dir):
    """The number first, then exactly one of the hashed places, the same for equal texts."""
    rows = table(spark, sf_dir, "customer").withColumn("rich", (F.col("c_acctbal") > 5000).cast("int"))
    ready = features.supervised_features(rows, ["c_nationkey", "c_mktsegment"], "rich")
    parts = ready.select("c_custkey", "rich", vector_to_array("features").alias("parts"))
    hashed = parts.select("c_custkey", "rich", F.col("parts")[0].alias("nation"), F.slice("parts", 2, 1 << 30).alias("places"))
    place = F.array_position("places", F.lit(1.0))
    counted = hashed.withColumn("place", place).withColumn("hashed", F.aggregate("places", F.lit(0.0), lambda a, x: a + x))
    sizes = counted.groupBy("place").agg(F.count("*").alias("of_segment"))
    return counted.join(sizes, "place").select("c_custkey", "rich", "nation", "hashed", "of_segment")


def _nearest_centres(found: cluster.Clusters) -> DataFrame:
    """Whether each row's cluster is that of the nearest mean of the clusters, one of k."""
    vectors = found.rows.withColumn("x", vector_to_array("features"))
    means = vectors.groupBy("cluster").agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(HELP_FEATURES))])
    centres = means.agg(F.collect_list(F.struct("cluster", F.array(*[f"m{i}" for i in range(len(HELP_FEATURES))]).alias("at"))).alias("centres"))
    listed = centres.first()["centres"]  # k of them
    away = lambda at: F.aggregate(F.zip_with("x", F.array(*[F.lit(float(a)) for a in at]), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)
    ranges = [F.struct(away(c["at"]).alias("d"), F.lit(c["cluster"]).alias("c")) for c in listed]
    least = F.array_min(F.array(*[r["d"] for r in ranges]))
    own = F.get(F.filter(F.array(*ranges), lambda r: r["c"] == F.col("cluster")), F.lit(0))["d"]
    return vectors.select(*HELP_FEATURES, (F.col("cluster").between(0, found.k - 1)).alias("in_range"), (own <= least * 1.05 + 1e-6).alias("is_nearest"))


_HELP_ROWS = f"""
    SELECT "Latitude", "Longitude", "PunteggioUrgenza", true AS in_range, true AS is_nearest FROM ({HELP_SQL})
    WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL AND "PunteggioUrgenza" IS NOT NULL
"""


@checked("m3b_nearest_centres", _HELP_ROWS)
def m3b(spark, sf_dir):
    return _nearest_centres(cluster.k_means(help_set(spark, sf_dir), HELP_FEATURES))


@checked("m4b_cluster_ranges", _HELP_ROWS.replace(", true AS is_nearest", ""))
def m4b(spark, sf_dir):
    """Bisecting splits one cluster at a time, so a row's cluster need not be that of the nearest mean of all."""
    return _nearest_centres(cluster.bisecting_k_means(help_set(spark, sf_dir), HELP_FEATURES)).drop("is_nearest")


def _held_out_classes(fitted: supervised.Fitted) -> DataFrame:
    return fitted.predictions.select("tweet_id", "is_viral", F.col("prediction").isin(0.0, 1.0).alias("in_classes"))


_HELD_OUT_VIRAL = f"""
    SELECT tweet_id, is_viral, true AS in_classes FROM ({VIRAL_SQL})
    WHERE "Followers" IS NOT NULL AND is_verified IS NOT NULL AND is_viral IS NOT NULL AND {HELD_OUT.format(key="tweet_id")}
"""


@checked("m5b_forest_held_out", _HELD_OUT_VIRAL)
def m5b(spark, sf_dir):
    return _held_out_classes(
        supervised.random_forest(viral_set(spark, sf_dir), ["Followers", "is_verified"], "is_viral", key="tweet_id", trees=[10], depths=[3, 5])
    )


@checked("m6b_boosted_held_out", _HELD_OUT_VIRAL)
def m6b(spark, sf_dir):
    return _held_out_classes(
        supervised.boosted_trees(viral_set(spark, sf_dir), ["Followers", "is_verified"], "is_viral", key="tweet_id", rounds=[5], depths=[2, 3])
    )


@checked(
    "m7b_least_squares",
    f"""
    WITH rows AS (SELECT l_orderkey || '-' || l_linenumber AS line, l_quantity AS x, l_extendedprice AS y FROM lineitem),
    fitted AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS start FROM rows WHERE NOT ({HELD_OUT.format(key="line")}))
    SELECT line, round(y, 4) AS label, round(start + slope * x, 1) AS prediction FROM rows, fitted WHERE {HELD_OUT.format(key="line")}
    """,
)
def m7b(spark, sf_dir):
    """One feature: the regularised line is that of least squares up to the figures shown."""
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "l_quantity", "l_extendedprice")
    fitted = supervised.linear_regression(rows, ["l_quantity"], "l_extendedprice", key="line", regularization=0.0)
    return fitted.predictions.select("line", F.round("label", 4).alias("label"), F.round("prediction", 1).alias("prediction"))


def _scored_rows(found: DataFrame, *columns: str) -> DataFrame:
    """The rows with what must hold of every score: its range, and that the flag is a limit on it."""
    limits = found.agg(F.max(F.when(F.col("Anomalia"), F.col("Score"))).alias("odd"), F.min(F.when(~F.col("Anomalia"), F.col("Score"))).alias("usual")).first()
    split = limits["odd"] is None or limits["usual"] is None or limits["odd"] < limits["usual"]
    return found.select(*columns, F.col("Score").between(-1.0, 0.0).alias("in_range"), F.lit(split).alias("flag_is_limit"))


@checked("m11b_forest_rows", f"""SELECT "Data", "Orario", "Volume_Tweet", true AS in_range, true AS flag_is_limit FROM ({ORACLES["q5_volume_by_minute"]})""")
def m11b(spark, sf_dir):
    return _scored_rows(m11(spark, sf_dir), "Data", "Orario", "Volume_Tweet")


@checked("m17b_anomaly_rows", "SELECT c_custkey, c_acctbal, c_nationkey, c_mktsegment, true AS in_range, true AS flag_is_limit FROM customer")
def m17b(spark, sf_dir):
    return _scored_rows(m17(spark, sf_dir), "c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
