"""Connected components: neighbouring labels merge, and the graph shrinks to the labels left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle


def _followed(step: DataFrame, by: DataFrame) -> DataFrame:
    """The label each label leads to after one more step."""
    further = by.select(F.col("label").alias("up"), F.col("up").alias("next"))
    return step.join(further, "up").select("label", F.col("next").alias("up"))


def _to_the_end(step: DataFrame) -> DataFrame:
    """Each label with the label where its way ends; four steps at a time."""
    step = settle(step)
    while _followed(step, step).join(step.withColumnRenamed("up", "was"), "label").filter("up <> was").take(1):
        step = settle(_followed(_followed(_followed(step, step), step), step))
    return step


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the edges (u, v).

    In a round every label takes the smallest neighbouring one if that is smaller, and goes its way to
    the end. Edges then join the labels that are left, which are at most half as many or nearly so.
    """
    labels = nodes.select("node", F.col("node").alias("label"))
    links = settle(
        edges.select("u", "v")
        .unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        .filter("u <> v")
        .distinct()
    )
    while links.take(1):
        ways = _to_the_end(
            links.groupBy(F.col("u").alias("label")).agg(F.min("v").alias("up")).withColumn("up", F.least("up", "label"))
        )
        of_u = ways.select(F.col("label").alias("u"), F.col("up").alias("new_u"))
        of_v = ways.select(F.col("label").alias("v"), F.col("up").alias("new_v"))
        links = settle(
            links.join(of_u, "u")
            .join(of_v, "v")
            .filter("new_u <> new_v")
            .select(F.col("new_u").alias("u"), F.col("new_v").alias("v"))
            .distinct()
        )
        labels = labels.join(ways, "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return settle(labels)
