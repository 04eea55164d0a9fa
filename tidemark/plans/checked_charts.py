"""Registered chart data (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import charts
from tidemark.plans.posts import table
from tidemark.plans.registry import checked

TYPES = ["click", "error", "purchase", "signup", "view"]


@checked("c1_daily_counts", 'SELECT CAST(ts AS date) AS ts, count(*) AS "Conteggio" FROM events GROUP BY 1')
def c1(spark, sf_dir):
    return charts.chart_data(table(spark, sf_dir, "events"), "ts")


@checked("c1b_daily_sums", "SELECT CAST(ts AS date) AS ts, round(sum(value), 4) AS value FROM events GROUP BY 1")
def c1b(spark, sf_dir):
    return charts.chart_data(table(spark, sf_dir, "events"), "ts", "value").withColumn("value", F.round("value", 4))


@checked(
    "c1c_daily_counts_of_text",
    'SELECT CAST(ts AS date) AS ts, count(*) AS "Conteggio_event_type" FROM events GROUP BY 1',
)
def c1c(spark, sf_dir):
    return charts.chart_data(table(spark, sf_dir, "events"), "ts", "event_type")


@checked("c2_value_counts", 'SELECT o_orderpriority, count(*) AS "Conteggio" FROM orders GROUP BY 1')
def c2(spark, sf_dir):
    return charts.chart_data(table(spark, sf_dir, "orders"), "o_orderpriority")


@checked(
    "c3_category_totals",
    "SELECT o_orderpriority, round(sum(o_totalprice), 2) AS o_totalprice FROM orders GROUP BY 1",
)
def c3(spark, sf_dir):
    totals = charts.chart_data(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return totals.withColumn("o_totalprice", F.round("o_totalprice", 2))


@checked("c3b_raw_pairs", "SELECT l_quantity, l_discount FROM lineitem")
def c3b(spark, sf_dir):
    return charts.chart_data(table(spark, sf_dir, "lineitem"), "l_quantity", "l_discount")


@checked(
    "c4_bar_points",
    """
    SELECT p_name, round(sum(p_retailprice), 2) AS p_retailprice FROM part GROUP BY p_name
    ORDER BY sum(p_retailprice) DESC, p_name LIMIT 500
    """,
)
def c4(spark, sf_dir):
    totals = charts.chart_data(table(spark, sf_dir, "part"), "p_name", "p_retailprice")
    return charts.bar_points(totals, "p_name", "p_retailprice").withColumn("p_retailprice", F.round("p_retailprice", 2))


@checked(
    "c5_line_points",
    """
    SELECT strftime(ts, '%Y-%m-%d %H:%M') AS minute, count(*) AS n FROM events GROUP BY 1
    ORDER BY minute DESC, n LIMIT 500
    """,
)
def c5(spark, sf_dir):
    minutes = (
        table(spark, sf_dir, "events")
        .groupBy(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return charts.line_points(minutes, "minute", "n")


@checked(
    "c6_pie_slices",
    """
    SELECT c_nationkey, round(sum(c_acctbal), 2) AS c_acctbal FROM customer GROUP BY 1
    ORDER BY sum(c_acctbal) DESC, c_nationkey LIMIT 10
    """,
)
def c6(spark, sf_dir):
    slices = charts.pie_slices(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal")
    return slices.withColumn("c_acctbal", F.round("c_acctbal", 2))


def _heat(name: str, sql: str, digits: int):
    query = f"SELECT user_id, event_type, {sql} AS value FROM events GROUP BY 1, 2"

    @checked(f"c7_heat_cells_{name}", query)
    def c7(spark, sf_dir):
        cells = charts.heat_map(table(spark, sf_dir, "events"), "event_type", "user_id", "value", agg=name)
        return cells.withColumn("value", F.round("value", digits)) if digits else cells


_heat("max", "max(value)", 0)
_heat("mean", "round(avg(value), 8)", 8)
_heat("sum", "round(sum(value), 4)", 4)
_heat("count", "count(value)", 0)


@checked(
    "c7b_heat_matrix",
    "SELECT user_id, "
    + ", ".join(f"max(value) FILTER (event_type = '{t}') AS \"{t}\"" for t in TYPES)
    + " FROM events GROUP BY user_id",
)
def c7b(spark, sf_dir):
    return charts.heat_matrix(table(spark, sf_dir, "events"), "event_type", "user_id", "value", TYPES)


@checked(
    "c8_crosstab",
    "SELECT c_nationkey, "
    + ", ".join(
        f"count(*) FILTER (c_mktsegment = '{s}') AS \"{s}\""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer GROUP BY c_nationkey",
)
def c8(spark, sf_dir):
    return charts.heat_map(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey")


@checked(
    "c9_density",
    """
    WITH e AS (SELECT min(l_extendedprice) AS x0, max(l_extendedprice) AS x1,
        min(CAST(l_partkey AS double)) AS y0, max(CAST(l_partkey AS double)) AS y1 FROM lineitem)
    SELECT CAST(least(floor((l_extendedprice - x0) / ((x1 - x0) / 50)), 49) AS integer) AS x_bin,
      CAST(least(floor((CAST(l_partkey AS double) - y0) / ((y1 - y0) / 50)), 49) AS integer) AS y_bin, count(*) AS n
    FROM lineitem, e GROUP BY 1, 2
    """,
)
def c9(spark, sf_dir):
    return charts.heat_map(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_partkey")


@checked(
    "c9b_density_date_text",
    """
    WITH o AS (SELECT date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS date)) AS d, o_orderpriority AS p FROM orders),
    e AS (SELECT CAST(min(d) AS double) AS d0, CAST(max(d) AS double) AS d1 FROM o)
    SELECT CAST(least(floor((d - d0) / ((d1 - d0) / 50)), 49) AS integer) AS x_bin, p AS y_bin, count(*) AS n FROM o, e GROUP BY 1, 2
    """,
)
def c9b(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    return charts.heat_map(orders, "day", "o_orderpriority")


@checked(
    "c8b_crosstab_with_nulls",
    """
    SELECT n AS c_nationkey, """
    + ", ".join(f"count(*) FILTER (s = '{s}') AS \"{s}\"" for s in ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"))
    + """ FROM (SELECT CASE WHEN c_nationkey > 2 THEN c_nationkey END AS n, nullif(c_mktsegment, 'FURNITURE') AS s FROM customer)
    WHERE n IS NOT NULL AND s IS NOT NULL GROUP BY n
    """,
)
def c8b(spark, sf_dir):
    """Rows without one of the values count nowhere."""
    holed = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") > 2, F.col("c_nationkey")).alias("c_nationkey"),
        F.nullif(F.col("c_mktsegment"), F.lit("FURNITURE")).alias("c_mktsegment"),
    )
    return charts.heat_map(holed, "c_mktsegment", "c_nationkey")
