"""Consecutive numbers over a global order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def with_ordinal(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in the given order.

    The sorted rows are range-partitioned and checkpointed; each task numbers its own rows, and the
    small table of partition sizes gives every task its start.
    """
    placed = settle(
        df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id())
    ).withColumns(
        {
            "__part": F.shiftright("__place", _ROW_BITS),
            "__row": F.col("__place").bitwiseAND((1 << _ROW_BITS) - 1),
        }
    )
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the sort, so this window is as small as the number of tasks.
    starts = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__size"))
        .select("__part", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    )
    return (
        placed.join(starts, "__part")
        .withColumn(name, F.col("__start") + F.col("__row"))
        .drop("__place", "__part", "__row", "__start")
    )
