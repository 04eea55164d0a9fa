"""The registered view and read-only SQL on it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed


def register(df: DataFrame, name: str = fixed.DEFAULT_VIEW) -> DataFrame:
    """Register ``df`` as the view users query, and return it."""
    df.createOrReplaceTempView(name)
    return df


# Text, quoted names and comments: what stands in them is data, not a keyword.
_QUOTED = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|--[^\n]*|/\*.*?\*/""", re.S)


def keywords(text: str) -> list[str]:
    """The bare words of a statement in upper case, in order."""
    return re.findall(r"\w+", _QUOTED.sub(" ", text).upper())


def check_read_only(text: str) -> None:
    """Raise ``ValueError`` unless ``text`` is a reading statement without a writing keyword."""
    match keywords(text):
        case []:
            raise ValueError("the query is empty")
        case [first, *_] if first not in fixed.SQL_FIRST_WORDS:
            raise ValueError(f"a query must start with one of {', '.join(fixed.SQL_FIRST_WORDS)}")
        case words if writing := sorted({*words} & {*fixed.SQL_REJECTED_WORDS}):
            raise ValueError(f"not allowed in a query: {', '.join(writing)}")


def _cut(df: DataFrame, limit: int | None) -> DataFrame:
    if limit is None:
        return df
    if limit < 0:
        raise ValueError("a limit must not be negative")
    return df.limit(limit)


def run_sql(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Run a reading statement: the whole result, or as many rows as a given limit says."""
    check_read_only(text)
    return _cut(spark.sql(text), limit)


def limited(df: DataFrame, limit: int | None = None, order_by: list | None = None) -> DataFrame:
    """The first ``limit`` rows of a result (all without one), each with the size of the whole as ``total_rows``.

    With ``order_by`` the cut is a distributed top-k. An empty result gives an empty frame.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    chosen = df.orderBy(*order_by) if order_by else df
    return _cut(chosen, limit).withColumn("total_rows", total)


def describe(spark: SparkSession, name: str = fixed.DEFAULT_VIEW) -> DataFrame:
    """Column names and types of the view."""
    return spark.sql(f"DESCRIBE {name}")


def whole_dataset(spark: SparkSession, name: str = fixed.DEFAULT_VIEW) -> DataFrame:
    return spark.table(name)
