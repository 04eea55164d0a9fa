"""Profiles, previews, samples, searches and statistics of any table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NumericType, StringType, StructType

from tidemark.functions.columns import hash_text
from tidemark.functions.ranks import bracket_measures, percentiles_in

SHOWN_VALUES = 10
SHOWN_CHARS = 100


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def table_columns(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    listed = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(listed, "position int, column_name string, data_type string")


def table_info(df: DataFrame) -> DataFrame:
    """The columns of a table, each row with the table's size."""
    rows = df.agg(F.count(F.lit(1))).scalar()
    return table_columns(df).withColumns({"total_rows": rows, "total_columns": F.lit(len(df.columns))})


def dataset_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, partitions with rows, files, bytes and schema of a table just read from files."""
    placed = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), F.spark_partition_id().alias("part"))
    files = placed.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("bytes"), F.collect_set("part").alias("parts"))
    return files.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("record_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.size(F.array_distinct(F.flatten(F.collect_list("parts")))).alias("partition_count"),
        F.count(F.lit(1)).cast("int").alias("file_count"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.lit(df.schema.simpleString()).alias("schema"),
    )


def preview(df: DataFrame, *, key: str, rows: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The first rows by ``key``, of some columns."""
    return df.orderBy(quoted(key)).limit(rows).select(*[quoted(c) for c in columns or df.columns])


def column_profile(df: DataFrame, column: str, *, exact: bool = True) -> DataFrame:
    """Filled, empty and distinct values; of numbers also range, mean and median.

    ``exact=False`` estimates distinct values and median in the same single pass.
    """
    value, kind = quoted(column), df.schema[column].dataType
    distinct = F.count_distinct(value) if exact else F.approx_count_distinct(value, 0.02)
    measures = [
        F.count(F.lit(1)).alias("total_rows"),
        F.count(value).alias("filled"),
        F.count_if(value.isNull()).alias("empty"),
        distinct.alias("distinct_values"),
    ]
    if isinstance(kind, NumericType):
        number = value.cast("double")
        measures += [F.min(number).alias("min"), F.max(number).alias("max"), F.avg(number).alias("mean")]
        measures += bracket_measures(number, [0.5]) if exact else [F.percentile_approx(number, 0.5, 10_000).alias("median")]
    result = df.agg(*measures)
    if isinstance(kind, NumericType) and exact:
        # One row goes on to the search, which needs its counts, and becomes the result.
        row = result.first()
        [median] = percentiles_in(df, f"`{column}`", [0.5], row["filled_numbers"], row["edges"])
        found = {**row.asDict(), "median": median}
        names = [f for f in result.schema.fields if f.name not in ("filled_numbers", "edges")]
        values = [F.lit(found[f.name]).cast(f.dataType).alias(f.name) for f in names] + [F.lit(median).cast("double").alias("median")]
        result = df.sparkSession.range(1).select(*values)
    return result.select(
        F.lit(column).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"), *result.columns
    )


def distinct_examples(df: DataFrame, column: str, *, n: int = SHOWN_VALUES, chars: int = SHOWN_CHARS) -> DataFrame:
    """The first distinct values in order; long texts are shown cut, but compared whole."""
    text = quoted(column).cast("string")
    shown = F.when(F.length("value") > chars, F.concat(F.substring("value", 1, chars), F.lit("..."))).otherwise(
        F.col("value")
    )
    distinct = df.select(text.alias("value")).filter(F.col("value").isNotNull()).distinct()
    return distinct.orderBy("value").limit(n).select(shown.alias("value"))


def sample_rows(
    df: DataFrame, *, key: str, n: int = 100, seed: int = 42, columns: Sequence[str] | None = None
) -> DataFrame:
    """``n`` random rows, the same ones at every run and partitioning: a top-k by hash of the key."""
    chosen = df.orderBy(hash_text(quoted(key), seed), quoted(key)).limit(n)
    return chosen.select(*[quoted(c) for c in columns or df.columns])


def matches(df: DataFrame, column: str, value: object) -> Column:
    """Text contains the value in any case; other types equal it."""
    if isinstance(df.schema[column].dataType, StringType):
        return F.lower(quoted(column)).contains(str(value).lower())
    return quoted(column) == F.lit(value)


def search_column(df: DataFrame, column: str, value: object, *, key: str, n: int = 10) -> DataFrame:
    """The first hits by ``key``, each with the number of all hits."""
    hits = df.filter(matches(df, column, value))
    total = hits.agg(F.count(F.lit(1))).scalar()
    return hits.orderBy(quoted(key)).limit(n).withColumn("total_hits", total)


def search_text(df: DataFrame, pattern: str) -> DataFrame:
    """Rows where any text column matches the pattern in any case."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        return df
    found = F.lit(False)
    for name in names:
        found = found | F.coalesce(quoted(name).rlike(f"(?i){pattern}"), F.lit(False))
    return df.filter(found)


def result_stats(df: DataFrame) -> DataFrame:
    """Rows, columns, all nulls, and how many columns are numbers or text, in one pass."""
    nulls = [F.count_if(quoted(name).isNull()) for name in df.columns]
    total = nulls[0]
    for one in nulls[1:]:
        total = total + one
    kinds = [f.dataType for f in df.schema.fields]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(kinds)).alias("n_columns"),
        total.alias("null_values"),
        F.lit(sum(isinstance(k, NumericType) for k in kinds)).alias("numeric_columns"),
        F.lit(sum(isinstance(k, StringType) for k in kinds)).alias("text_columns"),
    )


def _any_has(items: Column, name: str) -> Column:
    """Whether any struct of an array fills the field."""
    return F.coalesce(F.exists(items, lambda item: item.getField(name).isNotNull()), F.lit(False))


def _filled_leaves(kind: DataType, value: Column, path: str) -> list[tuple[str, str, Column]]:
    """(path, type, is-filled test) of a field and of all fields inside structs and arrays of structs."""
    if isinstance(kind, StructType):
        found = []
        for f in kind.fields:
            found += _filled_leaves(f.dataType, value.getField(f.name), f"{path}.{f.name}" if path else f.name)
        return found
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
        found = [(path, "array", value.isNotNull())]
        for f in kind.elementType.fields:
            found.append((f"{path}[].{f.name}", f.dataType.simpleString(), _any_has(value, f.name)))
        return found
    return [(path, kind.simpleString(), value.isNotNull())]


def fill_rates(df: DataFrame) -> DataFrame:
    """Every column and nested field with its type and the share of rows that fill it, in one pass."""
    listed = []
    for f in df.schema.fields:
        listed += _filled_leaves(f.dataType, quoted(f.name), f.name)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.array(
            *[
                F.struct(F.lit(path).alias("field"), F.lit(kind).alias("data_type"), F.count_if(test).alias("filled"))
                for path, kind, test in listed
            ]
        ).alias("fields"),
    )
    return counts.select("total", F.inline("fields")).select(
        "field", "data_type", "filled", F.try_divide(F.col("filled").cast("double"), F.col("total")).alias("fill_rate")
    )
