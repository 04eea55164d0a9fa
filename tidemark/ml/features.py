"""Feature tables for clustering, supervised learning and distance-based methods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import unused_name
from tidemark.functions.ordinal import with_ordinal

_TIMES = (DateType, TimestampType, TimestampNTZType)


def need_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def need_rows(df: DataFrame, least: int) -> int:
    """The number of rows; an error when there are too few."""
    rows = df.count()
    if rows < least:
        raise ValueError(f"{rows} rows are too few, at least {least} are needed")
    return rows


#: Tasks of one training step, unless they would get some million rows each.
MOST_TASKS = 512


def training_tasks(rows: int) -> int:
    """Tasks for iterative training, whose every step pays for every task: few for small tables, and none of more than some
    million rows. The number hangs on the rows alone, not on the cluster."""
    return max(min(rows // fixed.ROWS_PER_TASK_LEAST + 1, MOST_TASKS), rows // fixed.ROWS_PER_TASK_MOST + 1)


def fitting_tasks(df: DataFrame, rows: int) -> DataFrame:
    """Even partitions for iterative training: one shuffle of the feature table, before the many passes over it."""
    return df.repartition(training_tasks(rows))


def encode_text(df: DataFrame, column: str, output: str, *, by_frequency: bool) -> DataFrame:
    """Text values as 0, 1, 2, ...: the most frequent first, or in alphabetical order.

    The numbers are made in a table of the distinct values and joined, so any number of distinct
    values will do; none pass through the driver.
    """
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("uses"))
    order = [F.desc("uses"), F.col("value")] if by_frequency else [F.col("value")]
    codes = with_ordinal(counts, order, "code").select(F.col("value").alias(column), F.col("code").cast("double").alias(output))
    return df.join(codes, column).select(*[F.col(f"`{name}`") for name in (*df.columns, output)])


def number(value: Column, kind: DataType) -> Column:
    """A simple value as double; points in time count seconds."""
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double") / 1e6
    return value.cast("double")


def finite(value: Column) -> Column:
    """The value, with NaN and infinities as 0."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(bad, 0.0).otherwise(value)


def cluster_features(df: DataFrame, features: Sequence[str], *, least: int = fixed.MIN_ROWS_CLUSTERING) -> DataFrame:
    """All columns of the rows without nulls in the features, and their vector ``features``."""
    need_columns(df, features)
    ready = df.dropna(subset=list(features))
    need_rows(ready, least)
    inputs = []
    for name in features:
        kind = df.schema[name].dataType
        inputs.append(unused_name(ready.columns, f"{name}_number"))
        if isinstance(kind, StringType):
            ready = encode_text(ready, name, inputs[-1], by_frequency=True)
        else:
            ready = ready.withColumn(inputs[-1], number(F.col(name), kind))
    assembled = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(ready)
    return assembled.drop(*inputs)


def supervised_features(
    df: DataFrame, features: Sequence[str], target: str, *, least: int = fixed.MIN_ROWS_SUPERVISED
) -> DataFrame:
    """The rows without nulls in features and target, with the vector ``features``; text is hashed. Dealt evenly."""
    return fitting_tasks(*assembled_features(df, features, target, least=least))


def assembled_features(
    df: DataFrame, features: Sequence[str], target: str, *, least: int = fixed.MIN_ROWS_SUPERVISED
) -> tuple[DataFrame, int]:
    """``supervised_features`` in the partitions that the table has, and the number of rows."""
    need_columns(df, [*features, target])
    # Only missing values drop a row; NaN in a number counts as 0 later.
    ready = df
    for name in (*features, target):
        ready = ready.filter(F.col(name).isNotNull())
    rows = need_rows(ready, least)
    texts = [name for name in features if isinstance(df.schema[name].dataType, StringType)]
    inputs = []
    for name in features:
        kind = df.schema[name].dataType
        if name in texts:
            continue
        value = number(F.col(name), kind)
        plain = isinstance(kind, (BooleanType, *_TIMES))
        inputs.append(unused_name(ready.columns, f"{name}_cleaned"))
        ready = ready.withColumn(inputs[-1], value if plain else finite(value))
    stages = []
    if texts:
        inputs.append(unused_name(ready.columns, "hashed_features"))
        stages.append(FeatureHasher(inputCols=texts, outputCol=inputs[-1], numFeatures=fixed.HASHED_FEATURES))
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(ready).transform(ready).drop(*inputs), rows


def standardized(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """All columns of the rows without nulls in the features, and ``z_<feature>`` of each.

    Text (and dates, as text) is numbered alphabetically first. Columns of one value become 0.
    """
    need_columns(df, features)
    ready = df.dropna(subset=list(features))
    for name in features:
        kind = df.schema[name].dataType
        if isinstance(kind, (NumericType, BooleanType)):
            ready = ready.withColumn(f"z_{name}", F.col(name).cast("double"))
        else:
            text = unused_name(ready.columns, f"{name}_text")
            ready = ready.withColumn(text, F.col(name).cast("string"))
            ready = encode_text(ready, text, f"z_{name}", by_frequency=False).drop(text)
    names = [f"z_{name}" for name in features]
    # A mean and a deviation per feature: a handful of numbers, put into the plan as constants.
    moments = ready.agg(
        *[F.avg(name).alias(f"m_{name}") for name in names],
        *[F.stddev_pop(name).alias(f"s_{name}") for name in names],
    ).first()
    scaled = {}
    for name in names:
        mean, deviation = moments[f"m_{name}"], moments[f"s_{name}"]
        if mean is None:
            raise ValueError("no rows are left without missing values")
        scaled[name] = (F.col(name) - F.lit(mean)) / F.lit(deviation or 1.0)
    return ready.withColumns(scaled)
