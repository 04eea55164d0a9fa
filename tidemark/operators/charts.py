"""Chart-ready aggregates: series, bars, pies, heat maps and densities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tidemark.functions import fixed_values as fixed
from tidemark.ml.features import number

HEAT_FUNCTIONS = {"mean": F.avg, "sum": F.sum, "max": F.max, "count": F.count}


def _is(df: DataFrame, column: str, *kinds: type) -> bool:
    return isinstance(df.schema[column].dataType, kinds)


def daily_series(df: DataFrame, x: str, y: str | None = None) -> DataFrame:
    """Per day: the rows, the sum of a numeric y, or the rows when y is no number."""
    if y is None:
        measure = F.count(F.lit(1)).alias(fixed.COUNT_NAME)
    elif _is(df, y, NumericType):
        measure = F.coalesce(F.sum(y), F.lit(0)).alias(y)
    else:
        measure = F.count(F.lit(1)).alias(f"{fixed.COUNT_NAME}_{y}")
    return (
        df.filter(F.col(x).isNotNull()).groupBy(F.to_date(x).alias(x)).agg(measure).orderBy(x)
    )


def value_counts(df: DataFrame, x: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.filter(F.col(x).isNotNull())
        .groupBy(x)
        .agg(F.count(F.lit(1)).alias(fixed.COUNT_NAME))
        .orderBy(F.desc(fixed.COUNT_NAME))
    )


def category_totals(df: DataFrame, x: str, y: str) -> DataFrame:
    """Sum of a numeric y per text x; of other types the pairs as they are. Nulls are dropped."""
    filled = df.select(x, y).dropna()
    if _is(df, x, StringType) and _is(df, y, NumericType):
        return filled.groupBy(x).agg(F.sum(y).alias(y))
    return filled


def chart_data(df: DataFrame, x: str, y: str | None = None) -> DataFrame:
    """The data of a chart: a daily series over time, else counts or totals per value."""
    if _is(df, x, DateType, TimestampType, TimestampNTZType):
        return daily_series(df, x, y)
    return value_counts(df, x) if y is None else category_totals(df, x, y)


def bar_points(data: DataFrame, x: str, y: str, *, n: int = fixed.CHART_MAX_POINTS) -> DataFrame:
    """The largest y of a bar chart."""
    return data.orderBy(F.desc(y), x).limit(n)


def line_points(data: DataFrame, x: str, y: str, *, n: int = fixed.CHART_MAX_POINTS) -> DataFrame:
    """The last x of a line chart."""
    return data.orderBy(F.desc(x), y).limit(n)


def pie_slices(df: DataFrame, x: str, y: str | None = None, *, n: int = fixed.PIE_MAX_SLICES) -> DataFrame:
    """Sum of y per category, the largest ones; without y the rows of every category."""
    if y is None:
        return value_counts(df, x)
    totals = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x).agg(F.sum(y).alias(y))
    return totals.orderBy(F.desc(y), x).limit(n)


def heat_cells(df: DataFrame, x: str, y: str, z: str, *, agg: str = "max") -> DataFrame:
    """The filled cells of a heat map, long form: one row per (y, x)."""
    return df.dropna(subset=[x, y, z]).groupBy(y, x).agg(HEAT_FUNCTIONS[agg](z).alias(z))


def heat_matrix(df: DataFrame, x: str, y: str, z: str, x_values: list, *, agg: str = "max") -> DataFrame:
    """The heat map as a matrix with one column per given x value."""
    return df.dropna(subset=[x, y, z]).groupBy(y).pivot(x, x_values).agg(HEAT_FUNCTIONS[agg](z))


def few_values(df: DataFrame, column: str, *, most: int = fixed.CROSSTAB_MAX_VALUES) -> list | None:
    """The distinct values of a column in order, or ``None`` when there are more than ``most``."""
    found = df.select(column).dropna().distinct().limit(most + 1).collect()
    return sorted(row[0] for row in found) if len(found) <= most else None


def crosstab(df: DataFrame, x: str, y: str, x_values: list) -> DataFrame:
    """Rows per (y, x) as a matrix; absent pairs are 0."""
    filled = df.dropna(subset=[x, y])
    return filled.groupBy(y).pivot(x, x_values).agg(F.count(F.lit(1))).fillna(0)


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """The bin 0..bins-1 of a value; a column of one value has a single bin."""
    width = (high - low) / bins
    inner = F.floor((value - low) / width).cast("int")
    return F.when(width > 0, F.least(inner, F.lit(bins - 1))).otherwise(F.lit(0))


_MEASURED = (NumericType, DateType, TimestampType, TimestampNTZType)


def density(df: DataFrame, x: str, y: str, *, bins: int = fixed.DENSITY_BINS) -> DataFrame:
    """Rows per cell over both columns: numbers and points in time in equal bins of their range, counted from 0,
    other values each by itself."""
    plain = [name for name in (x, y) if not isinstance(df.schema[name].dataType, _MEASURED)]
    measured = {name: number(F.col(name), df.schema[name].dataType) for name in {x, y} - {*plain}}
    if plain:
        rows = df.dropna(subset=[x, y])
        edges = [f(c).alias(f"{part}_{name}") for name, c in measured.items() for part, f in (("low", F.min), ("high", F.max))]
        edge = rows.agg(F.struct(*edges).alias("edge")).scalar() if edges else None
        cell = {name: bin_of(c, edge[f"low_{name}"], edge[f"high_{name}"], bins) for name, c in measured.items()}
        cell |= {name: F.col(name) for name in plain}
        return rows.groupBy(cell[x].alias("x_bin"), cell[y].alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))
    pairs = df.select(measured[x].alias("x"), measured[y].alias("y")).dropna()
    edges = F.struct(
        F.min("x").alias("x_low"), F.max("x").alias("x_high"), F.min("y").alias("y_low"), F.max("y").alias("y_high")
    )
    edge = pairs.agg(edges.alias("edge")).scalar()
    x_bin = bin_of(F.col("x"), edge["x_low"], edge["x_high"], bins)
    y_bin = bin_of(F.col("y"), edge["y_low"], edge["y_high"], bins)
    return pairs.groupBy(x_bin.alias("x_bin"), y_bin.alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def heat_map(df: DataFrame, x: str, y: str, z: str | None = None, *, agg: str = "max") -> DataFrame:
    """Cells of z, else the crosstab when both sides have few values, else the density."""
    if z is not None:
        return heat_cells(df, x, y, z, agg=agg)
    df = df.dropna(subset=[x, y])
    x_values, y_values = few_values(df, x), few_values(df, y)
    if x_values is not None and y_values is not None:
        return crosstab(df, x, y, x_values)
    return density(df, x, y)
