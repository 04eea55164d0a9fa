"""Bringing tables to a schema, uniting schemas, and reshaping nested columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType,
    NullType, NumericType, ShortType, StringType, StructField, StructType, TimestampType, VariantType,
)

from tidemark.functions import fixed_values as fixed

#: Where the text of a record that cannot be read is kept.
CORRUPT = "_corrupt_record"

_NESTED = (StructType, ArrayType, MapType)


def _castable(have: DataType, want: DataType) -> bool:
    """Whether Spark accepts a cast between two simple types."""
    spark = SparkSession.getActiveSession()
    try:
        spark.range(0).select(F.lit(None).cast(have).try_cast(want))
        return True
    except AnalysisException:
        return False


def conform(value: Column, have: DataType, want: DataType) -> Column:
    """``value`` as type ``want``; what does not fit becomes NULL, never an error.

    Structs are matched by field name, arrays by element. A nested value becomes JSON text where text
    is wanted, and JSON text is parsed where a nested value is wanted.
    """
    if have == want:
        return value
    if isinstance(want, VariantType):
        return value.cast(want)
    if isinstance(want, StringType):
        return F.to_json(value) if isinstance(have, _NESTED) else value.try_cast(want)
    if isinstance(have, StructType) and isinstance(want, StructType):
        known = {f.name: f.dataType for f in have.fields}
        fields = [
            (
                conform(value.getField(f.name), known[f.name], f.dataType)
                if f.name in known
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda item: conform(item, have.elementType, want.elementType))
    if isinstance(have, MapType) and isinstance(want, MapType):
        entry = lambda e: F.struct(
            conform(e["key"], have.keyType, want.keyType).alias("key"), conform(e["value"], have.valueType, want.valueType).alias("value")
        )
        return F.map_from_entries(F.transform(F.map_entries(value), entry))
    if isinstance(have, StringType) and isinstance(want, _NESTED):
        opening = r"^\s*\[" if isinstance(want, ArrayType) else r"^\s*\{"
        return F.when(value.rlike(opening) & F.try_parse_json(value).isNotNull(), F.from_json(value, want))
    if isinstance(have, _NESTED) or isinstance(want, _NESTED) or not _castable(have, want):
        return F.lit(None).cast(want)
    return value.try_cast(want)


def coerce(df: DataFrame, target: StructType, *, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the target columns in their order, of their types; missing ones are NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        (
            conform(F.col(f"`{f.name}`"), have[f.name], f.dataType)
            if f.name in have
            else F.lit(None).cast(f.dataType)
        ).alias(f.name)
        for f in target.fields
    ]
    return df.select(*columns, *[F.col(f"`{name}`") for name in keep])


# Normalising asks for the same as coercing: one implementation serves both.
normalize = coerce


# Whole numbers by width; a wider one holds the narrower.
_WHOLE = (ByteType, ShortType, IntegerType, LongType)
# Decimal digits kept for whole numbers beside a decimal, and the most that a decimal can have.
_WHOLE_DIGITS, _MOST_DIGITS = 20, 38


@dataclass(frozen=True)
class _Open(DataType):
    """A numeric field whose common type hangs on its values: the types it has, and whether one is binary floating point."""

    kinds: tuple[DataType, ...]

    @property
    def floating(self) -> bool:
        return any(isinstance(t, (FloatType, DoubleType)) for t in self.kinds)

    def settled(self, whole: int, scale: int, inexact: int) -> DataType:
        """The type for values with so many digits before and after the point; ``inexact`` if a double cannot hold one."""
        if self.floating and not inexact and not any(isinstance(t, DecimalType) for t in self.kinds):
            return DoubleType()
        fits = whole + scale <= _MOST_DIGITS
        return DecimalType(max(1, whole + scale), scale) if fits else VariantType()


def _common_number(kinds: Sequence[DataType]) -> DataType:
    """The type that holds every value of the numeric types, if the types alone can tell."""
    whole = [t for t in kinds if isinstance(t, _WHOLE)]
    if len(whole) == len(kinds):
        return max(whole, key=lambda t: _WHOLE.index(type(t)))
    floating = [t for t in kinds if isinstance(t, (FloatType, DoubleType))]
    if len(whole) + len(floating) == len(kinds):
        if not whole:
            return DoubleType()
        widest = max(_WHOLE.index(type(t)) for t in whole)
        if all(isinstance(t, FloatType) for t in floating) and widest <= 1:
            return FloatType()
        return _Open(tuple(kinds)) if widest == 3 else DoubleType()
    if floating:
        return _Open(tuple(kinds))
    digits = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_WHOLE_DIGITS, 0) for t in kinds]
    before, after = max(b for b, _ in digits), max(a for _, a in digits)
    return DecimalType(before + after, after) if before + after <= _MOST_DIGITS else _Open(tuple(kinds))


def _common(kinds: Sequence[DataType]) -> DataType:
    """A type for the values of all the types; fields that need a look at their values are ``_Open``. What has no closer
    common type becomes text, nested values as JSON."""
    kinds = [t for t in dict.fromkeys(kinds) if not isinstance(t, NullType)] or [NullType()]
    if len(kinds) == 1:
        return kinds[0]
    if all(isinstance(t, StructType) for t in kinds):
        names = dict.fromkeys(name for t in kinds for name in t.fieldNames())
        return StructType([StructField(name, _common([t[name].dataType for t in kinds if name in t.fieldNames()])) for name in names])
    if all(isinstance(t, ArrayType) for t in kinds):
        return ArrayType(_common([t.elementType for t in kinds]))
    if all(isinstance(t, MapType) for t in kinds):
        key = _common([t.keyType for t in kinds])
        return MapType(StringType() if _open_paths(key) else key, _common([t.valueType for t in kinds]))
    if all(isinstance(t, NumericType) for t in kinds):
        return _common_number(kinds)
    return TimestampType() if all(isinstance(t, (DateType, TimestampType)) for t in kinds) else StringType()


def _open_paths(kind: DataType, above: tuple[str | None, ...] = ()) -> list[tuple[str | None, ...]]:
    """Where open fields stand: names, and None for the elements of an array or the values of a map."""
    if isinstance(kind, _Open):
        return [above]
    if isinstance(kind, StructType):
        return [path for f in kind.fields for path in _open_paths(f.dataType, (*above, f.name))]
    if isinstance(kind, (ArrayType, MapType)):
        return _open_paths(kind.elementType if isinstance(kind, ArrayType) else kind.valueType, (*above, None))
    return []


#: Whole numbers up to this one are all held by a double.
_EXACT_IN_DOUBLE = 1 << 53


def _numbers(value: Column, kind: DataType, path: tuple[str | None, ...]) -> tuple[Column, DataType, bool] | None:
    """The number at a path with its type, or all of them as one array where arrays and maps stand above it."""
    if not path:
        return value, kind, False
    step, rest = path[0], path[1:]
    if step is not None:
        known = isinstance(kind, StructType) and step in kind.fieldNames()
        return _numbers(value[step], kind[step].dataType, rest) if known else None
    inner = kind.elementType if isinstance(kind, ArrayType) else kind.valueType if isinstance(kind, MapType) else None
    found = None if inner is None else _numbers(F.lit(None).cast(inner), inner, rest)
    if found is None:
        return None
    each = F.transform(value if isinstance(kind, ArrayType) else F.map_values(value), lambda x: _numbers(x, inner, rest)[0])
    return F.flatten(F.filter(each, lambda x: x.isNotNull())) if found[2] else each, found[1], True


def _places(value: Column, kind: DataType) -> Column:
    """Digits after the point that a number needs; 0 for a null."""
    if isinstance(kind, _WHOLE) or isinstance(kind, DecimalType) and kind.scale == 0:
        return F.lit(0)
    text = value.cast("string")
    number = F.substring_index(text, "E", 1)
    exponent = F.when(text.contains("E"), F.substring_index(text, "E", -1).try_cast("int")).otherwise(0)
    fraction = F.when(number.contains("."), F.length(F.rtrim(F.substring_index(number, ".", -1), F.lit("0")))).otherwise(0)
    return F.when(value.isNull() | (value == 0), 0).otherwise(F.greatest(F.lit(0), fraction - exponent))


def _inexact(value: Column, kind: DataType) -> Column:
    """1 for a whole number that no double shows; those up to 2^53 need no closer look."""
    if not isinstance(kind, LongType):
        return F.lit(0)
    exact = value.isNull() | value.between(-_EXACT_IN_DOUBLE, _EXACT_IN_DOUBLE)
    return F.when(exact, 0).when(value.cast("double").cast("decimal(20,0)") != value.cast("decimal(20,0)"), 1).otherwise(0)


def _measures(value: Column, kind: DataType, many: bool) -> list[Column]:
    """Aggregates over all rows: the greatest and the smallest number as text, the most places, and whether one is inexact."""
    if not many:
        return [F.max(value).cast("string"), F.min(value).cast("string"), F.max(_places(value, kind)), F.max(_inexact(value, kind))]
    of_all = lambda use: F.max(F.array_max(F.transform(value, lambda x: use(x, kind))))
    return [F.max(F.array_max(value)).cast("string"), F.min(F.array_min(value)).cast("string"), of_all(_places), of_all(_inexact)]


def _whole_digits(text: str | None) -> int:
    """Digits before the point, of the text of a number; too many to hold if it is none."""
    number = Decimal(text or "0")
    return max(0, number.adjusted() + 1 if number else 0) if number.is_finite() else _MOST_DIGITS + 1


def _settled(kind: DataType, found: dict, above: tuple[str | None, ...] = ()) -> DataType:
    """The type with its open fields decided by what was measured."""
    if isinstance(kind, _Open):
        return kind.settled(*found[above])
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType, found, (*above, f.name))) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType, found, (*above, None)))
    return MapType(kind.keyType, _settled(kind.valueType, found, (*above, None))) if isinstance(kind, MapType) else kind


def merge_types(first: DataType, second: DataType) -> DataType:
    """A type that takes the values of both without loss, whatever they are; Variant where no simple type surely does."""
    merged = _common([first, second])
    return _settled(merged, dict.fromkeys(_open_paths(merged), (_MOST_DIGITS, _MOST_DIGITS, 1)))


def common_schema(frames: Sequence[DataFrame]) -> StructType:
    """The schema that holds the values of all tables without loss.

    Where types alone cannot tell (long with double, decimals of over 38 digits together), one pass over each table that has the
    field finds the digits its values need: a double if it holds every whole number, else a decimal, else a Variant, which keeps
    each value in the type it has.
    """
    schema = _common([df.schema for df in frames])
    paths = _open_paths(schema)
    found = {path: [0, 0, 0] for path in paths}
    for df in frames if paths else ():
        whole = F.struct(*[F.col(f"`{name}`") for name in df.columns])
        known = {path: numbers for path in paths if (numbers := _numbers(whole, df.schema, path))}
        measures = [m for numbers in known.values() for m in _measures(*numbers)]
        row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first() if measures else ()
        for i, path in enumerate(known):
            most, least, places, inexact = row[4 * i : 4 * i + 4]
            here = max(_whole_digits(most), _whole_digits(least)), places or 0, inexact or 0
            found[path] = [max(a, b) for a, b in zip(found[path], here)]
    return _settled(schema, found)


def evolve_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Tables of differing nested schemas as one table; types are widened so that no value is lost, by a look at the
    values where that is needed."""
    schema = frames[0].schema if len(frames) == 1 else common_schema(frames)
    first, *rest = [coerce(df, schema) for df in frames]
    for df in rest:
        first = first.unionByName(df)
    return first


def _without(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """``df`` with fields dropped from a struct column; a NULL struct stays NULL."""
    if column not in df.columns or not isinstance(df.schema[column].dataType, StructType):
        return df
    present = df.schema[column].dataType.fieldNames()
    dropped = [name for name in names if name in present]
    if not dropped:
        return df
    if len(dropped) == len(present):
        return df.drop(column)
    return df.withColumn(column, F.col(column).dropFields(*dropped))


def prune_post_columns(df: DataFrame) -> DataFrame:
    """Drop the fields no report uses, from the post, the posts inside it and its author."""
    df = df.drop(*fixed.POST_FIELDS_DROPPED)
    for inner in ("retweeted_status", "quoted_status"):
        df = _without(df, inner, fixed.POST_FIELDS_DROPPED)
    return _without(df, "user", fixed.USER_FIELDS_DROPPED)


def leaves(schema: StructType, above: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], DataType]]:
    """Paths and types of all fields that are not structs."""
    found = []
    for f in schema.fields:
        path = (*above, f.name)
        if isinstance(f.dataType, StructType):
            found += leaves(f.dataType, path)
        else:
            found.append((path, f.dataType))
    return found


def flatten(df: DataFrame, *, sep: str = "_") -> DataFrame:
    """Nested struct fields as columns of their own; arrays stay as they are."""
    return df.select(
        *[F.col(".".join(f"`{part}`" for part in path)).alias(sep.join(path)) for path, _ in leaves(df.schema)]
    )


def nested_as_json(df: DataFrame, columns: Sequence[str] = fixed.JSON_TEXT_COLUMNS) -> DataFrame:
    """Chosen nested columns as JSON text; columns that are absent or already simple stay."""
    nested = [f.name for f in df.schema.fields if f.name in columns and isinstance(f.dataType, _NESTED)]
    return df.withColumns({name: F.to_json(name) for name in nested}) if nested else df


def _leaf(df: DataFrame, path: str, want: str) -> Column:
    """A nested field if the schema has it, else a typed NULL."""
    node: DataType = df.schema
    for part in path.split("."):
        if not isinstance(node, StructType) or part not in node.fieldNames():
            return F.lit(None).cast(want)
        node = node[part].dataType
    return conform(F.col(path), node, StringType()) if want == "string" else F.col(path).try_cast(want)


def relevant_columns(posts: DataFrame) -> list[Column]:
    """Nine flat columns of each post; the extended text comes before the short one."""
    return [
        _leaf(posts, "id_str", "string").alias("tweet_id"),
        _leaf(posts, "created_at", "string").alias("data_creazione"),
        F.coalesce(
            _leaf(posts, "extended_tweet.full_text", "string"), _leaf(posts, "text", "string")
        ).alias("testo_completo"),
        _leaf(posts, "lang", "string").alias("lingua"),
        _leaf(posts, "user.id_str", "string").alias("user_id"),
        _leaf(posts, "user.screen_name", "string").alias("user_name"),
        _leaf(posts, "user.followers_count", "bigint").alias("user_followers"),
        _leaf(posts, "place.full_name", "string").alias("luogo"),
        _leaf(posts, "retweet_count", "bigint").alias("conteggio_retweet"),
    ]


def without_corrupt(rows: DataFrame) -> DataFrame:
    """The rows that could be read, without the column for the others."""
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in rows.columns else rows


def extract_relevant(posts: DataFrame) -> DataFrame:
    """Nine flat columns of each post; records that could not be read are left out."""
    readable = without_corrupt(posts)
    return readable.select(*relevant_columns(readable))
