"""Profiles of JSON text: every nested path with the types seen there."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import fixed_values as fixed
from tidemark.session import settle

ROOT = "root"


def type_name(value: Column) -> Column:
    """The type of a JSON value, by the names of the report."""

    def named(kind: Column) -> Column:
        return (
            F.when(kind.startswith("OBJECT"), "dict")
            .when(kind.startswith("ARRAY"), "list")
            .when(kind == "STRING", "str")
            .when(kind == "BIGINT", "int")
            .when(kind == "BOOLEAN", "bool")
            .when(kind == "VOID", "NoneType")
            .otherwise("float")
        )

    # As the variable of a lambda the schema is made once, not once a comparison.
    return F.transform(F.array(F.schema_of_variant(value)), named)[0]


#: An object, whose fields are not looked into.
_OBJECT = "map<string,variant>"


def _children(fields: Column, above: Column) -> Column:
    """The fields of an object as (path, type, object); the object only where there is more below. The schema of a whole
    object is never asked for, so a level costs what its own fields do, however deep the objects go."""
    empty = f"array<struct<path:string,type:string,object:{_OBJECT}>>"

    def child(entry: Column) -> Column:
        path = F.when(above.isNull(), entry["key"]).otherwise(F.concat(above, F.lit("."), entry["key"]))
        kind = F.when(entry["object"].isNotNull(), "dict").otherwise(type_name(entry["value"]))
        return F.struct(path.alias("path"), kind.alias("type"), entry["object"].alias("object"))

    opened = F.transform(
        F.map_entries(fields),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), e["value"].try_cast(_OBJECT).alias("object")),
    )
    return F.coalesce(F.transform(opened, child), F.array().cast(empty))


#: Levels of objects that one pass looks at.
LEVELS_AT_ONCE = 5


def _with_levels(objects: DataFrame, levels: int) -> DataFrame:
    """The objects (above, object) with their fields on each level below, as arrays level_1, level_2, ..."""
    found = objects.withColumn("level_1", _children(F.col("object"), F.col("above")))
    for depth in range(2, levels + 1):
        inner = F.filter(f"level_{depth - 1}", lambda e: e["object"].isNotNull())
        found = found.withColumn(f"level_{depth}", F.flatten(F.transform(inner, lambda e: _children(e["object"], e["path"]))))
    return found


def typed_paths(lines: DataFrame, *, line: str = "value", by: Sequence[str] = (), max_depth: int | None = None) -> DataFrame:
    """Per path (and ``by``) and type the number of records that have it, down to the deepest object. Lines that are no JSON
    object are passed over.

    A pass looks at a few levels of the objects it gets, and counts; the next one gets only the objects that are left below
    these, stored, so that no line is parsed again for each pass. The profiles of the passes have no path in common and are put together. A given ``max_depth`` stops there, and
    ``unexpanded`` counts the objects left.
    """
    objects = lines.select(*by, F.lit(None).cast("string").alias("above"), F.try_parse_json(line).try_cast(_OBJECT).alias("object"))
    profiles, done = [], 0
    while True:
        levels = LEVELS_AT_ONCE if max_depth is None else min(LEVELS_AT_ONCE, max_depth - done)
        leveled = _with_levels(objects, levels)
        shown = [F.transform(f"level_{i}", lambda e: F.struct(e["path"], e["type"], F.lit(False).alias("open"))) for i in range(1, levels)]
        shown.append(F.transform(f"level_{levels}", lambda e: F.struct(e["path"], e["type"], e["object"].isNotNull().alias("open"))))
        each = leveled.select(*by, F.explode(F.concat(*shown)).alias("e")).select(*by, F.col("e.path").alias("path"), F.col("e.type").alias("type"), "e.open")
        found = settle(each.groupBy(*by, "path", "type").agg(F.count(F.lit(1)).alias("records"), F.count_if("open").alias("unexpanded")))
        done += levels
        if done == max_depth or not found.filter("unexpanded > 0").take(1):
            profiles.append(found)
            return reduce(DataFrame.unionByName, profiles)
        profiles.append(found.withColumn("unexpanded", F.lit(0).cast("long")))
        inner = leveled.select(*by, F.explode(F.filter(f"level_{levels}", lambda e: e["object"].isNotNull())).alias("e"))
        objects = settle(inner.select(*by, F.col("e.path").alias("above"), F.col("e.object").alias("object")))


def path_types(lines: DataFrame, *, line: str = "value", max_depth: int | None = None) -> DataFrame:
    """Every path with its set of types, as 'NoneType, str'."""
    return (
        typed_paths(lines, line=line, max_depth=max_depth)
        .groupBy("path")
        .agg(F.array_join(F.sort_array(F.collect_set("type")), ", ").alias("types"))
    )


def path_tree(types: DataFrame) -> DataFrame:
    """Parent, its types, and each child with its types; top fields hang under 'root'."""
    parent = F.when(F.col("path").contains("."), F.regexp_extract("path", r"^(.*)\.[^.]*$", 1)).otherwise(ROOT)
    children = types.select(
        parent.alias("parent"), F.regexp_extract("path", r"([^.]*)$", 1).alias("child"), F.col("types").alias("child_types")
    )
    parents = types.select(F.col("path").alias("parent"), F.col("types").alias("parent_types"))
    return children.join(parents, "parent", "left").select(
        "parent",
        F.coalesce("parent_types", F.when(F.col("parent") == ROOT, "object"), F.lit("dict")).alias("parent_types"),
        "child",
        "child_types",
    )


def path_depth(types: DataFrame) -> DataFrame:
    """The deepest nesting of a profile, as one row."""
    return types.agg(F.max(F.size(F.split("path", r"\."))).alias("max_depth"))


def file_type_report(lines: DataFrame, *, line: str = "value", file: str = "filename", sep: str = "_") -> DataFrame:
    """(filename, column_name, data_type) of every file; a file with a bad line has one marker row.

    The types are those a data frame of the flattened records would have.
    """
    filled = lines.filter(F.trim(F.col(line)) != "")
    totals = filled.groupBy(file).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.try_parse_json(line).isNull()).alias("bad")
    )
    seen = (
        typed_paths(filled, line=line, by=[file])
        .filter(F.col("type") != "dict")
        .groupBy(file, "path")
        .agg(F.array_sort(F.collect_set("type")).alias("types"), F.sum("records").alias("present"))
    )
    whole, gaps = F.col("present") == F.col("total"), F.array_contains("types", "NoneType")
    real = F.array_remove("types", "NoneType")

    def only(*names: str) -> Column:
        return (F.size(real) > 0) & (F.size(F.array_except(real, F.array(*[F.lit(n) for n in names]))) == 0)

    data_type = (
        F.when(only("int") & whole & ~gaps, "int64")
        .when(only("int", "float"), "float64")
        .when(only("bool") & whole & ~gaps, "bool")
        .otherwise("object")
    )
    good = (
        seen.join(totals.filter("bad = 0"), file)
        .select(file, F.replace("path", F.lit("."), F.lit(sep)).alias("column_name"), data_type.alias("data_type"))
    )
    broken = totals.filter("bad > 0").select(
        file, F.lit(fixed.BROKEN_FILE_COLUMN).alias("column_name"), F.lit(fixed.BROKEN_FILE_TYPE).alias("data_type")
    )
    return good.unionByName(broken)


def read_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """The lines of text files (plain or gzip) with the name of their file."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("filename"))


def infer_schema(spark: SparkSession, paths: Sequence[str] | str, *, sampling_ratio: float = 1.0) -> StructType:
    """The schema of JSON lines, from a share of them."""
    return spark.read.option("samplingRatio", sampling_ratio).json(paths).schema


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """A schema as a JSON document, written by Spark so that any file system will do."""
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType:
    import json

    return StructType.fromJson(json.loads(spark.read.text(path).first()["value"]))
