"""Tolerant readers for JSON lines, CSV and Parquet, alone or mixed, with provenance."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import fixed_values as fixed
from tidemark.sources.shaping import CORRUPT, coerce, evolve_union

log = logging.getLogger(__name__)

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowUnquotedFieldNames": True,
    "allowSingleQuotes": True,
    "allowNumericLeadingZeros": True,
    "allowBackslashEscapingAnyCharacter": True,
    "allowUnquotedControlChars": True,
    "dropFieldIfAllNull": False,
    "prefersDecimal": False,
}
CSV_OPTIONS = {
    "header": True,
    "encoding": "UTF-8",
    "escape": '"',
    "quote": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
    "nullValue": "",
    "emptyValue": "",
}
FORMATS = {"csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet", "pq": "parquet"}

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _with_corrupt(schema: StructType) -> StructType:
    """The schema with a field for unreadable records, so that Spark keeps them."""
    if CORRUPT in schema.fieldNames():
        return schema
    return StructType([*schema.fields]).add(CORRUPT, StringType())


def tolerant_reader(spark: SparkSession, fmt: str, schema: StructType | None = None) -> DataFrameReader:
    """A reader that never fails on a bad record."""
    reader = spark.read
    if fmt == "json":
        reader = reader.options(**JSON_OPTIONS)
    elif fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, inferSchema=schema is None)
    elif fmt != "parquet":
        raise ValueError(f"unknown format {fmt}")
    if schema is None:
        return reader
    return reader.schema(schema if fmt == "parquet" else _with_corrupt(schema))


def read_json(spark: SparkSession, paths: Paths, schema: StructType | None = None) -> DataFrame:
    """JSON lines, plain or gzip. Unreadable lines come back in ``_corrupt_record``.

    Give a schema for large inputs: without one Spark reads everything once more to infer it.
    """
    df = tolerant_reader(spark, "json", schema).json(_paths(paths))
    if df.columns != [CORRUPT]:
        return df
    # No line is readable: Spark has no column to scan beside the corrupt one, but the lines are at hand.
    return spark.read.text(_paths(paths)).filter(F.trim("value") != "").select(F.col("value").alias(CORRUPT))


def spread_gzip(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """Spread rows read from gzip files, which Spark cannot split, when they are too few for the cluster."""
    wanted = tasks or df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    few_gzip = len(files) < wanted and all(name.endswith(".gz") for name in files)
    return df.repartition(wanted) if few_gzip else df


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a file's first block; the rest is not read."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1 if batch.column("block")[0].as_py() == 0 else 0)
            return


def csv_groups(spark: SparkSession, paths: Paths) -> list[list[str]]:
    """The CSV files below ``paths`` in groups of one header, ordered by their first file. One job reads the first line of
    every file. Where all files have one header the paths themselves are the only group, folders included."""
    apart = spark.newSession()  # its own settings: every task has one file, or one part of a very large one
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(8 << 30))
    apart.conf.set("spark.sql.files.openCostInBytes", str(8 << 30))
    lines = apart.read.text(_paths(paths))
    placed = lines.select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"))
    first = placed.mapInArrow(_first_lines, "value string, file_path string, block long")
    plus_kept = F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B")))
    header = F.rtrim(F.regexp_replace("value", "^\ufeff", ""))
    found = first.select(header.alias("header"), plus_kept.alias("path")).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups = sorted(row["paths"] for row in found if row["header"])
    if len(groups) <= 1:
        return [_paths(paths)]
    return [[re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in group] for group in groups]  # as names, not patterns


def _csv_text(spark: SparkSession, group: Sequence[str]) -> DataFrame:
    return tolerant_reader(spark, "csv").option("inferSchema", False).csv(list(group))


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv(spark: SparkSession, paths: Paths, schema: StructType | None = None) -> DataFrame:
    """CSV with a header. Columns are found by their names in the header of each file; there is one scan for each
    header that occurs. Lines that do not fit a schema come back in ``_corrupt_record``.

    Without a schema the columns of all files are united; types are inferred for each header and widened without loss.
    """
    groups = csv_groups(spark, paths)
    if schema is None:
        parts = [tolerant_reader(spark, "csv").csv(group) for group in groups]
        return parts[0] if len(parts) == 1 else evolve_union(parts)
    wanted = {f.name: f for f in schema.fields}
    parts = []
    for group in groups:
        header = _csv_text(spark, group).columns
        stands = StructType([wanted.get(name, StructField(name, StringType())) for name in header])
        found = tolerant_reader(spark, "csv", stands).csv(group)
        missing = {name: F.lit(None).cast(f.dataType) for name, f in wanted.items() if name not in header}
        parts.append(found.withColumns(missing).select(*[F.col(f"`{name}`") for name in (*wanted, CORRUPT)]))
    return _united(parts)


def read_parquet(spark: SparkSession, paths: Paths, *, merge: bool = True) -> DataFrame:
    """Parquet; with ``merge`` the columns of all files are united."""
    return spark.read.option("mergeSchema", merge).parquet(*_paths(paths))


def format_of(path: str) -> str | None:
    """Format by extension (a final ``.gz`` is passed over), ``None`` when it has no known one."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower().removesuffix(".gz")
    return FORMATS.get(name.rpartition(".")[2]) if "." in name else None


def by_format(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """The inputs by their format. An input whose name tells none is a folder, and each file below it
    counts; a file of unknown format raises."""
    found: dict[str, list[str]] = {}
    for path in paths:
        fmt = format_of(path)
        if fmt is not None:
            found.setdefault(fmt, []).append(path)
            continue
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
        files = sorted(row["path"] for row in listed.collect())
        unknown = [name for name in files if format_of(name) is None]
        if unknown or not files:
            raise ValueError(f"no known format: {(unknown or [path])[0]}")
        for name in files:
            found.setdefault(format_of(name), []).append(name)
    return found


def read_as(spark: SparkSession, fmt: str, paths: Paths, schema: StructType | None = None) -> DataFrame:
    """Read one format; a schema is a wish for JSON and CSV and a later coercion for Parquet."""
    if fmt == "parquet":
        df = read_parquet(spark, paths)
        return df if schema is None else coerce(df, schema)
    if fmt == "csv":
        return read_csv(spark, paths, schema)
    return tolerant_reader(spark, fmt, schema).format(fmt).load(_paths(paths))


def read_by_name(spark: SparkSession, fmt: str, paths: Paths, schema: StructType | None) -> DataFrame:
    """Like ``read_as``, but CSV columns go by their header: Spark matches a CSV schema by position."""
    if fmt != "csv" or schema is None:
        return read_as(spark, fmt, paths, schema)
    return _united([coerce(_csv_text(spark, group), schema) for group in csv_groups(spark, paths)])


def read_any(spark: SparkSession, paths: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """Files of mixed formats as one table; one scan per format, columns united by name."""
    groups = sorted(by_format(spark, paths).items())
    return _united([spread_gzip(read_by_name(spark, fmt, group, schema)) for fmt, group in groups])


def post_markers(lines: DataFrame, *, line: str = "value") -> DataFrame:
    """Each JSON line with ``is_post``: at least three of the seven marker keys are present."""
    markers = F.array(*[F.lit(name) for name in fixed.POST_MARKERS])
    found = F.size(F.array_intersect(F.json_object_keys(line), markers))
    return lines.withColumn("is_post", F.coalesce(found >= fixed.POST_MARKERS_NEEDED, F.lit(False)))


def kinds_of_files(spark: SparkSession, paths: Paths, *, fraction: float = 1.0) -> DataFrame:
    """Per file the kind of its records, 'twitter' or 'generic', by majority of its lines."""
    lines = spark.read.text(_paths(paths)).select("value", F.col("_metadata.file_path").alias("file_path"))
    if fraction < 1.0:
        lines = lines.sample(fraction, seed=fixed.ML_SEED)
    return (
        post_markers(lines)
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("records"), F.count_if("is_post").alias("post_records"))
        .withColumn("kind", F.when(F.col("post_records") * 2 >= F.col("records"), "twitter").otherwise("generic"))
    )


def read_with_fallback(
    spark: SparkSession,
    paths: Paths,
    fmt: str,
    schema: StructType | None = None,
    *,
    only_if_posts: bool = False,
    fraction: float = 1.0,
) -> DataFrame:
    """Read with a schema; when that fails anywhere, read without one (CSV then as text only, by the names in each file's
    header). The files are read once in full to see it. The log says which way was taken, and why.

    ``only_if_posts`` applies the schema to JSON only when most of the lines look like posts. A ``fraction`` below one
    judges by a sample of the lines, or by all if the sample is empty.
    """
    if schema is not None and only_if_posts and fmt == "json":
        counted = (F.sum("post_records").alias("posts"), F.sum("records").alias("records"))
        totals = kinds_of_files(spark, paths, fraction=fraction).agg(*counted).first()
        if not totals["records"] and fraction < 1.0:
            totals = kinds_of_files(spark, paths).agg(*counted).first()
        if totals["records"] and totals["posts"] * 2 < totals["records"]:
            log.warning("schema not used: %s of %s lines look like posts", totals["posts"], totals["records"])
            schema = None
    try:
        df = read_as(spark, fmt, paths, schema)
        df.write.format("noop").mode("overwrite").save()  # some reading errors show only in a job, and only in some files
        log.info("read %s", "without a schema" if schema is None else "with the schema")
        return df
    except (AnalysisException, PySparkException) as error:
        log.warning("read again without a schema: %s", str(error).partition("\n")[0])
        if fmt == "csv":
            return _united([_csv_text(spark, group) for group in csv_groups(spark, paths)])
        return tolerant_reader(spark, fmt).format(fmt).load(_paths(paths))


def corrupt_report(df: DataFrame) -> DataFrame:
    """Records, unreadable records and their share, and records with any value, in one pass.

    Spark refuses to scan raw files for the corrupt column alone; the filled records need the others.
    """
    data = [F.col(f"`{name}`") for name in df.columns if name != CORRUPT]
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    any_value = F.lit(False)
    for column in data:
        any_value = any_value | column.isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(broken).alias("corrupt_records"),
        F.count_if(any_value).alias("filled_records"),
    ).withColumn("corrupt_share", F.try_divide(F.col("corrupt_records").cast("double"), F.col("records")))


def corrupt_examples(df: DataFrame, n: int = 3) -> DataFrame:
    """A few unreadable records, the first in text order."""
    if CORRUPT not in df.columns:
        return df.sparkSession.createDataFrame([], "example string")
    others = [name for name in df.columns if name != CORRUPT][:1]
    return (
        df.select(CORRUPT, *others)
        .filter(F.col(CORRUPT).isNotNull())
        .orderBy(CORRUPT, *others)  # Spark refuses to scan raw files for the corrupt column alone
        .limit(n)
        .select(F.col(CORRUPT).alias("example"))
    )


def _bare(path):
    """A path without scheme and host, to compare what was asked with what Spark reports."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", path).rstrip("/")


def with_provenance(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """Add ``source_file`` and the 1-based ``source_id`` of the input (file or folder) of each row.

    Must come right after the read. A file counts for the longest input that holds it. The list of inputs is small
    and becomes part of the expression.
    """
    plus_kept = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    file_path = F.regexp_replace(plus_kept, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")
    listed = sorted(((_bare(path), i) for i, path in enumerate(inputs, 1)), key=lambda x: (-len(x[0]), x[1]))
    source = F.lit(None).cast("struct<source_file:string,source_id:int>")
    for path, i in reversed(listed):  # the longest input that the file is, or lies below
        here = (F.col("__file") == path) | F.startswith("__file", F.lit(path + "/"))
        named = F.struct(F.lit(path.rsplit("/", 1)[-1]).alias("source_file"), F.lit(i).alias("source_id"))
        source = F.when(here, named).otherwise(source)
    return (
        df.withColumn("__file", file_path)
        .withColumn("__source", source)
        .withColumns({"source_file": F.col("__source.source_file"), "source_id": F.col("__source.source_id")})
        .drop("__file", "__source")
    )


def load_many(spark: SparkSession, inputs: Sequence[str], target: StructType) -> DataFrame:
    """Many files of any format as one table in the target schema, with provenance. Lines that cannot be read
    keep their text in ``_corrupt_record``."""
    parts = []
    for fmt, group in sorted(by_format(spark, inputs).items()):
        if fmt == "parquet":
            read = [read_parquet(spark, group)]
        elif fmt == "json":
            read = [read_json(spark, group, target)]
        else:
            read = [_csv_text(spark, files) for files in csv_groups(spark, group)]
        for raw in read:
            located = spread_gzip(with_provenance(raw, inputs))
            if CORRUPT not in located.columns:
                located = located.withColumn(CORRUPT, F.lit(None).cast("string"))
            parts.append(coerce(located, target, keep=("source_file", "source_id", CORRUPT)))
    return _united(parts)
