"""Path profiles that parse a line once for each pass at its level only, digits measured by aggregates, lines fitted without a cache, training on all labels."""

import json

from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.ml import supervised
from tidemark.sources import paths, shaping


def deep(levels, inner):
    return inner if not levels else {f"f{levels}": deep(levels - 1, inner), "x": [levels, None], "y": None}


def test_deep_lines_are_not_parsed_anew_for_each_level(spark):
    levels = 3 * paths.LEVELS_AT_ONCE + 1
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(line):
        read.add(1)
        return line

    rows = [json.dumps(deep(levels, i if i % 2 else 1.5)) for i in range(10)] + ["no json", "[1]", None, "{}"]
    lines = spark.createDataFrame([(r,) for r in rows], "value string").select(seen("value").alias("value"))
    found = {(r.path, r.type): r.records for r in paths.typed_paths(lines).collect()}
    path = ".".join(f"f{i}" for i in range(levels, 0, -1))
    assert found[path, "int"] == found[path, "float"] == 5 and found["f" + str(levels), "dict"] == found["x", "list"] == found["y", "NoneType"] == 10
    assert len(found) == 3 * levels + 1 and read.value <= 2 * len(rows)


def test_digits_are_measured_by_plain_aggregates(spark):
    big = (1 << 53) + 1
    one = spark.createDataFrame([(big, [big]), (None, None)], "x bigint, y array<bigint>")
    two = spark.createDataFrame([(1.25e-3, [None, 1.5]), (-100.0, [])], "x double, y array<double>")
    schema = shaping.common_schema([one, two])
    assert schema["x"].dataType.simpleString() == "decimal(21,5)" and schema["y"].dataType.elementType.simpleString() == "decimal(17,1)"
    assert shaping.common_schema([one.filter("x IS NULL"), two])["x"].dataType.simpleString() == "double"
    measures = [m for name in one.columns for m in shaping._measures(*shaping._numbers(F.struct(*one.columns), one.schema, (name,) if name == "x" else (name, None)))]
    assert "regexp" not in one.agg(*measures)._jdf.queryExecution().toString().lower()


def test_a_line_is_fitted_on_stored_rows(spark):
    rows = spark.range(400).select("id", (F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 37 * 3.0 + 1).alias("y"), F.lit("kept").alias("other"))
    fitted = supervised.linear_regression(rows, ["x"], "y", key="id", regularization=0.0)
    plan = fitted.predictions._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan and "InMemoryRelation" not in plan and "Range" not in plan
    assert fitted.predictions.filter(F.abs(F.col("prediction") - F.col("y")) > 1e-6).count() == 0 and "other" in fitted.predictions.columns


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    """Words that only a few rows of one shard hold are learned too, and rows beyond any fixed number count."""
    monkeypatch.setattr(toxicity, "CHUNK_ROWS", 100)
    rows = [(i, f"this is a {'vile' if i % 4 == 0 else 'kind'} thing number {i % 9}", "en" if i % 2 else "de", int(i % 4 == 0), i % 5 == 1) for i in range(600)]
    rows += [(1000 + i, f"word{i % 3}rare stands alone", None, 1, False) for i in range(30)] + [(None, None, None, 0, False), (5000, "", "en", 0, None)]
    df = spark.createDataFrame(rows, "id long, text string, lang string, toxic int, calibrate boolean")
    used = []
    over = toxicity._over_chunks
    monkeypatch.setattr(toxicity, "_over_chunks", lambda rows, *a: used.append((rows.count(), rows.select("shard").distinct().count())) or over(rows, *a))
    model = toxicity.fit(df)
    assert used == [(632, 7)] * 3 + [(120, 7)] and model.languages == ["de", "en"]
    asked = spark.createDataFrame([("this is a vile thing", 1), ("this is a kind thing", 0), ("word2rare stands", 1), ("some kind number", 0)], "text string, toxic int")
    for r in asked.select("toxic", toxicity.score(F.col("text"), model).alias("score")).collect():
        assert (r.score >= 0.5) == bool(r.toxic)
    assert toxicity.fit(df.filter("toxic = 1")) is None and toxicity.fit(df.limit(0)) is None
