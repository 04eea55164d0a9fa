"""Readers, schema work, repair and sinks on hand-written files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tidemark.sources import paths, readers, repair, shaping, sinks


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        target = tmp_path / name
        if name.endswith(".gz"):
            target.write_bytes(gzip.compress(text.encode()))
        else:
            target.write_text(text)
        return str(target)

    return write


GOOD = "\n".join(json.dumps({"id": i, "user": {"name": f"n{i}"}}) for i in range(5))


def test_dirty_json_counts_the_cut_line(spark, put):
    path = put("dirty.jsonl", "{id: 1, 'a': 'x'}\n{\"id\": 002, \"a\": \"t\tb\"}\n{\"id\": 3, \"a\": \"\\q\"}\n{\"id\": 4, \"a")
    df = readers.read_json(spark, path, StructType.fromDDL("id bigint, a string"))
    assert sorted(r["id"] for r in df.filter("id IS NOT NULL").collect()) == [1, 2, 3]
    report = readers.corrupt_report(df).first()
    assert (report["records"], report["corrupt_records"], report["filled_records"]) == (4, 1, 3)
    assert [r["example"] for r in readers.corrupt_examples(df).collect()] == ['{"id": 4, "a']


def test_corrupt_report_of_clean_and_empty_tables(spark):
    assert readers.corrupt_report(spark.range(3)).first()["corrupt_records"] == 0
    assert readers.corrupt_report(spark.range(0)).first()["corrupt_share"] is None


def test_gzip_and_plain_are_equal(spark, put):
    plain, packed = put("good.jsonl", GOOD), put("good.json.gz", GOOD)
    one, two = readers.read_json(spark, plain), readers.spread_gzip(readers.read_json(spark, packed), 3)
    assert sorted(one.collect()) == sorted(two.collect())
    assert two.rdd.getNumPartitions() == 3


def test_csv_quotes_blanks_and_spaces(spark, put):
    path = put("quoted.csv", 'a,b,c\n1,"say ""hi"", now",  x \n2,,\n')
    rows = readers.read_csv(spark, path).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi", now', "x"), (2, None, None)]


@pytest.mark.parametrize(
    "path, fmt",
    [("a.csv", "csv"), ("A.JSON", "json"), ("a.jsonl", "json"), ("d/a.json.gz", "json"), ("a.pq", "parquet"), ("a.parquet/", "parquet"), ("a", None), ("a.txt", None)],
)
def test_format_by_extension(path, fmt):
    assert readers.format_of(path) == fmt


def test_mixed_batch_reads_every_file(spark, put, tmp_path):
    """The format of the last file must not decide for all."""
    spark.range(2).select((F.col("id") + 20).alias("id")).write.parquet(str(tmp_path / "c.parquet"))
    inputs = [put("a.jsonl", '{"id": 1}\n{"id": 2}'), put("b.csv", "id\n10\n"), str(tmp_path / "c.parquet")]
    df = readers.load_many(spark, inputs, StructType.fromDDL("id bigint, note string"))
    found = sorted((r["id"], r["source_file"], r["source_id"]) for r in df.collect())
    assert found == [(1, "a.jsonl", 1), (2, "a.jsonl", 1), (10, "b.csv", 2), (20, "c.parquet", 3), (21, "c.parquet", 3)]


def test_kind_needs_three_markers(spark, put):
    files = {
        "three.jsonl": '{"id": 1, "text": "a", "user": {}}\n',
        "two.jsonl": '{"id": 1, "text": "a", "other": 3}\n',
        "none.jsonl": '{"x": 1}\nnot json\n',
    }
    kinds = readers.kinds_of_files(spark, [put(name, text) for name, text in files.items()]).collect()
    assert {r["file_path"].rsplit("/", 1)[-1]: r["kind"] for r in kinds} == {
        "three.jsonl": "twitter", "two.jsonl": "generic", "none.jsonl": "generic",
    }


def test_schema_only_for_posts(spark, put):
    schema = StructType.fromDDL("id string")
    posts, other = put("p.jsonl", '{"id": 1, "text": "a", "user": {}}'), put("o.jsonl", '{"id": 1, "b": 2}')
    read = lambda p: readers.read_with_fallback(spark, p, "json", schema, only_if_posts=True, fraction=1.0)
    assert read(posts).schema["id"].dataType == StringType()
    assert read(other).schema["id"].dataType == LongType()


def test_fallback_reads_csv_as_text(spark, put):
    path = put("a.csv", "a,b\n1,2\n")
    df = readers.read_with_fallback(spark, path, "csv", StructType.fromDDL("a map<string,string>, b int"))
    assert [f.dataType for f in df.schema.fields] == [StringType(), StringType()]


def test_coerce_never_fails_a_job(spark):
    df = spark.sql(
        "SELECT 'x' AS n, named_struct('a', 1) AS s, array(1, 2) AS l, '{\"a\": 5}' AS j, true AS b, "
        "array(named_struct('a', '1', 'gone', 2)) AS ls, 3.7D AS d"
    )
    target = StructType.fromDDL(
        "n bigint, s string, l string, j struct<a:bigint>, b date, ls array<struct<a:bigint,more:string>>, d bigint, none int"
    )
    row = shaping.coerce(df, target).first()
    assert row["n"] is None and row["s"] == '{"a":1}' and row["l"] == "[1,2]" and row["j"]["a"] == 5
    assert row["b"] is None and row["none"] is None and row["d"] == 3
    assert row["ls"][0]["a"] == 1 and row["ls"][0]["more"] is None
    assert shaping.coerce(df, target).schema.simpleString() == target.simpleString()


def test_null_structs_stay_null(spark):
    df = spark.createDataFrame(
        [(1, "en", None, None), (2, "en", ("i", True, 3), ("u", "UTC"))],
        "keep int, lang string, retweeted_status struct<id_str:string,truncated:boolean,id:int>, user struct<id_str:string,time_zone:string>",
    )
    pruned = shaping.prune_post_columns(df)
    assert pruned.schema.simpleString() == "struct<keep:int,retweeted_status:struct<id_str:string>,user:struct<id_str:string>>"
    assert [r["user"] for r in pruned.orderBy("keep").collect()][0] is None
    bare = spark.createDataFrame([(1, ("x",))], "keep int, user struct<url:string>")
    assert shaping.prune_post_columns(bare).columns == ["keep"]


def test_merge_types():
    merge = shaping.merge_types
    struct = StructType.fromDDL
    assert merge(struct("a int, b string"), struct("b bigint, c string")) == struct("a int, b string, c string")
    assert merge(struct("a struct<x:int>"), struct("a struct<y:int>")) == struct("a struct<x:int,y:int>")
    assert merge(ArrayType(struct("a int")), ArrayType(struct("b int"))) == ArrayType(struct("a int, b int"))
    assert merge(StringType(), struct("a int")) == StringType()
    assert merge(struct("a int"), StringType()) == StringType()
    assert merge(ArrayType(StringType()), struct("a int")) == StringType()
    for one, two, both in [("int", "bigint", "bigint"), ("double", "int", "double"), ("date", "timestamp", "timestamp"), ("int", "decimal(10,2)", "decimal(22,2)"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>")]:
        assert merge(struct(f"x {one}"), struct(f"x {two}")) == merge(struct(f"x {two}"), struct(f"x {one}")) == struct(f"x {both}")


def test_drift_becomes_one_table(spark, put):
    one = readers.read_json(spark, put("a.jsonl", '{"id": 1, "place": {"name": "x"}, "only": true}'))
    two = readers.read_json(spark, put("b.jsonl", '{"id": 2, "place": "plain"}'))
    united = shaping.evolve_union([one, two]).orderBy("id").collect()
    assert [(r["id"], r["place"], r["only"]) for r in united] == [(1, '{"name":"x"}', True), (2, "plain", None)]
    back = shaping.evolve_union([two, one]).orderBy("id").collect()
    assert [(r["id"], r["place"]) for r in back] == [(1, '{"name":"x"}'), (2, "plain")]
    many = shaping.evolve_union([spark.sql("SELECT map('a', 1) AS m, 5000000000 AS n"), spark.sql("SELECT map('b', 1.5D) AS m, 1 AS n")])
    assert {(tuple(r["m"].items()), r["n"]) for r in many.collect()} == {((("a", 1.0),), 5000000000), ((("b", 1.5),), 1)}


def test_flatten_keeps_arrays(spark):
    df = spark.sql("SELECT named_struct('b', named_struct('c', 1), 'd', array(1)) AS a, 2 AS e")
    assert shaping.flatten(df).columns == ["a_b_c", "a_d", "e"]


def test_relevant_columns_of_partial_posts(spark, put):
    lines = '{"id_str": "1", "text": "short", "extended_tweet": {"full_text": "long"}, "user": {"followers_count": 3}}\n{"id_str": "2", "text": "t"}\nbroken {'
    raw = readers.read_json(spark, put("x.json.gz", lines)).filter(F.col(readers.CORRUPT).isNull())
    rows = shaping.extract_relevant(raw).orderBy("tweet_id").collect()
    assert [(r["tweet_id"], r["testo_completo"], r["user_followers"], r["luogo"]) for r in rows] == [
        ("1", "long", 3, None), ("2", "t", None, None),
    ]


def test_typed_paths_tree_and_depth(spark, put):
    lines = '{"a": {"b": {"c": 1.5}}, "n": null}\n{"a": "text", "l": [1], "n": true}\n[1]\nnot json\n{"e": {}, "n": 2}'
    seen = paths.path_types(paths.read_lines(spark, put("x.jsonl", lines)))
    found = {r["path"]: r["types"] for r in seen.collect()}
    assert found == {
        "a": "dict, str", "a.b": "dict", "a.b.c": "float", "n": "NoneType, bool, int", "l": "list", "e": "dict",
    }
    tree = {(r["parent"], r["parent_types"], r["child"]) for r in paths.path_tree(seen).collect()}
    assert tree == {("root", "object", "a"), ("root", "object", "n"), ("root", "object", "l"), ("root", "object", "e"),
                    ("a", "dict, str", "b"), ("a.b", "dict", "c")}
    assert paths.path_depth(seen).first()["max_depth"] == 3


def test_objects_below_the_depth_limit_are_reported(spark, put):
    lines = paths.read_lines(spark, put("deep.jsonl", '{"a": {"b": {"c": {"d": 1}}}}'))
    rows = paths.typed_paths(lines, max_depth=2).collect()
    assert {(r["path"], r["unexpanded"]) for r in rows} == {("a", 0), ("a.b", 1)}


def test_file_type_report(spark, put):
    files = [
        put("one.jsonl", '{"i": 1, "f": 1, "u": {"x": "s"}, "b": true, "g": 1}\n\n{"i": 2, "f": 2.5, "u": null, "b": false}'),
        put("two.jsonl", '{"i": 1}\n{"i": '),
    ]
    found = {tuple(r) for r in paths.file_type_report(paths.read_lines(spark, files)).collect()}
    assert found == {
        ("one.jsonl", "i", "int64"), ("one.jsonl", "f", "float64"), ("one.jsonl", "u", "object"),
        ("one.jsonl", "u_x", "object"), ("one.jsonl", "b", "bool"), ("one.jsonl", "g", "float64"),
        ("two.jsonl", "_FILE_CORROTTO_O_ILLEGGIBILE_", "JSONDecodeError"),
    }


def test_saved_schema_keeps_all_types(spark, tmp_path):
    schema = StructType.fromDDL("a double, b timestamp, c struct<d:array<date>>, m map<string,int>")
    paths.save_schema(spark, schema, str(tmp_path / "schema"))
    assert paths.load_schema(spark, str(tmp_path / "schema")) == schema


def test_recover_concatenated_objects(spark, put):
    path = put("concat.json", '{"a": 1}{"a": {"b": "}{"}}\n{"a": 3} garbage {"c": [4]} [5] 6\n')
    pieces = repair.recover_json(spark, path)
    found = sorted((r["kind"], r["json"]) for r in pieces.collect())
    assert found == sorted([
        ("object", '{"a": 1}'), ("object", '{"a": {"b": "}{"}}'), ("object", '{"a": 3}'), ("skipped", "garbage"),
        ("object", '{"c": [4]}'), ("array", "[5]"), ("scalar", "6"),
    ])
    records = repair.recovered_records(pieces, ["a", "c"]).collect()
    assert sorted((r["a"], r["c"]) for r in records if r["a"]) == [("1", None), ("3", None), ('{"b":"}{"}', None)]


def test_recover_values_over_several_lines(spark, put):
    path = put("pretty.json", '{\n "a": 1\n}\n{\n "a": 2\n} x')
    found = [(r["kind"], r["json"]) for r in repair.recover_json(spark, path, multiline=True).collect()]
    assert found == [("object", '{\n "a": 1\n}'), ("object", '{\n "a": 2\n}'), ("skipped", "x")]


def test_save_load_twice_keeps_one_copy(spark, tmp_path):
    folder = str(tmp_path / "set")
    for _ in range(2):
        sinks.save_load(spark.range(3), folder, "a")
    sinks.save_load(spark.range(4), folder, "b")
    assert readers.read_parquet(spark, folder).count() == 7


def test_convert_writes_one_folder_per_input(spark, put, tmp_path):
    inputs = [put("one.json.gz", GOOD), put("two.jsonl", GOOD)]
    out = str(tmp_path / "out")
    sinks.convert_to_parquet(spark, inputs, out, columns=shaping.relevant_columns)
    assert {r["source_file"]: r["n"] for r in spark.read.parquet(out).groupBy("source_file").agg(F.count("*").alias("n")).collect()} == {"one": 5, "two": 5}


def test_fallback_judges_all_lines_and_files(spark, tmp_path):
    from pyspark.sql.types import IntegerType, LongType, StructField, StructType

    generic = tmp_path / "generic.json"
    generic.write_text('{"sensor": 1}\n{"sensor": 2}\n')
    posts = StructType([StructField("id", LongType())])
    for fraction in ({}, {"fraction": 1e-9}):
        df = readers.read_with_fallback(spark, [str(generic)], "json", posts, only_if_posts=True, **fraction)
        assert sorted(r["sensor"] for r in df.collect()) == [1, 2]

    parts = str(tmp_path / "parts")
    spark.range(10_000).selectExpr("id AS x").coalesce(1).write.parquet(parts)
    spark.range(3).selectExpr("id AS x", "'late' AS y").coalesce(1).write.mode("append").parquet(parts)
    wanted = StructType([StructField("x", LongType()), StructField("y", IntegerType())])
    df = readers.read_with_fallback(spark, [parts], "parquet", wanted)
    assert len(df.collect()) == 10_003


def test_forest_samples_are_drawn_alike_at_every_size(spark):
    from tidemark.ml.isolation import _samples

    for total in (30, 400):  # less and more than twice the rows of all trees
        df = spark.range(total).select("id", F.col("id").cast("double").alias("z_a"))
        found = {}
        for r in _samples(df, ["z_a"], "id", 4, 10, 7, total).collect():
            found.setdefault(r["tree"], set()).add(r["id"])
        for tree in range(4):
            order = df.orderBy(F.xxhash64("id", F.lit(7), F.lit(tree)), "id").limit(10)
            assert found[tree] == {r["id"] for r in order.collect()}
