"""CSV by header, unions without loss, records over lines, converted outputs, ranks together, roll-ups and clashing names."""

import json
import logging
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, VariantType

from tidemark.functions import ranks
from tidemark.functions.columns import found_keywords, unused_name
from tidemark.ml import dbscan, features, isolation, supervised
from tidemark.operators import filters, profile, rollups
from tidemark.sources import paths, readers, repair, shaping, sinks


@pytest.fixture
def put(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        return str(path)

    return write


def jobs_of(spark, work):
    """What ``work`` gives, and how many jobs it took."""
    context = spark.sparkContext
    group = f"counted-{random.random()}"
    context.setJobGroup(group, "counted")
    try:
        return work(), len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_csv_files_of_three_headers(spark, put):
    files = [put("in/1.csv", "a,b\n1,x\n"), put("in/2.csv", "b,a\ny,2\n"), put("in/3.csv", b"\xef\xbb\xbfa,b,c\r\n3,z,q\r\n"), put("in/4.csv", ""), put("in/5.csv", "a,b\n4,w\n")]
    folder = files[0].rpartition("/")[0]
    assert sorted(len(g) for g in readers.csv_groups(spark, folder)) == [1, 1, 2]
    found = sorted((r["a"], r["b"], r["c"]) for r in readers.read_csv(spark, folder).collect())
    assert found == [(1, "x", None), (2, "y", None), (3, "z", "q"), (4, "w", None)]
    target = StructType.fromDDL("b string, a bigint")
    for df in (readers.read_csv(spark, files, target), readers.read_any(spark, files, target), readers.load_many(spark, files, target)):
        assert sorted((r["a"], r["b"]) for r in df.collect()) == [(1, "x"), (2, "y"), (3, "z"), (4, "w")]
    by_source = {r["source_file"]: r["a"] for r in readers.load_many(spark, files, target).collect() if r["a"] < 4}
    assert by_source == {"1.csv": 1, "2.csv": 2, "3.csv": 3}


def test_csv_names_that_look_like_patterns(spark, put):
    files = [put("p+q %1/[a]{b}.csv", "a,b\n1,x\n"), put("p+q %1/[a]c.csv", "b,a\ny,2\n")]
    folder = files[0].rpartition("/")[0]
    assert sorted((r["a"], r["b"]) for r in readers.read_csv(spark, folder).collect()) == [(1, "x"), (2, "y")]


def test_csv_of_one_header_takes_provenance(spark, put):
    path = put("one.csv", "a\n1\n")
    assert [tuple(r) for r in readers.with_provenance(readers.read_csv(spark, path), [path]).collect()] == [(1, "one.csv", 1)]


def test_ranges_need_an_offset(spark):
    with pytest.raises(ValueError, match="offset"):
        rollups.volume_by_minute(spark, "p", "r", start="2024-01-01T00:00:00", end="2024-01-02T00:00:00Z")


def test_nothing_to_convert(spark, put, tmp_path):
    sinks.convert_to_parquet(spark, [put("bad.json", "broken {\n")], str(tmp_path / "out"))
    assert sinks.converted_sources(spark, str(tmp_path / "out")).count() == 1


def test_csv_of_one_header_is_read_as_given(spark, put, tmp_path):
    put("days/day=1/a.csv", "a\n1\n")
    put("days/day=2/a.csv", "a\n2\n")
    folder = str(tmp_path / "days")
    assert readers.csv_groups(spark, folder) == [[folder]]
    assert sorted((r["a"], r["day"]) for r in readers.read_csv(spark, folder).collect()) == [(1, 1), (2, 2)]


def test_csv_types_differ_between_headers(spark, put):
    files = [put("1.csv", "a,b\n9007199254740993,x\n"), put("2.csv", "b,a\ny,0.5\n")]
    found = {r["b"]: r["a"] for r in readers.read_csv(spark, files).collect()}
    assert found == {"x": Decimal(9007199254740993), "y": Decimal("0.5")}


def test_only_the_header_is_read(spark, put):
    files = [put(f"{i}.csv", "a,b\n" + "1,2\n" * 50_000) for i in range(3)]
    assert readers.csv_groups(spark, files) == [files]


def test_fallback_is_logged(spark, put, caplog):
    path = put("x.json", '{"sensor": 1}\n{"sensor": 2}\n')
    with caplog.at_level(logging.INFO, "tidemark.sources.readers"):
        readers.read_with_fallback(spark, [path], "json", StructType.fromDDL("id bigint"), only_if_posts=True)
        readers.read_with_fallback(spark, [path], "json", StructType.fromDDL("sensor bigint"))
        readers.read_with_fallback(spark, [put("y.csv", "a\n1\n")], "csv", StructType.fromDDL("a map<string,string>"))
    text = caplog.text
    assert "0 of 2 lines look like posts" in text and "read with the schema" in text and "read again without a schema" in text


@pytest.mark.parametrize("turned", [False, True])
def test_union_keeps_every_value(spark, turned):
    one = spark.sql("SELECT 9007199254740993 AS a, 12345678901234567890123456789012345678BD AS b, 3 AS c, array(named_struct('x', 9007199254740993)) AS d, map('k', 9007199254740993) AS e, 5 AS f, CAST('NaN' AS double) AS g, 1.5BD AS h")
    two = spark.sql("SELECT 0.5D AS a, 0.00001BD AS b, 2.5D AS c, array(named_struct('x', 0.25D)) AS d, map('k', 0.125D) AS e, 5000000000 AS f, 9007199254740993 AS g, 0.1D AS h")
    both = [two, one] if turned else [one, two]
    united = shaping.evolve_union(both)
    kinds = {f.name: f.dataType for f in united.schema.fields}
    assert isinstance(kinds["b"], VariantType) and isinstance(kinds["g"], VariantType)
    assert kinds["c"].simpleString() == "double" and kinds["f"].simpleString() == "bigint" and kinds["h"].simpleString() == "decimal(2,1)"
    text = united.select("a", F.col("b").cast("string").alias("b"), "c", F.col("d")[0]["x"].alias("d"), F.col("e")["k"].alias("e"), "f", F.col("g").cast("string").alias("g"), "h")
    rows = text.collect()
    first, second = rows if not turned else rows[::-1]
    assert (first.a, first.b, first.c, first.d, first.e, first.f) == (9007199254740993, "12345678901234567890123456789012345678", 3.0, 9007199254740993, 9007199254740993, 5)
    assert second.a == Decimal("0.5") and float(second.b) == 0.00001 and (second.c, second.f) == (2.5, 5000000000)
    assert second.d == Decimal("0.25") and second.e == Decimal("0.125") and first.g == "NaN" and second.g == "9007199254740993"
    assert first.h == Decimal("1.5") and second.h == Decimal("0.1")
    assert shaping.evolve_union([spark.sql("SELECT 1 AS a").limit(0), two.select("a").limit(0)]).count() == 0


def pieces_of(spark, path, **more):
    return sorted((r["kind"], json.dumps(json.loads(r["json"])) if r["kind"] != "skipped" else r["json"]) for r in repair.recover_json(spark, path, **more).collect())


def test_values_over_lines(spark, put):
    text = '{\n "a": 1\n}\n{\n "a": {"b": [1,\n2]}\n} x\n[\n{"c": 1},\n{"c": 2}\n]\n{"d": "}{"}\n\n{"e": 1}{"f":\n2}{"g": 3}\n7\n'
    expected = [("object", '{"a": 1}'), ("object", '{"a": {"b": [1, 2]}}'), ("skipped", "x"), ("array", '[{"c": 1}, {"c": 2}]'), ("object", '{"d": "}{"}')]
    expected += [("object", '{"e": 1}'), ("object", '{"f": 2}'), ("object", '{"g": 3}'), ("scalar", "7")]
    assert pieces_of(spark, put("pretty.json", text)) == sorted(expected)
    assert pieces_of(spark, put("pretty.json", text), multiline=True) == sorted(expected)


def test_unfinished_values_give_no_inner_ones(spark, put):
    text = '{"a": 1}\n{"a": {"b": 2}, "c": [{"d": 3},\n{"e": 4}\n{\n "f": {"g": 5}\n}\n}}]\n{"h": 6}\n{"i": '
    found = pieces_of(spark, put("cut.json", text))
    objects = [p for kind, p in found if kind == "object"]
    assert objects == sorted(['{"a": 1}', '{"e": 4}', '{"f": {"g": 5}}', '{"h": 6}']) or '{"d": 3}' not in objects and '{"b": 2}' not in objects
    assert '{"a": 1}' in objects and '{"h": 6}' in objects


def test_recovery_does_not_depend_on_splits(spark, put):
    rng, lines, whole = random.Random(5), [], []
    for i in range(400):
        value = {"id": i, "inner": {"t": "}" * rng.randint(0, 2) + "{", "l": [{"x": i}]}}
        whole.append(json.dumps(value))
        lines.append(json.dumps(value, indent=rng.choice([None, 1])) + rng.choice(["\n", "", " "]))
    path = put("many.json", "".join(lines))
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    apart.conf.set("spark.sql.files.openCostInBytes", "0")
    assert apart.read.text(path).rdd.getNumPartitions() > 4
    assert pieces_of(spark, path) == pieces_of(apart, path) == sorted(("object", w) for w in whole)


def test_plain_lines_are_not_shuffled(spark, put):
    found = repair.recover_json(spark, put("lines.json", '{"a": 1}\n[2]\n3\n'))
    assert sorted((r["kind"], r["json"]) for r in found.collect()) == [("array", "[2]"), ("object", '{"a": 1}'), ("scalar", "3")]


def test_two_values_on_a_line_are_not_taken_for_one(spark, put):
    assert pieces_of(spark, put("two.json", '{"a": 1}{"b": 2}\n{"a": 1, "a": 2}\n')) == sorted([("object", '{"a": 1}'), ("object", '{"b": 2}'), ("object", '{"a": 2}')])


def test_converted_files_keep_apart(spark, put, tmp_path):
    out, schema = str(tmp_path / "out"), StructType.fromDDL("a bigint")
    x, y = put("x/t.json", '{"a": 1}\nbroken {\n'), put("y/t.json", '{"a": 2}\n')
    sinks.convert_to_parquet(spark, [x, y], out, schema=schema)
    put("y/t.json", '{"a": 3}\n{"a": 4}\n')
    spark.catalog.refreshByPath(y)
    sinks.convert_to_parquet(spark, [y], out, schema=schema)
    sinks.convert_to_parquet(spark, [put("z/u.json", '{"a": 5}\n')], out, schema=schema)
    sources = {r["source_file"]: r["path"] for r in sinks.converted_sources(spark, out).collect()}
    assert len(sources) == 3 and "u" in sources and all(n == "u" or n.startswith("t-") for n in sources)
    found = sorted((sources[r["source_file"]].rsplit("/", 2)[1], r["a"]) for r in spark.read.parquet(out).collect())
    assert found == [("x", 1), ("y", 3), ("y", 4), ("z", 5)]


def test_broken_lines_leave_no_row(spark, put):
    raw = readers.read_json(spark, put("p.jsonl", '{"id_str": "1"}\n{"id_st'), StructType.fromDDL("id_str string"))
    assert [r["tweet_id"] for r in shaping.extract_relevant(raw).collect()] == ["1"]


def test_ranks_together(spark, monkeypatch):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 3000), np.full(3000, 0.5), rng.exponential(1e6, 500), [float("inf"), float("-inf"), -0.0]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    ordered = np.sort(values)
    for few in (50_000, 10):
        monkeypatch.setattr(ranks, "SORT_AT_MOST", few)
        wanted = [0, 1, 17, 1500, 2999, 3000, 4500, 6000, 6499, len(values) - 2, len(values) - 1]
        assert ranks.values_at_ranks(df, "v", wanted) == [ordered[i] for i in wanted]
        shares = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99]
        assert ranks.percentiles(df, "v", shares)[1:] == pytest.approx([float(np.percentile(values, 100 * s)) for s in shares][1:])


def test_few_jobs(spark):
    df = spark.range(100_000).selectExpr("id", "CAST((id * 7919) % 10007 AS double) AS v", "CAST(id % 13 AS double) AS w")
    row, n = jobs_of(spark, lambda: profile.column_profile(df, "v").first())
    assert row["median"] == float(np.median([(i * 7919) % 10007 for i in range(100_000)])) and n <= 6
    _, n = jobs_of(spark, lambda: isolation.isolation_forest(df.limit(2000), ["v", "w"], key="id", trees=5, sample_rows=64))
    assert n <= 25


def test_keywords_in_capitals(spark):
    df = spark.createDataFrame([("please HELP us",)], "t string")
    assert df.select(found_keywords(F.col("t"), ["Help", "fire"]).alias("k")).first()["k"] == "Help"


def test_columns_with_inner_names_stay(spark):
    assert unused_name(["a", "A_"], "a") == "a__"
    rows = [(i, float(i % 7), float(i % 3), f"t{i % 4}", "kept") for i in range(80)]
    df = spark.createDataFrame(rows, "id long, x0 double, x1 double, x0_number string, x0_cleaned string")
    found = dbscan.dbscan(df, ["x0", "x1"], key="id", eps=0.5, min_samples=2)
    assert found.columns == [*df.columns, "cluster"] and found.count() == 80
    ready = features.cluster_features(df, ["x0", "x0_number"])
    assert ready.columns == [*df.columns, "features"] and {r["x0_number"] for r in ready.collect()} == {"t0", "t1", "t2", "t3"}
    assert {r["x0_cleaned"] for r in features.supervised_features(df, ["x0", "x0_number"], "x1").collect()} == {"kept"}


def test_nothing_stays_cached(spark):
    rows = [(i, float(i % 17), float(i % 5), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    fitted = supervised.random_forest(df, ["a", "b"], "y", key="id", trees=[3], depths=[2], folds=2)
    supervised.linear_regression(df, ["b"], "a", key="id")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before and fitted.predictions.count() > 0


def test_too_many_classes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(supervised, "MAX_CLASSES", 5)
    df = spark.range(100).selectExpr("id", "CAST(id AS double) AS a", "CAST(id % 9 AS string) AS y")
    with pytest.raises(ValueError, match="9 classes"):
        supervised.random_forest(df, ["a"], "y", key="id")


def test_null_keys_are_split_too(spark):
    df = spark.range(60).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS key", "id")
    train, test = supervised.split(df, key="key")
    assert train.count() + test.count() == 60


def test_deep_paths_in_few_levels(spark):
    text = '{"a": {"b": {"c": {"d": {"e": {"f": {"g": 1}}}}}}, "x": 1}'
    df = spark.createDataFrame([(text,), ('{"a": 2}',), ('{"a": {"b": {"c": {"d": 5}}}}',), ("broken",), (None,)], "value string")
    found = {(r["path"], r["type"]): (r["records"], r["unexpanded"]) for r in paths.typed_paths(df).collect()}
    assert found[("a.b.c.d.e.f.g", "int")] == (1, 0) and found[("a.b.c.d", "int")] == (1, 0) and found[("a.b.c.d", "dict")] == (1, 0)
    assert found[("a", "dict")] == (2, 0) and found[("a", "int")] == (1, 0) and all(left == 0 for _, left in found.values())
    cut = {(r["path"], r["type"]): r["unexpanded"] for r in paths.typed_paths(df, max_depth=4).collect()}
    assert max(len(p.split(".")) for p, _ in cut) == 4 and cut["a.b.c.d", "dict"] == 1


def test_range_questions_read_roll_ups(spark, tmp_path):
    text = lambda d, h, m: f"Sat Aug {d:02d} {h:02d}:{m:02d}:00 +0000 2017"
    rows = [(str(i), text(1 + i % 9, i % 24, i % 60)) for i in range(500)] + [("x", None)]
    author = "struct<user:struct<name:string,screen_name:string,followers_count:bigint>,id_str:string,favorite_count:bigint>"
    df = spark.createDataFrame(rows, "id_str string, created_at string").withColumn("retweeted_status", F.lit(None).cast(author))
    folder, sums = str(tmp_path / "posts"), str(tmp_path / "sums")
    for load, part in (("one", 0), ("two", 1), ("two", 1)):
        sinks.save_posts(df.filter(F.pmod(F.xxhash64("id_str"), F.lit(2)) == part), folder, load)
        rollups.save_rollups(spark, folder, sums, load)
    for start, end in (("2017-08-02T03:30:00+00:00", "2017-08-07T10:00:00+00:00"), ("2017-08-03T00:00:00Z", "2017-08-05T00:00:00Z"), ("2017-08-04T05:00:00Z", "2017-08-04T09:00:00Z")):
        found = rollups.volume_by_minute(spark, folder, sums, start=start, end=end)
        expected = filters.by_time(df, start=start, end=end).count()
        assert found.agg(F.sum("Volume_Tweet")).first()[0] == expected > 0
        plan = found._jdf.queryExecution().toString()
        assert all("day" in part.split("]")[0] for part in plan.split("== Physical Plan ==")[1].split("PartitionFilters: [")[1:])


def test_scratch_is_freed(spark, monkeypatch):
    from tidemark import session

    monkeypatch.setattr(session, "_SCRATCH", [])
    kept = session.settle(spark.range(5))
    assert kept.count() == 5 and len(session._SCRATCH) == 1
    folder = session._SCRATCH[0].removeprefix("file:")
    import os

    assert os.path.isdir(folder) and session.free_scratch(spark) == 1 and not os.path.exists(folder) and not session._SCRATCH


def test_clusters_do_not_hang_on_partitions(spark):
    from tidemark.ml import cluster

    rng = np.random.default_rng(3)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.concatenate([rng.normal(c, 1, (150, 2)) for c in (0, 6, 14)]))]
    rows += [(1000 + i, 6.0, 6.0) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    for method in (cluster.k_means, cluster.bisecting_k_means):
        found = [method(df.repartition(n, "id"), ["x", "y"], max_k=5) for n in (2, 8)]
        labels = [{r["id"]: r["cluster"] for r in f.rows.collect()} for f in found]
        assert labels[0] == labels[1] and len(labels[0]) == len(rows)
        assert found[0].k == found[1].k and found[0].silhouette == pytest.approx(found[1].silhouette)
