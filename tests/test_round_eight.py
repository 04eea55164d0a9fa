"""Whole posts in path trees, posts stored by day where they stand, and trees on counted rows."""

import datetime

import pytest

from tidemark.plans.checked_sources import s21


@pytest.fixture
def folder(spark, tmp_path):
    kinds = ("view", "click", "error", "signup", "purchase")
    at = datetime.datetime(2024, 1, 3, 6)
    events = [(i, at + datetime.timedelta(hours=i), i % 3, kinds[i % 5] if i % 10 else "click", 1.5, f'{{"k": {i}}}') for i in range(60)]
    events = [(i, t, u, "view" if i % 10 == 5 else kind, v, p) for i, t, u, kind, v, p in events]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    people = [(i, f"C{i}", i, 100.0, "BUILDING") for i in range(3)]
    spark.createDataFrame(people, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, f"text {i}", "en") for i in range(60)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_path_tree_has_the_texts_of_posts_and_originals(spark, folder):
    found = {tuple(r) for r in s21(spark, folder).collect()}
    for parent, kind in (("root", "object"), ("retweeted_status", "dict")):
        assert {(parent, kind, "text", "str"), (parent, kind, "full_text", "str"), (parent, kind, "extended_tweet", "dict")} <= found
    assert {("extended_tweet", "dict", "full_text", "str"), ("retweeted_status.extended_tweet", "dict", "full_text", "str")} <= found


def test_posts_by_day_are_written_without_a_shuffle(spark, tmp_path):
    """Long posts stay in their tasks, also where a task meets more days than it has files open."""
    from pyspark.sql import functions as F

    from tidemark.sources import sinks

    at = F.timestamp_seconds(F.lit(1503741600) + F.col("id") % 40 * 86400)
    posts = spark.range(0, 400, 1, 3).select(F.col("id").cast("string").alias("id_str"), F.concat(F.date_format(at, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(at, "yyyy")).alias("created_at"))
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    shuffles = tracker.shuffleStatuses().size()
    folder = sinks.save_posts(posts, str(tmp_path / "posts"), "one")
    assert tracker.shuffleStatuses().size() <= shuffles
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
    stored = spark.read.parquet(folder)
    assert sorted(int(r.id_str) for r in stored.collect()) == list(range(400))
    assert stored.filter(F.to_date("created_ts") != F.col("day")).count() == 0 and stored.select("day").distinct().count() == 40


def test_boosted_trees_train_on_counted_rows(spark, monkeypatch):
    """Equal rows are one with their number; scores and predictions are those of all rows."""
    from tidemark.ml import supervised

    rows = [(i, float(i % 6), float(i % 4), int(i % 6 > 2 or i % 7 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    seen = []
    counted = supervised._counted
    monkeypatch.setattr(supervised, "_counted", lambda train, folds: seen.append((train.count(), counted(train, folds))) or seen[-1][1])
    found = supervised.boosted_trees(df, ["a", "b"], "y", key="id", rounds=(3,), depths=(2,))
    [(train, small)] = seen
    assert small.agg({"rows": "sum"}).first()[0] == train > 400 and small.count() <= 12 * 2 * 3
    assert {(r.a > 2) == (r.prediction == 0) for r in found.predictions.collect()} == {True}  # label 0 is the commoner class


def test_nested_columns_as_json_are_stored_small(spark, folder, monkeypatch):
    import pyarrow.dataset as ds

    from tidemark.plans import checked_sources

    paths, written = [], checked_sources.written
    monkeypatch.setattr(checked_sources, "written", lambda *a, **k: paths.append(written(*a, **k)) or paths[-1])
    assert checked_sources.s25(spark, folder).count() == 60
    files = [f.metadata for f in ds.dataset(paths[0].removeprefix("file:")).get_fragments() if f.metadata.num_rows]
    assert {f.row_group(0).column(c).compression for f in files for c in range(f.num_columns)} == {"ZSTD"}
