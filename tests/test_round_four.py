"""Derived posts whose texts are joined last, training tables made once, linear bracket windows, SimHash in the pipeline."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import checked_ml
from tidemark.plans.posts import derived_posts
from tidemark.session import settle
from tidemark.sources import repair


@pytest.fixture
def tables(spark, tmp_path):
    """Posts 0 to 39 with a view of each kind of original: there, twice, without a document, without an author."""
    kinds = ("view", "click", "error", "signup", "purchase")
    at = datetime.datetime(2024, 1, 3, 6)
    events = [(i, at, 1 + i % 3, kinds[i % 5] if i % 10 else "click", 1.5, f'{{"k": {i}}}') for i in range(40)]
    events += [(10, at, 1, "click", 9.0, '{"k": 1}'), (None, at, 1, "view", 1.0, None), (45, at, 1, "view", 1.0, None), (20, at, 9, "click", 1.0, None)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    people = [(i, f"C{i}", 100.0, i, "BUILDING") for i in (1, 2, 3)]
    spark.createDataFrame(people, "c_custkey bigint, c_name string, c_acctbal double, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    documents = [(i, f"text {i}", "en") for i in range(37) if i != 30] + [(7, "seven again", "de")]
    spark.createDataFrame(documents, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), events, {p[0] for p in people}, documents


def test_posts_are_those_of_the_joins_one_by_one(spark, tables):
    folder, events, people, documents = tables
    n = max(d[0] for d in documents) + 1
    flat = [(e[0], e[3], d[1]) for e in events if e[0] is not None and e[2] in people for d in documents if d[0] == e[0] % n]
    wanted = []
    for id_, kind, text in flat:
        of = [t for i, _, t in flat if kind == "view" and i == id_ - id_ % 10]
        wanted += [(id_, text, t) for t in of] or [(id_, text, None)]
    text = lambda inside: F.coalesce(f"{inside}full_text", f"{inside}extended_tweet.full_text", f"{inside}text")
    posts = derived_posts(spark, folder)
    found = posts.select("id", text("").alias("own"), text("retweeted_status.").alias("of"), F.col("retweeted_status").isNull().alias("plain")).collect()
    assert sorted((r.id, r.own, r.of or "") for r in found) == sorted((i, t, o or "") for i, t, o in wanted)
    assert all(r.plain == (r.of is None) for r in found)


def shuffles(df):
    """The exchanges of a plan, with their columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange hashpartitioning" in line]


def test_no_shuffle_carries_an_own_text_and_null_tests_read_none(spark, tables):
    posts = derived_posts(spark, tables[0])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = posts.select("id", F.coalesce("full_text", "extended_tweet.full_text", "text").alias("body"))
        moved = shuffles(own)
        assert sum("text" in line for line in moved) == 1, moved  # the documents themselves
        for reshare in (True, False):
            test = F.col("retweeted_status").isNotNull() if reshare else F.col("retweeted_status").isNull()
            asked = posts.filter(test).select("id", "retweeted_status.user.name")
            assert "text" not in asked._jdf.queryExecution().optimizedPlan().toString().replace("Relation", "\nRelation").split("Relation")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_training_tables_are_stored_and_hold_no_text(spark, tables):
    table = checked_ml.viral_set(spark, tables[0])
    assert "Join" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert table.columns == ["tweet_id", "Followers", "is_verified", "is_viral"]
    assert "TestoTweet" not in checked_ml.help_set(spark, tables[0]).columns


def test_no_window_sums_up_the_rest_of_a_block_for_each_line(spark, tmp_path):
    path = tmp_path / "joined.json"
    path.write_text('{"a": 1}{"b": [1,\n2]} }garbage, {"a": 2}\n{"c": {\n"d": 3}}\n{"open": [\n{"a": 4}\n')
    pieces = repair.recover_json(spark, str(path))
    plan = pieces._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedfollowing" not in plan
    assert sorted(r.json for r in pieces.filter("kind = 'object'").collect()) == ['{"a": 1}', '{"a": 2}', '{"a": 4}', '{"b": [1,\n2]}', '{"c": {\n"d": 3}}']


def test_pipeline_keeps_one_document_of_each_simhash_component(spark):
    """Two texts with equal fingerprints and few common shingles: each word sequence comes often in one and once in the other."""
    import corpus_pipeline
    from tidemark.llm import simhash

    often = " ".join(["a b c d e f g"] * 60)
    rare = " ".join(f"x{i}" for i in range(12))
    texts = [f"{often} {rare}", f"{often} {' '.join(reversed(rare.split()))}", " ".join(f"w{i}" for i in range(50))]
    docs = spark.createDataFrame([(10 + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    found = {r.id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert found == {10: 10, 11: 10, 12: 12}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {10, 12}
