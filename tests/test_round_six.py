"""Derived posts whose long values are made after the joins, and posts without texts."""

import datetime
import zlib

import pytest

from tidemark.llm import queries, toxicity
from tidemark.plans import posts as made
from tidemark.plans.checked_sources import post_lines, s12
from tidemark.session import settle


@pytest.fixture
def folder(spark, tmp_path):
    kinds = ("view", "click", "error", "signup", "purchase")
    at = datetime.datetime(2024, 1, 3, 6)
    events = [(i, at, i % 3, kinds[i % 5] if i % 10 else "click", 1.5, f'{{"k": {i}}}') for i in range(40)] + [(None, at, 1, "view", None, None)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    people = [(i, f"C{i}", i, 100.0, "BUILDING") for i in (0, 1, 2, 2)]
    spark.createDataFrame(people, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    documents = [(i, f"text {i}", "en") for i in range(39) if i != 30] + [(7, None, "de")]
    spark.createDataFrame(documents, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_posts_without_texts_are_the_posts_less_their_text_fields(spark, folder):
    whole, bare = made.derived_posts(spark, folder), made.posts(spark, folder, texts=False)
    inner = whole.schema["retweeted_status"].dataType.fieldNames()
    assert bare.columns == [c for c in whole.columns if c not in ("text", "full_text", "extended_tweet")]
    assert bare.schema["retweeted_status"].dataType.fieldNames() == [n for n in inner if n not in ("text", "full_text", "extended_tweet")]
    less = whole.select(bare.columns).withColumn("retweeted_status", whole["retweeted_status"].dropFields("text", "full_text", "extended_tweet"))
    assert sorted(map(str, less.collect())) == sorted(map(str, bare.collect()))


def test_texts_and_long_values_do_not_travel_unasked(spark, folder):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (s12(spark, folder), post_lines(spark, folder), made.derived_posts(spark, folder)):
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
            below = [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange hashpartitioning" in line]
            assert below and not any(name in line for line in below for name in ("place_box", "created_at", "point", "user_name")), below
        for df in (s12(spark, folder), post_lines(spark, folder)):
            assert "text" not in df._jdf.queryExecution().executedPlan().toString().replace("texts", "")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_texts_that_a_join_dealt_out_move_once_in_training(spark, tmp_path, monkeypatch):
    """Shards hold the ids of their hash, and every labelled row outside the hold-out is in one."""
    monkeypatch.setattr(toxicity, "CHUNK_ROWS", 20)
    monkeypatch.setattr(queries, "table", lambda _, folder, name: spark.read.parquet(f"{folder}/{name}.parquet"))
    spark.createDataFrame([(i, f"foul word{i % 3} ha" if i % 2 else f"kind word{i % 3} ho", "en") for i in range(150)], "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 150) if i % 5], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stored = []
    monkeypatch.setattr(toxicity, "settle", lambda df: stored.append(df) or settle(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.op1_toxicity(spark, str(tmp_path)).collect()
        lines = stored[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 150 and all(r.predicted == r.doc_id % 2 for r in found)
    moved = [line for line in lines if "Exchange" in line]
    assert len(moved) == 2 and not any("shard" in line for line in moved), moved  # texts and labels, each by the id
    held = {i for i in range(150) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert stored[0].count() == len([i for i in range(150) if i % 5 and i not in held])


def test_word_numbers_are_those_of_one_text_at_a_time(monkeypatch):
    texts = ["foul word ha", None, "", "kind word ho ho", "new foul"] * 3
    model = toxicity.train(texts, [1, 0, 0, 0, 1] * 3, ["en"] * 15, [False] * 15, steps=5)
    raw = [None if t is None else t.encode() for t in texts]
    together = toxicity._answers(model, toxicity.WordVectors(model), raw)
    monkeypatch.setattr(toxicity, "REMEMBERED", 2)
    numbers = toxicity.WordVectors(model)
    alone = [toxicity._answers(model, numbers, [t]) for t in raw]
    assert [float(a[0][0]) for a in alone] == pytest.approx(together[0].tolist(), abs=1e-5) and len(numbers) <= 6
    assert [int(a[1][0]) for a in alone] == together[1].tolist()
