"""SimHash components as groups from the start, and a driver that lets go of finished jobs."""

import time

from tidemark.llm import shingles

LEFT = 10_000_000  # bytes


def test_groups_of_another_method_join_those_found(spark):
    """Groups that shingles find on both sides of a link of SimHash are one; no other is."""
    words = [[f"w{k}x{i}" for i in range(60)] for k in range(4)]
    texts = [" ".join(words[k][: 60 - n]) for k in range(4) for n in range(3)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    linked = spark.createDataFrame([(2, 7), (3, 7), (6, 1), (9, 1)], "id long, component long")
    first = lambda **more: {r.id for r in shingles.first_of_groups(rows, ["id"], **more).collect()}
    assert first() == {0, 3, 6, 9}
    assert first(linked=linked) == {0, 6}


def test_near_copies_leave_the_driver_few_broadcasts(spark):
    """Broadcasts of finished jobs leave the driver's store during the stage, without a wait for its heap to fill."""
    import corpus_pipeline

    words = [[f"w{k}x{i}" for i in range(60)] for k in range(40)]
    texts = [" ".join(words[k][: 60 - n]) for k in range(40) for n in range(3)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    store = spark.sparkContext._jsc.sc().env().blockManager().memoryStore()
    spark.sparkContext._jvm.System.gc()
    time.sleep(3)
    before = store.memoryUsed()
    corpus_pipeline.near_duplicates(spark, docs, "")
    for _ in range(20):  # the cleaner is a thread of its own
        held = store.memoryUsed() - before
        if held <= LEFT:
            break
        time.sleep(0.5)
    assert held <= LEFT
