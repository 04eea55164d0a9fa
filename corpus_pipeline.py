"""The corpus pipeline: quality, language, near duplicates, mixing, tokens. Each stage's result is written and reread.

Every stage works on all documents that the one before kept, and keeps their columns; the last gives token counts and
digests. Null ids and texts, empty tables and further columns pass as each operator states.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, quality, shingles, simhash
from tidemark.llm.common import bounded_batches
from tidemark.llm.queries import encoded, is_remainder, labelled, picked, table
from tidemark.session import release, scratch_path, settle

#: A language found with less certainty rejects a document.
LEAST_LANGUAGE_SCORE = 0.1
#: Domains get their natural share to this power, so that small ones are repeated; none shrinks.
FLATTENING = 0.7


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the line field."""
    bounded_batches(spark)
    field = quality.fit(labelled(docs, picked(table(spark, sf_dir, "labels"), "quality", 2000), "quality"), 4000)
    release(spark)
    return docs.filter(quality.rules(F.col("text"), field)["kept"])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with some certainty."""
    bounded_batches(spark)
    learned = docs.filter(~is_remainder("doc_id", 4, 2)).select(F.col("doc_id").alias("id"), "text", "lang")
    model = langid.fit(learned)
    release(spark)
    return docs if model is None else docs.filter(langid.identify(F.col("text"), model)["score"] >= LEAST_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, then text hash. SimHash components, as
    ``op8_simhash`` finds them, are near copies, and so are texts whose shingle sets are alike; a group holds all that either links.

    An id that is no whole number counts by a hash of it, a null one by that of its text, both below zero. Rows with one id and different texts are
    documents of their own; of rows with equal id and text one stays."""
    bounded_batches(spark)
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text")))
    key = F.coalesce(F.col("doc_id").try_cast("long"), -1 - F.pmod(hashed, F.lit((1 << 62) - 1)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), key.alias("id"), F.xxhash64("doc_id", "text").alias("hash"), "text")
    placed = simhash.near_duplicates(keyed.select(F.struct("id", "hash").alias("place"), "text"), "place", "text")
    components = settle(placed.select("id.id", "id.hash", F.col("component_id").alias("component")).distinct())
    release(spark)
    first = shingles.first_of_groups(keyed, ["id", "hash"], linked=components)
    kept = keyed.join(first, ["id", "hash"]).groupBy("id", "hash").agg(F.any_value("row").alias("row"))
    return kept.select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says, once at least: languages by their natural shares, flattened."""
    domains = mixing.fit(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("domain")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    release(spark)
    mixed = mixing.mix(docs.select(row.alias("row"), "doc_id", "text"), domains, FLATTENING)
    times = mixing.copies(F.greatest(F.lit(1.0), F.col("mixed.rate")), "doc_id", "text")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), times)).alias("copy")).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    bounded_batches(spark)
    return encoded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]
#: Trained models and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        release(spark)
    return docs
