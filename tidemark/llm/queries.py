"""The queries of the operators: each applies one to a whole table, with its production parameters."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, html, langid, licenses, merkle, mixing, mtree, quality, runs, simhash, tokencount, toxicity, urls
from tidemark.llm.common import bounded_batches, remainder
from tidemark.session import settle

#: Fixed URL rules of the query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
TOKENIZER = "word_bpe_49k.json"
COUNTED_WITH = "piece_bpe_32k.model"
#: Tokens above which a document is over the limit.
TOKEN_LIMIT = 4096
#: Shares of tokens by language.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def is_remainder(doc_id: str, by: int, rest: int) -> Column:
    return F.coalesce(remainder(doc_id, by) == rest, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(id, text, lang, label) of documents with a label that is not null; one label for an id, the highest."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max(label).alias(label))
    rows = docs.select(F.col("doc_id").alias("id"), "text", "lang")
    return rows.join(known, "id")


def picked(labels: DataFrame, label: str, each: int, where: Column | None = None) -> DataFrame:
    """(doc_id, label) of the ``each`` ids with the lowest hash of each of the labels 0 and 1: few rows, found
    without their texts."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = (known if where is None else known.filter(where)).groupBy("doc_id").agg(F.max(label).alias(label))
    part = lambda x: known.filter(F.col(label) == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each)
    return settle(part(0).unionByName(part(1)))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = labels.filter(F.col("toxic").isin(0, 1) & ~is_remainder("doc_id", 5, 0))
    # The join deals the texts out in the shards of the training, so they move once.
    shards = toxicity.shards_of(learned.select("doc_id").distinct().count())
    rows = labelled(docs.repartition(shards, "doc_id"), learned.repartition(shards, "doc_id"), "toxic")
    score = toxicity.score(F.col("text"), toxicity.fit(rows.withColumn("calibrate", is_remainder("id", 5, 1)), dealt=shards))
    scored = docs.select("doc_id", is_remainder("doc_id", 5, 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    # The number that ends a page's path is that of the document it shows.
    shown = pages.withColumn("doc_id", F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/(?:[^?#]*/)?([0-9]+)(?:[.]html|/)?(?:[?#]|$)', 1) AS bigint)"))
    verdict = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    # One label for an id, the worse of several.
    worst = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(verdict).alias("verdict"))
    known = shown.select("url", "doc_id").join(worst, "doc_id")
    judged = urls.judge(pages, URL_RULES, urls.mine(known))
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.confidence")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = docs.filter(~is_remainder("doc_id", 4, 2)).select(F.col("doc_id").alias("id"), "text", "lang")
    found = langid.identify(F.col("text"), langid.fit(learned))
    judged = docs.select("doc_id", is_remainder("doc_id", 4, 2).alias("held_out"), found.alias("found"))
    return judged.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def encoded(docs: DataFrame) -> DataFrame:
    """Digests of the ids and the decoded text of each document."""
    import public_tokenizers

    coded = bpe.encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", html.main_text(F.col("html"), html.fit(pages)).alias("found"))
    return found.select("page_id", "url", "found.text", F.length("found.text").cast("long").alias("n_chars"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = quality.fit(labelled(docs, picked(labels, "quality", 2000), "quality"), 4000)
    judged = docs.select("doc_id", quality.rules(F.col("text"), field).alias("judged"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]
    return judged.select("doc_id", *[f"judged.{name}" for name in names])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.scan(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        F.size("found.sentences").cast("long").alias("n_sentences"),
        F.array_join("found.licenses", ",").alias("licenses"),
        licenses.terms(F.col("found.licenses")).alias("terms"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    domains = mixing.fit(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("domain")))
    mixed = mixing.mix(docs, domains, TARGETS, keep=["doc_id"])
    posteriors = [F.col("mixed.p")[i].alias(f"p_{name}") for i, name in enumerate(domains.names)]
    rate = F.col("mixed.rate")
    return mixed.select("doc_id", "mixed.tokens", "mixed.domain", *posteriors, rate.alias("rate"), mixing.copies(rate, "doc_id").alias("copies"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by the hash of the id, the words from one place on repeat a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    chosen = chosen.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("rest", n - F.col("a"))
    chosen = chosen.withColumn("p", F.lit(1) + F.floor(F.col("rest") / (F.lit(3) + F.col("g") % 8)))
    number = lambda c: c.cast("int")
    period = F.slice("words", number(F.col("a") + 1), number(F.col("p")))
    repeated = F.flatten(F.array_repeat(period, number(F.ceil(F.col("rest") / F.col("p")))))
    words = F.concat(F.slice("words", F.lit(1), number(F.col("a"))), F.slice(repeated, F.lit(1), number(F.col("rest"))))
    return chosen.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(words, " ")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = with_planted_period(table(spark, sf_dir, "documents"))
    found = planted.select("doc_id", runs.runs(F.col("text")).alias("found"))
    best = found.select("doc_id", "found", runs.longest(F.col("found.runs")).alias("best"))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return best.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("found.runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("found.collapsed", 256).alias("collapsed_sha256"),
    )


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    of_row = lambda n_chars: merkle.leaf("doc_id", "source", "lang", n_chars, "text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, of_row(F.try_add("n_chars", F.lit(1))))
    leaves = docs.select("doc_id", "lang", of_row("n_chars").alias("leaf"), tampered.alias("tampered"))
    proved = merkle.manifest(leaves, "lang", "doc_id", "leaf", ["doc_id", "tampered"])
    again = merkle.folded(F.coalesce("row.tampered", "leaf"), F.col("path")).alias("folded_root")
    shown = proved.select("row.doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), again)
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = """
WITH RECURSIVE t AS (
  SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents
),
d AS (
  SELECT doc_id, lang, leaf, CASE WHEN crc % 7 = 0 THEN changed ELSE leaf END AS shown,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM (
    SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || body) AS leaf,
      sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || body) AS changed,
      xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT for i in range(1, len(doc_id::VARCHAR) + 1)]),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
          lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) AS crc
    FROM t
  )
),
nodes AS (
  SELECT 0 AS level, lang, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS size FROM d
  UNION ALL
  SELECT level + 1, lang, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 1) // 2
  FROM nodes WHERE size > 1 GROUP BY level, lang, place // 2
),
sub AS (
  SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE size = 1
),
tops AS (
  SELECT 0 AS level, place, subroot AS digest, count(*) OVER () AS size FROM sub
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 1) // 2
  FROM tops WHERE size > 1 GROUP BY level, place // 2
),
every AS (
  SELECT s.place AS tree, n.level, n.place, n.digest FROM nodes n JOIN sub s ON n.lang IS NOT DISTINCT FROM s.lang WHERE n.size > 1
),
steps AS (
  SELECT a.tree, a.level, a.place, b.digest AS sibling FROM every a LEFT JOIN every b
    ON a.tree = b.tree AND a.level = b.level AND b.place = xor(a.place, 1)
),
top_steps AS (
  SELECT a.level, a.place, b.digest AS sibling FROM (SELECT * FROM tops WHERE size > 1) a LEFT JOIN tops b
    ON a.level = b.level AND b.place = xor(a.place, 1)
),
walk AS (
  SELECT d.doc_id, d.leaf, s.place AS tree, s.subroot, s.height, d.place AS at, 0 AS level, d.shown AS node, '' AS siblings,
    d.place AS number
  FROM d JOIN sub s ON d.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.subroot, w.height, w.at // 2, w.level + 1,
    sha256(CASE WHEN w.at % 2 = 0 THEN w.node || coalesce(s.sibling, '') ELSE s.sibling || w.node END),
    w.siblings || coalesce(s.sibling, ''), w.number
  FROM walk w JOIN steps s ON w.tree = s.tree AND w.level = s.level AND w.at = s.place
),
up AS (
  SELECT doc_id, leaf, subroot, tree AS at, 0 AS level, node, siblings, tree, number FROM walk WHERE level = height
  UNION ALL
  SELECT u.doc_id, u.leaf, u.subroot, u.at // 2, u.level + 1,
    sha256(CASE WHEN u.at % 2 = 0 THEN u.node || coalesce(s.sibling, '') ELSE s.sibling || u.node END),
    u.siblings || coalesce(s.sibling, ''), u.tree, u.number
  FROM up u JOIN top_steps s ON u.level = s.level AND u.at = s.place
)
SELECT u.doc_id, u.leaf, u.subroot, t.digest AS root, sha256(u.siblings) AS proof_sha256, u.node AS folded_root,
  u.node = t.digest AS verified
FROM up u JOIN tops t ON t.size = 1 AND u.level = t.level
"""


def op13_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    count = tokencount.n_tokens(F.col("text"), public_tokenizers.path(COUNTED_WITH))
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), count.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


OPERATORS = (
    op1_toxicity, op2_url_filter, op3_top_k, op4_language, op5_bpe, op6_main_text, op7_quality, op8_simhash, op9_licenses,
    op10_mixing, op11_runs, op12_manifest, op13_token_count,
)
QUERIES = {f.__name__: f for f in OPERATORS}
ORACLES = {"op3_top_k": OP3_SQL.strip(), "op9_licenses": licenses.oracle().strip(), "op12_manifest": OP12_SQL.strip()}
