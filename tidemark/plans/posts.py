"""Posts derived from the given tables ``events``, ``customer`` and ``documents``.

The tables hold no posts, so each event becomes one: its author is the customer, its text the
document, its counters come from ``value`` and ``props``. A view event reshares another event.
``POSTS_SQL`` is the same derivation as a common table expression named ``posts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table in fewer parts than there are cores, spread over them; others as they are.

    The given files have one part each, on which all later work of a post would run in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: What a post is made of: an event, the key of its text, and its author. Long values are made of these after the joins.
_RAW = [
    "id", "ts", "event_type", "value", "retweet_count", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
]


def _bare_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with its author, and the key of its text; the text itself is not there yet."""
    documents = table(spark, sf_dir, "documents")
    events = spread(table(spark, sf_dir, "events"))
    n_docs = documents.agg((F.max("doc_id") + 1).alias("n")).scalar()
    id_ = F.col("event_id")
    made = {"id": id_, "retweet_count": F.get_json_object("props", "$.k").try_cast("bigint")}
    return (
        events.withColumn("doc_key", id_ % n_docs)
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .withColumns(made)
        .select("doc_key", *_RAW)
    )


def _with_texts(rows: DataFrame, spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The rows with these columns of their documents, the text as ``doc_text``; rows without a document are left out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("doc_text"), "lang")
    return rows.join(documents.select("doc_id", *columns), F.col("doc_key") == F.col("doc_id"))


def _text_fields(of: str = "") -> dict[str, Column]:
    """The text stands in ``full_text``, in ``extended_tweet`` or in ``text``, by the counter k."""
    k = F.coalesce(F.col(f"{of}retweet_count"), F.lit(0))
    return {name: F.when(k % 3 == i, F.col(f"{of}doc_text")) for i, name in enumerate(("full_text", "extended_text", "text"))}


def _fields(of: str = "", texts: bool = True) -> dict[str, Column]:
    """The values of a post by their flat names, from its raw columns."""
    id_, key, kind, ts = [F.col(of + name) for name in ("id", "c_custkey", "event_type", "ts")]
    lon, lat = id_ % 360 - 180, id_ % 180 - 90
    corner = lambda dx, dy: F.concat(
        F.lit("["), (lon + dx).cast("string"), F.lit(", "), (lat + dy).cast("string"), F.lit("]")
    )
    counter = F.col(f"{of}retweet_count")
    made = {
        "id_str": id_.cast("string"),
        "created_at": F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(ts, "yyyy")),
        "favorite_count": F.floor(f"{of}value").cast("bigint"),
        "retweet_count": counter,
        "reply_count": F.when(kind == "error", counter).otherwise(F.lit(0)),
        "quote_count": F.when(kind != "purchase", id_ % 7),
        "quoted_status_id_str": F.when(kind == "click", id_.cast("string")),
        "point": F.when(
            kind == "signup",
            F.concat(F.lit("["), lon.cast("string"), F.lit(".5, "), lat.cast("string"), F.lit(".25]")),
        ),
        "place_name": F.when(kind.isin("signup", "error"), F.concat(F.lit("Place "), F.col(f"{of}c_nationkey"))),
        "place_box": F.when(
            kind == "error",
            F.concat(
                F.lit("[["),
                F.concat_ws(", ", corner(0, 0), corner(0, 3), corner(4, 3), corner(4, 0)),
                F.lit("]]"),
            ),
        ),
        "user_id_str": key.cast("string"),
        "user_name": F.col(f"{of}c_name"),
        "user_screen": F.lower(f"{of}c_name"),
        "user_about": F.col(f"{of}c_mktsegment"),
        "user_followers": F.greatest(F.floor(f"{of}c_acctbal").cast("bigint"), F.lit(0)),
        "user_friends": key % 50 * 100,
        "user_verified": key % 5 == 0,
    }
    return made | (_text_fields(of) if texts else {})


def flat_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, without nesting."""
    made = {"id": F.col("id"), "event_type": F.col("event_type"), "lang": F.col("lang")} | _fields()
    order = [
        "id", "id_str", "created_at", "event_type", "lang", "text", "full_text", "extended_text",
        "favorite_count", "retweet_count", "reply_count", "quote_count", "quoted_status_id_str",
        "point", "place_name", "place_box", "user_id_str", "user_name", "user_screen",
        "user_about", "user_followers", "user_friends", "user_verified",
    ]
    return _with_texts(_bare_posts(spark, sf_dir), spark, sf_dir, "doc_text", "lang").select(*[made[name].alias(name) for name in order])


def _author(made: dict[str, Column]) -> Column:
    return F.struct(
        made["user_id_str"].alias("id_str"),
        made["user_name"].alias("name"),
        made["user_screen"].alias("screen_name"),
        made["user_about"].alias("description"),
        made["user_followers"].alias("followers_count"),
        made["user_friends"].alias("friends_count"),
        made["user_verified"].alias("verified"),
    )


_TEXTS = ("text", "full_text", "extended_tweet")
_POST_FIELDS = ("id_str", "created_at", *_TEXTS, "favorite_count", "retweet_count", "reply_count", "quote_count")


def _post_fields(made: dict[str, Column], texts: bool) -> list[Column]:
    made = dict(made)
    if texts:
        extended = made["extended_text"]
        made["extended_tweet"] = F.when(extended.isNotNull(), F.struct(extended.alias("full_text")))
    return [*[made[name].alias(name) for name in _POST_FIELDS if texts or name not in _TEXTS], _author(made).alias("user")]


#: Folders of given tables whose posts are stored, and where.
_STORED: dict[str, str] = {}


def store_posts(spark: SparkSession, sf_dir: str) -> None:
    """Write the posts of a folder of tables once; later queries of this process read them there, as an archive is read. For the
    benchmark, which measures queries and not the derivation."""
    path = scratch_path(spark, "posts")
    derived_posts(spark, sf_dir).write.parquet(path)
    _STORED[sf_dir] = path


def posts(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """The nested post table; without the text fields of the posts and their originals if ``texts`` is false."""
    if sf_dir not in _STORED:
        return derived_posts(spark, sf_dir, texts)
    stored = spark.read.parquet(_STORED[sf_dir])
    return stored if texts else stored.drop(*_TEXTS).withColumn("retweeted_status", F.col("retweeted_status").dropFields(*_TEXTS))


def derived_posts(spark: SparkSession, sf_dir: str, texts: bool = True) -> DataFrame:
    """The posts made from the tables.

    Texts are joined last: the long rows then go nowhere. What is made of an event is made after the joins, which move the
    event's own few columns. Spark does not see that texts of originals are not used where two fields of an original are, so
    a query without texts says so.
    """
    bare = _bare_posts(spark, sf_dir)
    # Only ids that end in 0 are reshared.
    originals = _with_texts(bare.filter(F.col("id") % 10 == 0), spark, sf_dir, *["doc_text"] * texts)
    originals = originals.select(*[F.col(name).alias(f"original_{name}") for name in [*_RAW, *["doc_text"] * texts]])
    # Rows that reshare nothing get a key of their own, so no task receives all of them.
    wanted = F.when(F.col("event_type") == "view", F.col("id") - F.col("id") % 10).otherwise(-1 - F.col("id"))
    reshares = bare.withColumn("wanted", wanted).join(originals, F.col("wanted") == F.col("original_id"), "left")
    made, original = _fields(texts=texts), _fields("original_", texts)
    point = F.struct(made["point"].alias("coordinates"), F.lit("Point").alias("type"))
    place = F.struct(
        made["place_name"].alias("name"),
        F.struct(made["place_box"].alias("coordinates"), F.lit("Polygon").alias("type")).alias("bounding_box"),
    )
    return _with_texts(reshares, spark, sf_dir, "lang", *["doc_text"] * texts).select(
        F.col("id"),
        F.col("lang"),
        *_post_fields(made, texts),
        made["quoted_status_id_str"].alias("quoted_status_id_str"),
        F.when(made["point"].isNotNull(), point).alias("coordinates"),
        F.when(made["place_name"].isNotNull(), place).alias("place"),
        F.when(F.col("original_id").isNotNull(), F.struct(*_post_fields(original, texts))).alias("retweeted_status"),
    )


POSTS_SQL = """
p0 AS (
  SELECT e.event_id AS id, CAST(e.event_id AS varchar) AS id_str,
    strftime(e.ts, '%a %b %d %H:%M:%S +0000 %Y') AS created_at,
    CAST(date_trunc('day', e.ts) AS date) AS day, strftime(e.ts, '%H:%M') AS minute,
    e.event_type, d.lang, d.text AS body,
    CAST(floor(e.value) AS bigint) AS favorite_count,
    try_cast(json_extract_string(e.props, '$.k') AS bigint) AS retweet_count,
    CASE WHEN e.event_type <> 'purchase' THEN e.event_id % 7 END AS quote_count,
    CASE WHEN e.event_type = 'click' THEN CAST(e.event_id AS varchar) END AS quoted_status_id_str,
    CASE WHEN e.event_type = 'signup' THEN CAST((e.event_id % 360 - 180) || '.5' AS double) END AS point_lon,
    CASE WHEN e.event_type = 'signup' THEN CAST((e.event_id % 180 - 90) || '.25' AS double) END AS point_lat,
    CASE WHEN e.event_type = 'error' THEN e.event_id % 360 - 180 END AS box_lon,
    CASE WHEN e.event_type = 'error' THEN e.event_id % 180 - 90 END AS box_lat,
    CASE WHEN e.event_type IN ('signup', 'error') THEN 'Place ' || u.c_nationkey END AS place_name,
    CAST(u.c_custkey AS varchar) AS user_id_str, u.c_name AS user_name, lower(u.c_name) AS user_screen,
    u.c_mktsegment AS user_about, greatest(CAST(floor(u.c_acctbal) AS bigint), 0) AS user_followers,
    u.c_custkey % 50 * 100 AS user_friends, u.c_custkey % 5 = 0 AS user_verified
  FROM events e
  JOIN customer u ON e.user_id = u.c_custkey
  JOIN documents d ON d.doc_id = e.event_id % (SELECT max(doc_id) + 1 FROM documents)
), p1 AS (
  SELECT *, CASE WHEN event_type = 'error' THEN retweet_count ELSE 0 END AS reply_count,
    CASE coalesce(retweet_count, 0) % 3 WHEN 0 THEN body END AS full_text,
    CASE coalesce(retweet_count, 0) % 3 WHEN 1 THEN body END AS extended_text,
    CASE coalesce(retweet_count, 0) % 3 WHEN 2 THEN body END AS "text"
  FROM p0
), posts AS (
  SELECT p.*, o.id IS NOT NULL AS is_reshare, o.id_str AS rt_id_str, o."text" AS rt_text,
    o.full_text AS rt_full_text, o.extended_text AS rt_extended_text, o.body AS rt_body,
    o.favorite_count AS rt_favorite_count, o.retweet_count AS rt_retweet_count,
    o.reply_count AS rt_reply_count, o.quote_count AS rt_quote_count, o.user_name AS rt_user_name,
    o.user_screen AS rt_user_screen, o.user_about AS rt_user_about,
    o.user_followers AS rt_user_followers, o.user_verified AS rt_user_verified
  FROM p1 p LEFT JOIN p1 o ON p.event_type = 'view' AND o.id = p.id - p.id % 10
)
"""


def with_posts(body: str) -> str:
    """A query on the common table expression ``posts``."""
    return f"WITH {POSTS_SQL.strip()}\n{body.strip()}"
