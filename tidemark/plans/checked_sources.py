"""Registered sources, schema work, shaping and sinks (S).

Each query writes files that Spark derives from the given tables to a fresh shared path, reads them
back through the operator, and is compared with the table the files came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from tidemark.operators import profile
from tidemark.plans.posts import posts, spread, table, with_posts
from tidemark.plans.registry import checked
from tidemark.session import scratch_path
from tidemark.sources import paths as json_paths
from tidemark.sources import readers, repair, shaping, sinks

EVENT_SCHEMA = (
    StructType()
    .add("event_id", LongType())
    .add("user_id", LongType())
    .add("event_type", StringType())
    .add("value", DoubleType())
    .add("props", StringType())
)
EVENT_NAMES = EVENT_SCHEMA.fieldNames()
EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*EVENT_NAMES)


def written(df: DataFrame, fmt: str, name: str, **options) -> str:
    """Write to a fresh shared path and return it."""
    path = scratch_path(df.sparkSession, name)
    df.write.format(fmt).options(**options).save(path)
    return path


def post_lines(spark: SparkSession, sf_dir: str, texts: bool = False) -> DataFrame:
    """The posts as JSON text, with their text fields if ``texts``; absent values leave no key."""
    return posts(spark, sf_dir, texts=texts).select(F.to_json(F.struct("*")).alias("value"))


@checked(
    "s1_tolerant_json",
    """
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type <> 'error' THEN event_type || chr(9) END AS event_type,
      CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
      CASE WHEN event_type = 'error' THEN '{"event_id": ' || event_id || ', "ev' END AS _corrupt_record
    FROM events
    """,
)
def s1(spark, sf_dir):
    """Unquoted names, single quotes, leading zeros, control characters; errors are cut short."""
    dirty = F.concat(
        F.lit("{event_id: "), F.col("event_id"), F.lit(", 'event_type': \""), F.col("event_type"),
        F.lit("\t\", 'user_id': 00"), F.col("user_id"), F.lit("}"),
    )
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "ev'))
    line = F.when(F.col("event_type") == "error", cut).otherwise(dirty).alias("value")
    path = written(events(spark, sf_dir).select(line), "text", "dirty.jsonl")
    schema = StructType.fromDDL("event_id bigint, event_type string, user_id bigint")
    return readers.read_json(spark, path, schema)


@checked("s2_tolerant_csv", "SELECT event_id, user_id, CASE event_type WHEN 'view' THEN NULL ELSE event_type END AS event_type, value, props FROM events")
def s2(spark, sf_dir):
    blank = F.when(F.col("event_type") == "view", "").otherwise(F.concat(F.lit("  "), "event_type", F.lit(" ")))
    raw = events(spark, sf_dir).withColumn("event_type", blank)
    path = written(raw, "csv", "events.csv", header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_csv(spark, path, EVENT_SCHEMA).drop(readers.CORRUPT)


@checked("s2b_inferred_csv", EVENTS_SQL)
def s2b(spark, sf_dir):
    path = written(events(spark, sf_dir), "csv", "events.csv", header=True, escape='"')
    return readers.read_csv(spark, path).select(
        F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "event_type", "value", "props"
    )


@checked(
    "s3_merged_parquet",
    """
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN value END AS value, event_type FROM events
    """,
)
def s3(spark, sf_dir):
    early, late = F.col("event_type").isin("view", "click"), ~F.col("event_type").isin("view", "click")
    v1 = written(events(spark, sf_dir).filter(late).select("event_id", "event_type"), "parquet", "v1")
    v2 = written(events(spark, sf_dir).filter(early).select("event_id", "event_type", "value"), "parquet", "v2")
    return readers.read_parquet(spark, [v1, v2])


@checked("s4_gzip_json", EVENTS_SQL)
def s4(spark, sf_dir):
    path = written(events(spark, sf_dir), "json", "events.json", compression="gzip")
    return readers.spread_gzip(readers.read_json(spark, path, EVENT_SCHEMA)).drop(readers.CORRUPT)


def _mixed_files(spark, sf_dir):
    """The events in three formats, by their type."""
    rows, kind = events(spark, sf_dir), F.col("event_type")
    return [
        written(rows.filter(kind.isin("view", "click")), "json", "a.jsonl", compression="gzip"),
        written(rows.filter(kind == "error"), "csv", "b.csv", header=True, escape='"'),
        written(rows.filter(~kind.isin("view", "click", "error")), "parquet", "c.parquet"),
    ]


@checked("s5_mixed_formats", EVENTS_SQL)
def s5(spark, sf_dir):
    return readers.read_any(spark, _mixed_files(spark, sf_dir), EVENT_SCHEMA).drop(readers.CORRUPT)


@checked(
    "s6_kind_of_files",
    """
    SELECT CASE WHEN event_type IN ('view', 'click') THEN 'twitter' ELSE 'generic' END AS kind,
      count(*) AS records,
      CAST(sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS bigint) AS post_records
    FROM events GROUP BY 1
    """,
)
def s6(spark, sf_dir):
    rows = events(spark, sf_dir)
    like_posts = rows.filter(F.col("event_type").isin("view", "click")).select(
        F.col("event_id").alias("id"), F.col("props").alias("text"), F.lit("now").alias("created_at")
    )
    others = rows.filter(~F.col("event_type").isin("view", "click")).select(
        F.col("event_id").alias("id"), F.col("props").alias("text"), "value"
    )
    kinds = readers.kinds_of_files(
        spark, [written(like_posts, "json", "posts.json"), written(others, "json", "other.json")]
    )
    return kinds.groupBy("kind").agg(
        F.sum("records").alias("records"), F.sum("post_records").alias("post_records")
    )


@checked(
    "s8_saved_schema",
    """
    SELECT * FROM (VALUES ('event_id', 'bigint'), ('event_type', 'string'), ('props', 'string'),
      ('user_id', 'bigint'), ('value', 'double')) t(column_name, data_type)
    WHERE EXISTS (SELECT 1 FROM events)
    """,
)
def s8(spark, sf_dir):
    path = written(events(spark, sf_dir), "json", "events.json")
    saved = scratch_path(spark, "schema")
    json_paths.save_schema(spark, json_paths.infer_schema(spark, path), saved)
    read_back = readers.read_json(spark, path, json_paths.load_schema(spark, saved)).drop(readers.CORRUPT)
    return profile.table_columns(read_back).select("column_name", "data_type")


@checked("s9_schema_with_fallback", "SELECT event_id, event_type, CAST(user_id AS varchar) AS user_id FROM events")
def s9(spark, sf_dir):
    """The CSV is read by its schema; a schema with a type Spark refuses falls back to text."""
    path = written(events(spark, sf_dir).select("event_id", "event_type", "user_id"), "csv", "e.csv", header=True)
    good = StructType.fromDDL("event_id bigint, event_type string, user_id string")
    bad = StructType.fromDDL("event_id bigint, event_type variant, user_id map<string,string>")
    by_schema = readers.read_with_fallback(spark, path, "csv", good).select("event_id", "event_type")
    as_text = readers.read_with_fallback(spark, path, "csv", bad).select(
        F.col("event_id").cast("bigint").alias("event_id"), "user_id"
    )
    return by_schema.join(as_text, "event_id")


@checked(
    "s10_corrupt_records",
    """
    SELECT count(*) AS records, count(*) FILTER (event_type = 'error') AS corrupt_records,
      count(*) FILTER (event_type <> 'error') AS filled_records,
      round(count(*) FILTER (event_type = 'error') / count(*), 9) AS corrupt_share FROM events
    """,
)
def s10(spark, sf_dir):
    return readers.corrupt_report(s1(spark, sf_dir)).withColumn("corrupt_share", F.round("corrupt_share", 9))


@checked(
    "s10b_corrupt_examples",
    """
    SELECT '{"event_id": ' || event_id || ', "ev' AS example FROM events WHERE event_type = 'error'
    ORDER BY 1 LIMIT 3
    """,
)
def s10b(spark, sf_dir):
    return readers.corrupt_examples(s1(spark, sf_dir))


@checked(
    "s11_coerce",
    """
    SELECT CAST(event_id AS varchar) AS event_id, '{"kind":"' || event_type || '","user":' || user_id || '}' AS info,
      CAST(trunc(value) AS bigint) AS value, try_cast(event_type AS bigint) AS event_type,
      CAST(NULL AS double) AS missing FROM events
    """,
)
def s11(spark, sf_dir):
    info = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user"))
    target = StructType.fromDDL("event_id string, info string, value bigint, event_type bigint, missing double")
    return shaping.coerce(events(spark, sf_dir).withColumn("info", info), target)


@checked(
    "s12_normalize",
    with_posts(
        """
        SELECT id_str, favorite_count AS favorite_count, user_name AS name,
          CAST(user_followers AS double) AS followers_count, try_cast(user_id_str AS bigint) AS id_str_number,
          CAST(NULL AS varchar) AS location, rt_user_screen AS rt_screen, CAST(NULL AS varchar) AS lang2
        FROM posts
        """
    ),
)
def s12(spark, sf_dir):
    target = StructType.fromDDL(
        "id_str string, favorite_count bigint, lang2 string, "
        "user struct<name:string,followers_count:double,id_str:bigint,location:string>, "
        "retweeted_status struct<user:struct<screen_name:string>>"
    )
    return shaping.normalize(posts(spark, sf_dir, texts=False), target).select(
        "id_str", "favorite_count", "lang2", "user.name", "user.followers_count",
        F.col("user.id_str").alias("id_str_number"), "user.location",
        F.col("retweeted_status.user.screen_name").alias("rt_screen"),
    )


@checked(
    "s13_provenance",
    """
    SELECT event_id, 'event_type=' || event_type AS source_file,
      CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS integer) AS source_id
    FROM events
    """,
)
def s13(spark, sf_dir):
    base = scratch_path(spark, "by_type")
    events(spark, sf_dir).write.partitionBy("event_type").json(base)
    inputs = [f"{base}/event_type={kind}" for kind in EVENT_TYPES]
    raw = readers.read_json(spark, inputs, StructType.fromDDL("event_id bigint"))
    return readers.with_provenance(raw, inputs).drop(readers.CORRUPT)


@checked(
    "s14_many_files",
    """
    SELECT event_id, CAST(user_id AS varchar) AS user_id, event_type, CAST(NULL AS varchar) AS note,
      CASE WHEN event_type IN ('view', 'click') THEN 1 WHEN event_type = 'error' THEN 2 ELSE 3 END AS source_id
    FROM events
    """,
)
def s14(spark, sf_dir):
    target = StructType.fromDDL("event_id bigint, user_id string, event_type string, note string")
    return readers.load_many(spark, _mixed_files(spark, sf_dir), target).drop("source_file", readers.CORRUPT)


@checked("s15_parquet_sink", "SELECT event_id, event_type FROM events")
def s15(spark, sf_dir):
    """The second load is written twice; the repetition replaces it."""
    folder, rows = scratch_path(spark, "dataset"), events(spark, sf_dir).select("event_id", "event_type")
    sinks.save_load(rows.filter("event_type = 'view'"), folder, "one")
    for _ in range(2):
        sinks.save_load(rows.filter("event_type <> 'view'"), folder, "two")
    return readers.read_parquet(spark, folder).select("event_id", "event_type")


@checked(
    "s16_pruned_columns",
    with_posts(
        """
        SELECT id_str, user_id_str AS user_id, rt_id_str AS retweeted_id, is_reshare,
          'created_at,favorite_count,id_str,user,retweeted_status' AS post_fields,
          'id_str,screen_name' AS user_fields, 'id_str,favorite_count' AS retweeted_fields FROM posts
        """
    ),
)
def s16(spark, sf_dir):
    raw = posts(spark, sf_dir).select(
        "id", "lang", "created_at", "favorite_count", "id_str",
        F.struct("user.id_str", "user.screen_name", F.lit("UTC").alias("time_zone"), F.lit(1).alias("listed_count")).alias("user"),
        F.when(
            F.col("retweeted_status").isNotNull(),
            F.struct("retweeted_status.id_str", F.lit(False).alias("truncated"), "retweeted_status.favorite_count"),
        ).alias("retweeted_status"),
    )
    pruned = shaping.prune_post_columns(raw)

    def names(schema):
        return F.lit(",".join(schema.fieldNames()))

    return pruned.select(
        "id_str",
        F.col("user.id_str").alias("user_id"),
        F.col("retweeted_status.id_str").alias("retweeted_id"),
        F.col("retweeted_status").isNotNull().alias("is_reshare"),
        names(pruned.schema).alias("post_fields"),
        names(pruned.schema["user"].dataType).alias("user_fields"),
        names(pruned.schema["retweeted_status"].dataType).alias("retweeted_fields"),
    )


@checked(
    "s17_dataset_metadata",
    "SELECT count(*) AS record_count, 5 AS column_count, 1 AS file_count, true AS has_bytes, true AS has_partitions FROM documents",
)
def s17(spark, sf_dir):
    stats = profile.dataset_stats(table(spark, sf_dir, "documents"))
    return stats.select("record_count", "column_count", "file_count", (F.col("total_bytes") > 0).alias("has_bytes"), (F.col("partition_count") > 0).alias("has_partitions"))


@checked(
    "s19_recovered_json",
    """
    SELECT 'object' AS kind, event_id, event_type, CAST(NULL AS varchar) AS missing FROM events
    UNION ALL SELECT 'object', user_id, NULL, NULL FROM events
    UNION ALL SELECT 'skipped', NULL, NULL, NULL FROM events WHERE event_type = 'error'
    """,
)
def s19(spark, sf_dir):
    """Two objects per line, without separator, with rubbish between them on the error lines."""
    first = F.to_json(F.struct("event_id", "event_type"))
    second = F.to_json(F.struct(F.col("user_id").alias("event_id")))
    rubbish = F.when(F.col("event_type") == "error", "  }garbage, ").otherwise("")
    lines = events(spark, sf_dir).select(F.concat(first, rubbish, second).alias("value"))
    pieces = repair.recover_json(spark, written(lines, "text", "joined.json"))
    objects = repair.recovered_records(pieces, ["event_id", "event_type", "missing"]).select(
        F.lit("object").alias("kind"), F.col("event_id").cast("bigint").alias("event_id"), "event_type", "missing"
    )
    skipped = pieces.filter("kind <> 'object'").select(
        "kind", F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("string").alias("missing"),
    )
    return objects.unionByName(skipped)


_ALL_PATHS = [
    ("id", "int", "true"), ("lang", "str", "lang IS NOT NULL"), ("id_str", "str", "true"),
    ("created_at", "str", "true"), ("favorite_count", "int", "favorite_count IS NOT NULL"),
    ("retweet_count", "int", "retweet_count IS NOT NULL"), ("reply_count", "int", "reply_count IS NOT NULL"),
    ("quote_count", "int", "quote_count IS NOT NULL"),
    ("quoted_status_id_str", "str", "quoted_status_id_str IS NOT NULL"),
    ("coordinates", "dict", "point_lon IS NOT NULL"),
    ("coordinates.coordinates", "str", "point_lon IS NOT NULL"),
    ("coordinates.type", "str", "point_lon IS NOT NULL"),
    ("place", "dict", "place_name IS NOT NULL"), ("place.name", "str", "place_name IS NOT NULL"),
    ("place.bounding_box", "dict", "place_name IS NOT NULL"),
    ("place.bounding_box.type", "str", "place_name IS NOT NULL"),
    ("place.bounding_box.coordinates", "str", "box_lon IS NOT NULL"),
    ("user", "dict", "true"), ("user.id_str", "str", "true"), ("user.name", "str", "true"),
    ("user.screen_name", "str", "true"), ("user.description", "str", "user_about IS NOT NULL"),
    ("user.followers_count", "int", "user_followers IS NOT NULL"), ("user.friends_count", "int", "true"),
    ("user.verified", "bool", "true"), ("retweeted_status", "dict", "is_reshare"),
    ("retweeted_status.id_str", "str", "is_reshare"), ("retweeted_status.created_at", "str", "is_reshare"),
    ("retweeted_status.favorite_count", "int", "rt_favorite_count IS NOT NULL"),
    ("retweeted_status.retweet_count", "int", "rt_retweet_count IS NOT NULL"),
    ("retweeted_status.reply_count", "int", "rt_reply_count IS NOT NULL"),
    ("retweeted_status.quote_count", "int", "rt_quote_count IS NOT NULL"),
    ("retweeted_status.user", "dict", "is_reshare"), ("retweeted_status.user.id_str", "str", "is_reshare"),
    ("retweeted_status.user.name", "str", "is_reshare"),
    ("retweeted_status.user.screen_name", "str", "is_reshare"),
    ("retweeted_status.user.description", "str", "rt_user_about IS NOT NULL"),
    ("retweeted_status.user.followers_count", "int", "rt_user_followers IS NOT NULL"),
    ("retweeted_status.user.friends_count", "int", "is_reshare"),
    ("retweeted_status.user.verified", "bool", "is_reshare"),
]
_TEXT_PATHS = [
    ("text", "str", '"text" IS NOT NULL'), ("full_text", "str", "full_text IS NOT NULL"),
    ("extended_tweet", "dict", "extended_text IS NOT NULL"), ("extended_tweet.full_text", "str", "extended_text IS NOT NULL"),
    ("retweeted_status.text", "str", "rt_text IS NOT NULL"), ("retweeted_status.full_text", "str", "rt_full_text IS NOT NULL"),
    ("retweeted_status.extended_tweet", "dict", "rt_extended_text IS NOT NULL"),
    ("retweeted_status.extended_tweet.full_text", "str", "rt_extended_text IS NOT NULL"),
]


def _paths_sql(all_paths: list[tuple[str, str, str]]) -> str:
    """One scan of the posts counts all paths."""
    return with_posts(
        ", paths AS MATERIALIZED (SELECT "
        + ",\n".join(
            f"unnest([{', '.join(listed)}]) AS {name}"
            for name, listed in {
                "path": [f"'{p}'" for p, _, _ in all_paths],
                "type": [f"'{t}'" for _, t, _ in all_paths],
                "records": [f"count(*) FILTER ({c})" for _, _, c in all_paths],
            }.items()
        )
        + " FROM posts)\n"
    )


_PATHS_SQL = _paths_sql(_ALL_PATHS)


@checked("s20_path_types", _PATHS_SQL + "SELECT * FROM paths WHERE records > 0")
def s20(spark, sf_dir):
    path = written(post_lines(spark, sf_dir), "text", "posts.jsonl")
    return json_paths.typed_paths(json_paths.read_lines(spark, path)).drop("unexpanded")


@checked(
    "s21_path_tree",
    _paths_sql([*_ALL_PATHS, *_TEXT_PATHS])
    + """
    , seen AS (SELECT * FROM paths WHERE records > 0)
    SELECT CASE WHEN contains(c.path, '.') THEN regexp_extract(c.path, '^(.*)\\.[^.]*$', 1) ELSE 'root' END AS parent,
      coalesce(p.type, 'object') AS parent_types, regexp_extract(c.path, '([^.]*)$', 1) AS child, c.type AS child_types
    FROM seen c LEFT JOIN seen p ON p.path = regexp_extract(c.path, '^(.*)\\.[^.]*$', 1)
    """,
)
def s21(spark, sf_dir):
    path = written(post_lines(spark, sf_dir, texts=True), "text", "posts.jsonl", compression="gzip")
    return json_paths.path_tree(json_paths.path_types(json_paths.read_lines(spark, path)))


@checked(
    "s22_flatten",
    with_posts(
        """
        SELECT id_str, user_name, user_verified, rt_id_str AS retweeted_status_id_str,
          rt_user_screen AS retweeted_status_user_screen_name, place_name FROM posts
        """
    ),
)
def s22(spark, sf_dir):
    return shaping.flatten(posts(spark, sf_dir)).select(
        "id_str", "user_name", "user_verified", "retweeted_status_id_str", "retweeted_status_user_screen_name", "place_name"
    )


@checked(
    "s23_file_type_report",
    """
    SELECT column_name, data_type FROM (VALUES ('event_id', 'int64'), ('value', 'float64'),
      ('who_kind', 'object'), ('who_id', 'float64'), ('_FILE_CORROTTO_O_ILLEGGIBILE_', 'JSONDecodeError')
      ) t(column_name, data_type) WHERE EXISTS (SELECT 1 FROM events)
    """,
)
def s23(spark, sf_dir):
    """One sound file and one with broken lines; the report is written as CSV and read back."""
    rows = events(spark, sf_dir)
    who = F.struct(
        F.col("event_type").alias("kind"), F.when(F.col("event_type") != "view", F.col("user_id")).alias("id")
    )
    record = F.to_json(F.struct("event_id", "value", who.alias("who")))
    sound = written(rows.select(record.alias("value")), "text", "sound")
    cut = F.when(F.col("event_type") == "error", F.lit('{"a": ')).otherwise(F.lit('{"a": 1}'))
    broken = written(rows.select(cut.alias("value")), "text", "broken")
    # Every input folder counts as one file here, however many parts Spark wrote it in.
    lines = spark.read.text([sound, broken]).select(
        "value", F.regexp_extract("_metadata.file_path", "/(sound|broken)/", 1).alias("filename")
    )
    out = scratch_path(spark, "report")
    sinks.save_report(json_paths.file_type_report(lines), out)
    return readers.read_csv(spark, out).select("column_name", "data_type")


@checked("s24_converted", "SELECT event_id, user_id, event_type, value, props FROM events")
def s24(spark, sf_dir):
    path = written(events(spark, sf_dir), "json", "events.json", compression="gzip")
    out = scratch_path(spark, "converted")
    sinks.convert_to_parquet(spark, path, out, schema=EVENT_SCHEMA)
    return readers.read_parquet(spark, out).select(*EVENT_NAMES)


@checked(
    "s25_nested_as_json",
    with_posts(
        """
        SELECT id_str, user_name AS name, user_verified AS verified, rt_favorite_count AS rt_likes FROM posts
        """
    ),
)
def s25(spark, sf_dir):
    """The JSON text is written to Parquet and its values are read out of the text again."""
    path = written(shaping.nested_as_json(posts(spark, sf_dir)), "parquet", "as_json", compression="zstd")
    return readers.read_parquet(spark, path).select(
        "id_str",
        F.get_json_object("user", "$.name").alias("name"),
        F.get_json_object("user", "$.verified").cast("boolean").alias("verified"),
        F.get_json_object("retweeted_status", "$.favorite_count").cast("bigint").alias("rt_likes"),
    )


@checked(
    "s26_relevant_columns",
    with_posts(
        """
        SELECT id_str AS tweet_id, created_at AS data_creazione, coalesce(extended_text, "text") AS testo_completo,
          lang AS lingua, user_id_str AS user_id, user_screen AS user_name, user_followers,
          CAST(NULL AS varchar) AS luogo, retweet_count AS conteggio_retweet FROM posts
        """
    ),
)
def s26(spark, sf_dir):
    raw = posts(spark, sf_dir)
    path = written(raw, "json", "posts.json", compression="gzip")
    return shaping.extract_relevant(readers.read_json(spark, path, raw.schema))


@checked("s26b_broken_lines", "SELECT CAST(event_id AS varchar) AS tweet_id, user_id AS user_followers, way FROM events, (VALUES ('extract'), ('convert')) t(way) WHERE event_type <> 'error'")
def s26b(spark, sf_dir):
    """Lines that are cut short leave no row, neither in the extract nor in the converted files."""
    post = F.to_json(F.struct(F.col("event_id").cast("string").alias("id_str"), F.struct(F.col("user_id").alias("followers_count")).alias("user")))
    line = F.when(F.col("event_type") == "error", F.expr("left(post, 12)")).otherwise(F.col("post"))
    path = written(events(spark, sf_dir).withColumn("post", post).select(line.alias("value")), "text", "some.jsonl")
    schema = StructType.fromDDL("id_str string, user struct<followers_count:bigint>")
    out = scratch_path(spark, "converted")
    sinks.convert_to_parquet(spark, path, out, schema=schema)
    ways = {"extract": readers.read_json(spark, path, schema), "convert": readers.read_parquet(spark, out)}
    parts = [shaping.extract_relevant(df).select("tweet_id", "user_followers").withColumn("way", F.lit(way)) for way, df in ways.items()]
    return parts[0].unionByName(parts[1])


@checked(
    "s27_evolved_union",
    """
    SELECT event_id, event_type AS info_kind, user_id AS info_user, NULL AS info_value, NULL AS note, 1 AS n_tags FROM events
    UNION ALL
    SELECT event_id, event_type, NULL, value, props, 2 FROM events
    """,
)
def s27(spark, sf_dir):
    rows = events(spark, sf_dir)
    first = rows.select(
        "event_id",
        F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("info"),
        F.array(F.struct(F.col("event_type").alias("a"))).alias("tags"),
    )
    second = rows.select(
        F.struct(F.col("event_type").alias("kind"), "value").alias("info"),
        "event_id",
        F.array(F.struct(F.lit(1).alias("b")), F.struct(F.lit(2).alias("b"))).alias("tags"),
        F.col("props").alias("note"),
    )
    return shaping.evolve_union([first, second]).select(
        "event_id", F.col("info.kind").alias("info_kind"), F.col("info.user").alias("info_user"),
        F.col("info.value").alias("info_value"), "note", F.size("tags").alias("n_tags"),
    )


@checked(
    "s28_nesting_depth",
    _PATHS_SQL + "SELECT CAST(max(len(string_split(path, '.'))) AS integer) AS max_depth FROM paths WHERE records > 0",
)
def s28(spark, sf_dir):
    path = written(post_lines(spark, sf_dir), "text", "posts.jsonl")
    return json_paths.path_depth(json_paths.path_types(json_paths.read_lines(spark, path)))


@checked("s2c_reordered_csv", "SELECT event_id, user_id, event_type, value, CAST(NULL AS varchar) AS note FROM events")
def s2c(spark, sf_dir):
    """The columns of the file stand in another order than those of the schema, one is missing, one is not wanted."""
    path = written(events(spark, sf_dir).select("value", "props", "event_type", "user_id", "event_id"), "csv", "turned.csv", header=True, escape='"')
    schema = StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double, note string")
    return readers.read_csv(spark, path, schema).drop(readers.CORRUPT)


@checked("s5b_folder_input", EVENTS_SQL)
def s5b(spark, sf_dir):
    """One folder whose name tells no format, with files of three."""
    base, rows, kind = scratch_path(spark, "folder"), events(spark, sf_dir), F.col("event_type")
    rows.filter(kind.isin("view", "click")).write.json(f"{base}/one")
    rows.filter(kind == "error").write.csv(f"{base}/two/deeper", header=True, escape='"')
    rows.filter(~kind.isin("view", "click", "error")).write.parquet(f"{base}/three")
    return readers.read_any(spark, [base], EVENT_SCHEMA).drop(readers.CORRUPT)


@checked("s10c_clean_input", "SELECT count(*) AS records, CAST(0 AS bigint) AS corrupt_records, count(*) AS filled_records, CAST(0 AS double) AS corrupt_share FROM events")
def s10c(spark, sf_dir):
    clean = readers.read_json(spark, written(events(spark, sf_dir), "json", "clean.jsonl"))
    assert readers.corrupt_examples(clean).count() == 0
    return readers.corrupt_report(clean)


@checked("s10d_all_corrupt", "SELECT '{\"event_id\": ' || event_id AS example FROM events ORDER BY 1 LIMIT 3")
def s10d(spark, sf_dir):
    line = F.concat(F.lit('{"event_id": '), F.col("event_id")).alias("value")
    broken = readers.read_json(spark, written(events(spark, sf_dir).select(line), "text", "broken.jsonl"))
    return readers.corrupt_examples(broken)


@checked(
    "s13b_nested_sources",
    """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'p+q %1' WHEN 'click' THEN 'inner' ELSE 'outer' END AS source_file,
      CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 3 ELSE 2 END AS integer) AS source_id
    FROM events
    """,
)
def s13b(spark, sf_dir):
    """A name with a plus, a space and a percent sign; an input inside another; files in folders below."""
    base, rows, kind = scratch_path(spark, "nested"), events(spark, sf_dir).select("event_id", "event_type"), F.col("event_type")
    inputs = [f"{base}/p+q %1", f"{base}/outer", f"{base}/outer/inner"]
    rows.filter(kind == "view").write.json(inputs[0])
    rows.filter(~kind.isin("view", "click")).write.json(f"{inputs[1]}/day=1")
    rows.filter(kind == "click").write.json(inputs[2])
    schema = StructType.fromDDL("event_id bigint")
    raw = spark.read.schema(schema).option("recursiveFileLookup", True).json(inputs[:2])
    return readers.with_provenance(raw, inputs)


@checked(
    "s14b_corrupt_kept",
    """
    SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
      CASE WHEN event_type = 'error' THEN '{"event_id": ' || event_id END AS _corrupt_record
    FROM events
    """,
)
def s14b(spark, sf_dir):
    whole = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.when(F.col("event_type") == "error", "").otherwise("}"))
    path = written(events(spark, sf_dir).select(whole.alias("value")), "text", "some.jsonl")
    return readers.load_many(spark, [path], StructType.fromDDL("event_id bigint")).drop("source_file", "source_id")


@checked(
    "s20b_deep_paths",
    """
    SELECT array_to_string(['f' || i for i in range(1, n + 1)], '.') AS path, CASE WHEN n = 15 THEN 'int' ELSE 'dict' END AS types
    FROM range(1, 16) t(n) WHERE (SELECT count(*) FROM events) > 0
    """,
)
def s20b(spark, sf_dir):
    """Objects fifteen levels deep."""
    opening = "".join(f'{{"f{i}": ' for i in range(1, 16))
    lines = spread(events(spark, sf_dir)).select(F.concat(F.lit(opening), F.col("event_id"), F.lit("}" * 15)).alias("value"))
    return json_paths.path_types(lines)


@checked(
    "s27b_widened_union",
    """
    SELECT event_id AS n, value AS x, user_id % 3 AS m FROM events
    UNION ALL SELECT user_id % 100, CAST(user_id % 7 AS double), value FROM events
    """,
)
def s27b(spark, sf_dir):
    """Whole numbers of two widths, fractions with whole numbers, maps of two kinds of value, in both orders."""
    rows = events(spark, sf_dir)
    small = (F.col("user_id") % 100).cast("int"), (F.col("user_id") % 7).cast("int"), (F.col("user_id") % 3).cast("int")
    one = rows.select(F.col("event_id").alias("n"), F.col("value").alias("x"), F.create_map(F.lit("k"), small[2]).alias("m"))
    two = rows.select(small[0].alias("n"), small[1].alias("x"), F.create_map(F.lit("k"), "value").alias("m"))
    assert shaping.evolve_union([one, two]).schema == shaping.evolve_union([two, one]).schema
    return shaping.evolve_union([one, two]).withColumn("m", F.col("m")["k"])


@checked(
    "s14c_csv_headers_differ",
    """
    SELECT event_id, user_id, event_type, CASE event_type WHEN 'view' THEN props END AS props, way FROM events, (VALUES ('load_many'), ('read_any'), ('read_csv'), ('by_schema'), ('fallback')) t(way)
    """,
)
def s14c(spark, sf_dir):
    """Three files: the columns in three orders, one with a column more; through every loader."""
    rows, kind, base = events(spark, sf_dir), F.col("event_type"), scratch_path(spark, "headers")
    orders = [
        (kind == "view", ["event_id", "user_id", "event_type", "props"]),
        (kind == "click", ["user_id", "event_type", "event_id"]),
        (~kind.isin("view", "click"), ["event_type", "event_id", "user_id"]),
    ]
    files = [f"{base}/{i}.csv" for i in range(len(orders))]
    for path, (chosen, columns) in zip(files, orders):
        rows.filter(chosen).select(columns).write.csv(path, header=True, escape='"')
    target = StructType.fromDDL("event_id bigint, user_id bigint, event_type string, props string")
    refused = StructType.fromDDL("event_id map<string,string>, user_id bigint, event_type string, props string")
    ways = {
        "load_many": readers.load_many(spark, files, target),
        "read_any": readers.read_any(spark, files, target),
        "read_csv": readers.read_csv(spark, files),
        "by_schema": readers.read_csv(spark, files, target),
        "fallback": readers.read_with_fallback(spark, files, "csv", refused),
    }
    parts = [shaping.coerce(df, target).withColumn("way", F.lit(way)) for way, df in ways.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


_EXACT = "event_id + 9007199254740993"


@checked(
    "s27c_exact_union",
    f"""
    SELECT CAST({_EXACT} AS varchar) AS exact, CAST({_EXACT} AS varchar) AS wide, CAST({_EXACT} AS varchar) AS listed,
      CAST({_EXACT} AS varchar) || repeat('0', 20) AS far, CAST(user_id AS double) AS plain, 'one' AS side, turned FROM events, (VALUES (0), (1)) t(turned)
    UNION ALL
    SELECT CASE WHEN user_id % 2 = 0 THEN '0.5' ELSE '2' END, '1.25', CASE WHEN user_id % 2 = 0 THEN '0.5' ELSE '2' END, '0.001', 0.5, 'two', turned FROM events, (VALUES (0), (1)) t(turned)
    """,
)
def s27c(spark, sf_dir):
    """Whole numbers that no double holds beside fractions, decimals of 38 digits beside decimals with places, also in
    arrays of structs, in both orders; the last column does fit a double."""
    rows = spread(events(spark, sf_dir).select("event_id", "user_id"))
    big, half = (F.col("event_id") + 9007199254740993).cast("bigint"), F.when(F.col("user_id") % 2 == 0, 0.5).otherwise(2.0)
    far = F.concat(big.cast("string"), F.lit("0" * 20)).cast("decimal(38,0)")
    one = rows.select(big.alias("exact"), big.cast("decimal(38,0)").alias("wide"), F.array(F.struct(big.alias("x"))).alias("listed"), far.alias("far"), F.col("user_id").alias("plain"), F.lit("one").alias("side"))
    two = rows.select(
        half.alias("exact"), F.lit("1.25").cast("decimal(10,5)").alias("wide"), F.array(F.struct(half.alias("x"))).alias("listed"),
        F.lit("0.001").cast("decimal(10,5)").alias("far"), F.lit(0.5).alias("plain"), F.lit("two").alias("side"),
    )
    united = shaping.evolve_union([one, two]).withColumn("turned", F.lit(0)).unionByName(shaping.evolve_union([two, one]).withColumn("turned", F.lit(1)))
    plain = lambda c: F.regexp_replace(F.col(c).cast("string"), r"(\.[0-9]*?)0+$", "$1")
    shown = lambda c: F.regexp_replace(c, r"\.$", "").alias
    united = united.withColumn("listed", F.col("listed")[0]["x"])
    return united.select(*[shown(plain(c))(c) for c in ("exact", "wide", "listed", "far")], "plain", "side", "turned")


@checked("s24b_equal_names", "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'x' ELSE 'y' END AS of_folder FROM events")
def s24b(spark, sf_dir):
    """Two folders with files of the same names, as one job writes them; one of the folders is converted again, alone."""
    base, out = scratch_path(spark, "same"), scratch_path(spark, "converted")
    folder = F.when(F.col("event_type").isin("view", "click"), "x").otherwise("y")
    events(spark, sf_dir).select("event_id", folder.alias("folder")).write.partitionBy("folder").json(base)
    schema = StructType.fromDDL("event_id bigint")
    for inputs in ([f"{base}/folder=x", f"{base}/folder=y"], [f"{base}/folder=y"]):
        sinks.convert_to_parquet(spark, inputs, out, schema=schema)
    sources = sinks.converted_sources(spark, out).select("source_file", F.regexp_extract("path", "folder(?:=|%3D)([xy])/", 1).alias("of_folder"))
    return readers.read_parquet(spark, out).join(sources, "source_file").select("event_id", "of_folder")


@checked(
    "s19b_values_over_lines",
    """
    SELECT event_id, user_id AS inner_id, 'object' AS kind, CAST(4 AS bigint) AS least_splits FROM events WHERE event_type <> 'error'
    UNION ALL SELECT NULL, NULL, 'skipped', 4 FROM events WHERE event_type = 'error'
    """,
)
def s19b(spark, sf_dir):
    """Objects over several lines with objects inside them, some on lines of their own; errors are never closed. All stand
    in files of at least four splits."""
    whole = F.concat(F.lit('{\n"event_id": '), "event_id", F.lit(',\n"inner":\n{"user_id": '), "user_id", F.lit('}\n}'))
    cut = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "inner": {"user_id": '), "user_id", F.lit('}, "more": ['))
    text = F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("value")
    path = written(events(spark, sf_dir).select(text), "text", "pretty.json")
    sizes = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("bytes")).first()
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, sizes["bytes"] // 16)))
    apart.conf.set("spark.sql.files.openCostInBytes", "0")
    splits = apart.read.text(path).select("_metadata.file_path", "_metadata.file_block_start").distinct()
    pieces = repair.recover_json(apart, path)
    number = lambda key: F.get_json_object("json", key).cast("bigint")
    found = pieces.select(number("$.event_id").alias("event_id"), number("$.inner.user_id").alias("inner_id"), "kind")
    shown = found.withColumn("event_id", F.when(F.col("kind") == "object", F.col("event_id"))).withColumn("inner_id", F.when(F.col("kind") == "object", F.col("inner_id")))
    return shown.withColumn("least_splits", F.lit(min(4, splits.count())).cast("bigint"))
