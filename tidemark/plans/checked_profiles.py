"""Registered profiles, previews, searches and result statistics (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profile, view
from tidemark.plans.posts import posts, table, with_posts
from tidemark.plans.registry import checked


@checked(
    "p1_table_info",
    """
    SELECT position, column_name, data_type, (SELECT count(*) FROM events) AS total_rows, 6 AS total_columns
    FROM (VALUES (1, 'event_id', 'bigint'), (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'),
      (4, 'event_type', 'string'), (5, 'value', 'double'), (6, 'props', 'string')) t(position, column_name, data_type)
    """,
)
def p1(spark, sf_dir):
    return profile.table_info(table(spark, sf_dir, "events"))


@checked("p2_preview", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def p2(spark, sf_dir):
    return profile.preview(table(spark, sf_dir, "documents"), key="doc_id", columns=["doc_id", "lang", "n_chars"])


@checked(
    "p3_column_profile",
    """
    SELECT 'value' AS column_name, 'double' AS data_type, count(*) AS total_rows, count(value) AS filled,
      count(*) - count(value) AS empty, count(DISTINCT value) AS distinct_values, min(value) AS min,
      max(value) AS max, round(avg(value), 6) AS mean, round(median(value), 6) AS median FROM events
    """,
)
def p3(spark, sf_dir):
    found = profile.column_profile(table(spark, sf_dir, "events"), "value")
    return found.withColumns({"mean": F.round("mean", 6), "median": F.round("median", 6)})


@checked(
    "p3b_text_profile",
    """
    SELECT 'text' AS column_name, 'string' AS data_type, count(*) AS total_rows, count("text") AS filled,
      count(*) - count("text") AS empty, count(DISTINCT "text") AS distinct_values FROM documents
    """,
)
def p3b(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "documents"), "text")


@checked(
    "p3c_distinct_examples",
    """
    SELECT CASE WHEN length(v) > 100 THEN substring(v, 1, 100) || '...' ELSE v END AS value
    FROM (SELECT DISTINCT "text" AS v FROM documents WHERE "text" IS NOT NULL ORDER BY v LIMIT 10)
    """,
)
def p3c(spark, sf_dir):
    return profile.distinct_examples(table(spark, sf_dir, "documents"), "text")


@checked("p4_sample_rows", "SELECT * FROM events ORDER BY md5(event_id || ':42'), event_id LIMIT 100")
def p4(spark, sf_dir):
    return profile.sample_rows(table(spark, sf_dir, "events"), key="event_id", n=100)


@checked(
    "p5_search_column",
    """
    SELECT doc_id, lang, n_chars, (SELECT count(*) FROM documents WHERE contains(lower("text"), 'ment')) AS total_hits
    FROM documents WHERE contains(lower("text"), 'ment') ORDER BY doc_id LIMIT 10
    """,
)
def p5(spark, sf_dir):
    hits = profile.search_column(table(spark, sf_dir, "documents"), "text", "Ment", key="doc_id")
    return hits.select("doc_id", "lang", "n_chars", "total_hits")


@checked("p6_search_text", "SELECT * FROM conversations WHERE regexp_matches(role, '(?i)SYS|le. ') OR regexp_matches(\"text\", '(?i)SYS|le. ')")
def p6(spark, sf_dir):
    return profile.search_text(table(spark, sf_dir, "conversations"), "SYS|le. ")


@checked(
    "p7_result_stats",
    with_posts(
        """
        SELECT count(*) AS n_rows, 5 AS n_columns,
          count(*) - count(place_name) + count(*) - count(quote_count) + count(*) - count(quoted_status_id_str) AS null_values,
          2 AS numeric_columns, 3 AS text_columns
        FROM posts
        """
    ),
)
def p7(spark, sf_dir):
    result = posts(spark, sf_dir).select(
        "id", "id_str", F.col("place.name").alias("place_name"), "quote_count", "quoted_status_id_str"
    )
    return profile.result_stats(result)


@checked(
    "p8_limited_result",
    """
    SELECT event_id, value, (SELECT count(*) FROM events WHERE event_type = 'view') AS total_rows
    FROM events WHERE event_type = 'view' ORDER BY value DESC, event_id LIMIT 50
    """,
)
def p8(spark, sf_dir):
    views = table(spark, sf_dir, "events").filter("event_type = 'view'").select("event_id", "value")
    return view.limited(views, 50, order_by=[F.desc("value"), F.col("event_id")])


def _rate(field: str, kind: str, column: str) -> str:
    return (
        f"SELECT '{field}' AS field, '{kind}' AS data_type, count({column}) AS filled, "
        f"round(count({column}) / count(*), 9) AS fill_rate FROM posts"
    )


@checked(
    "p9_fill_rates",
    with_posts(
        "\nUNION ALL ".join(
            _rate(*args)
            for args in (
                ("id_str", "string", "id_str"),
                ("full_text", "string", "full_text"),
                ("extended_tweet.full_text", "string", "extended_text"),
                ("quote_count", "bigint", "quote_count"),
                ("coordinates.coordinates", "string", "point_lon"),
                ("place.name", "string", "place_name"),
                ("place.bounding_box.coordinates", "string", "box_lon"),
                ("retweeted_status.user.name", "string", "rt_user_name"),
                ("retweeted_status.quote_count", "bigint", "rt_quote_count"),
                ("marks", "array", "id_str"),
                ("marks[].quoted", "string", "quoted_status_id_str"),
            )
        )
    ),
)
def p9(spark, sf_dir):
    marks = F.array(F.struct(F.col("quoted_status_id_str").alias("quoted"), F.col("id").alias("id")))
    rates = profile.fill_rates(posts(spark, sf_dir).withColumn("marks", marks))
    shown = (
        "id_str", "full_text", "extended_tweet.full_text", "quote_count", "coordinates.coordinates", "place.name",
        "place.bounding_box.coordinates", "retweeted_status.user.name", "retweeted_status.quote_count", "marks",
        "marks[].quoted",
    )
    return rates.filter(F.col("field").isin(*shown)).withColumn("fill_rate", F.round("fill_rate", 9))


_STRUCTS = {
    "author": "struct<id_str:string,name:string,screen_name:string,description:string,followers_count:bigint,friends_count:bigint,verified:boolean>",
    "extended": "struct<full_text:string>",
}
_OF_POST = [
    ("id_str", "string"), ("created_at", "string"), ("text", "string"), ("full_text", "string"), ("extended_tweet", _STRUCTS["extended"]),
    ("favorite_count", "bigint"), ("retweet_count", "bigint"), ("reply_count", "bigint"), ("quote_count", "bigint"), ("user", _STRUCTS["author"]),
]
_DESCRIBED = [
    ("id", "bigint"), ("lang", "string"), *_OF_POST, ("quoted_status_id_str", "string"), ("coordinates", "struct<coordinates:string,type:string>"),
    ("place", "struct<name:string,bounding_box:struct<coordinates:string,type:string>>"),
    ("retweeted_status", f"struct<{','.join(f'{name}:{kind}' for name, kind in _OF_POST)}>"),
]


@checked(
    "p10_describe",
    f"""
    SELECT col_name, data_type, CAST(NULL AS varchar) AS comment FROM (VALUES {", ".join(f"('{name}', '{kind}')" for name, kind in _DESCRIBED)}) t(col_name, data_type)
    WHERE EXISTS (SELECT 1 FROM events)
    """,
)
def p10(spark, sf_dir):
    view.register(posts(spark, sf_dir))
    return view.describe(spark)


@checked(
    "p11_whole_dataset",
    with_posts(
        """
        SELECT id_str, created_at, body, favorite_count, retweet_count, reply_count, quote_count,
          quoted_status_id_str, place_name, user_id_str, user_followers, rt_id_str, rt_favorite_count FROM posts
        """
    ),
)
def p11(spark, sf_dir):
    view.register(posts(spark, sf_dir))
    return view.whole_dataset(spark).select(
        "id_str", "created_at", F.coalesce("full_text", "extended_tweet.full_text", "text").alias("body"),
        "favorite_count", "retweet_count", "reply_count", "quote_count", "quoted_status_id_str",
        F.col("place.name").alias("place_name"), F.col("user.id_str").alias("user_id_str"),
        F.col("user.followers_count").alias("user_followers"), F.col("retweeted_status.id_str").alias("rt_id_str"),
        F.col("retweeted_status.favorite_count").alias("rt_favorite_count"),
    )
