"""Registered reports (Q), read-only SQL and post filters (T).

The test texts are invented prose in which the default words hardly occur, so the queries pass words,
labels and thresholds that fit them. All run over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import filters, reports, rollups, view
from tidemark.plans.posts import posts, table, with_posts
from tidemark.plans.registry import ORACLES, checked
from tidemark.session import scratch_path
from tidemark.sources import sinks

TEXTS = ("full_text", "extended_tweet.full_text", "text")
WORDS_LOOKED_FOR = "the|les|und|que"
SEGMENTS = (
    ("Home", "household|furniture"),
    ("Works", "machinery|building"),
    ("Cars", "automobile"),
)
PHRASES = ("of the", "in and", "la", "der", "by", "#on")
URGENCY = ((3, ("la", "by")), (2, ("der", "und")), (1, ("the", "of")))
KEYWORDS = ("the", "ing", "ment", "und", "eau", "con", "lich", "er")


def rounded(df, **digits):
    """The frame with some double columns rounded for comparison."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


@checked(
    "q0_read_only_sql",
    with_posts(
        """
        SELECT user_screen AS screen_name, count(*) AS n_posts,
          CAST(sum(favorite_count) AS bigint) AS likes
        FROM posts WHERE NOT is_reshare GROUP BY user_screen
        """
    ),
)
def q0(spark, sf_dir):
    view.register(posts(spark, sf_dir))
    return view.run_sql(
        spark,
        "SELECT user.screen_name, count(*) AS n_posts, sum(favorite_count) AS likes "
        "FROM disasters WHERE retweeted_status IS NULL GROUP BY user.screen_name",
        limit=None,
    )


@checked("q0b_unlimited_sql", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def q0b(spark, sf_dir):
    view.register(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "lines_of_orders")
    return view.run_sql(spark, "SELECT l_orderkey, l_linenumber, l_quantity FROM lines_of_orders")


@checked("q0c_literal_words", "SELECT event_type, 'please drop food' AS said, count(*) AS n FROM events GROUP BY 1, 2")
def q0c(spark, sf_dir):
    view.register(spark.read.parquet(f"{sf_dir}/events.parquet"), "all_events")
    return view.run_sql(spark, "SELECT event_type, 'please drop food' AS said, count(*) AS n FROM all_events GROUP BY 1, 2 -- delete")


@checked(
    "q1_bot_candidates",
    with_posts(
        """
        SELECT * FROM (
          SELECT user_screen AS "Username", count(*) AS "Num_Tweet",
            round(avg(favorite_count), 6) AS "Media_Like_Ricevuti",
            round(avg(retweet_count), 6) AS "ReTweet_Da_Altri", count(rt_id_str) AS "Num_ReTweet",
            round(count(rt_id_str) / count(*), 6) AS "Perc_Retweet",
            max(user_followers) AS "Followers", max(user_friends) AS "Following",
            CASE WHEN max(user_friends) > 0
              THEN round(max(user_followers) / max(user_friends), 6) END AS "Ratio_Followers_Following"
          FROM posts WHERE user_id_str IS NOT NULL GROUP BY user_screen)
        WHERE "Num_Tweet" > 20 AND "Media_Like_Ricevuti" < 80 AND "ReTweet_Da_Altri" < 60
          AND "Perc_Retweet" > 0.1 AND "Ratio_Followers_Following" < 4
        """
    ),
)
def q1(spark, sf_dir):
    found = reports.bot_candidates(
        posts(spark, sf_dir),
        min_posts=20,
        max_mean_likes=80,
        max_mean_reshares=60,
        min_reshare_share=0.1,
        max_follower_ratio=4,
    )
    return rounded(
        found, Media_Like_Ricevuti=6, ReTweet_Da_Altri=6, Perc_Retweet=6, Ratio_Followers_Following=6
    )


@checked(
    "q2_word_frequency",
    with_posts(
        f"""
        , words AS (
          SELECT regexp_replace(w, '[^a-zA-Zàèéìòù]', '', 'g') AS parola_pulita
          FROM (SELECT unnest(regexp_split_to_array(lower(rt_body), '\\s+')) AS w FROM posts
                WHERE is_reshare AND regexp_matches(rt_body, '(?i){WORDS_LOOKED_FOR}')))
        SELECT parola_pulita, count(*) AS frequenza FROM words
        WHERE parola_pulita <> '' AND parola_pulita NOT IN ('a', 'an', 'the', 'is', 'in', 'on', 'for',
          'with', 'of', 'to', 'and', 'rt', 'i', 'you', 'he', 'she', 'our', 'are', 'this', 'by', 'at',
          'as', 'we', 'who', 'it', 'all', 'have', 'so', 'about', 'just')
        GROUP BY parola_pulita
        """
    ),
)
def q2(spark, sf_dir):
    return reports.word_frequency(posts(spark, sf_dir), text_pattern=WORDS_LOOKED_FOR, text_fields=TEXTS)


@checked(
    "q3_author_categories",
    with_posts(
        """
        SELECT "CategoriaUtente", count(DISTINCT rt_user_screen) AS "NumeroUtentiUnici",
          count(rt_id_str) AS "NumeroTweetTotali"
        FROM (SELECT *, CASE WHEN regexp_matches(lower(rt_user_about), 'household|furniture') THEN 'Home'
            WHEN regexp_matches(lower(rt_user_about), 'machinery|building') THEN 'Works'
            WHEN regexp_matches(lower(rt_user_about), 'automobile') THEN 'Cars' END AS "CategoriaUtente"
          FROM posts WHERE is_reshare AND rt_user_about IS NOT NULL)
        WHERE "CategoriaUtente" IS NOT NULL GROUP BY 1
        """
    ),
)
def q3(spark, sf_dir):
    return reports.author_categories(posts(spark, sf_dir), categories=SEGMENTS)


@checked(
    "q4_post_types",
    with_posts(
        """
        SELECT CASE WHEN is_reshare THEN 'Retweet' WHEN quoted_status_id_str IS NOT NULL THEN 'Quote Tweet'
            WHEN reply_count > 0 THEN 'Tweet con Reply' ELSE 'Tweet Originale' END AS tweet_type,
          count(*) AS "count"
        FROM posts GROUP BY 1
        """
    ),
)
def q4(spark, sf_dir):
    return reports.post_types(posts(spark, sf_dir))


@checked(
    "q5_volume_by_minute",
    with_posts(
        """
        SELECT day AS "Data", minute AS "Orario", count(*) AS "Volume_Tweet"
        FROM posts WHERE created_at IS NOT NULL GROUP BY day, minute
        """
    ),
)
def q5(spark, sf_dir):
    return reports.volume_by_minute(posts(spark, sf_dir))


_HELP_SQL = """
    SELECT coalesce(point_lat, box_lat + 1.5) AS "Latitude",
      coalesce(point_lon, box_lon + 2.0) AS "Longitude", place_name AS "Luogo",
      CASE WHEN regexp_matches(lower(body), '(^|[^\\p{L}\\p{N}_])(la|by)([^\\p{L}\\p{N}_]|$)') THEN 3
        WHEN regexp_matches(lower(body), '(^|[^\\p{L}\\p{N}_])(der|und)([^\\p{L}\\p{N}_]|$)') THEN 2
        WHEN regexp_matches(lower(body), '(^|[^\\p{L}\\p{N}_])(the|of)([^\\p{L}\\p{N}_]|$)') THEN 1
        ELSE 0 END AS "PunteggioUrgenza",
      body AS "TestoTweet", user_screen AS "Utente",
      CAST(day AS varchar) || ' ' || minute AS "Data"
    FROM posts
    WHERE regexp_matches(lower(body),
      '(^|[^\\p{L}\\p{N}_])(of the|in and|la|der|by|#on)([^\\p{L}\\p{N}_]|$)')
"""


def _help(spark, sf_dir, need_point):
    found = reports.help_requests(
        posts(spark, sf_dir),
        phrases=PHRASES,
        urgency=URGENCY,
        need_point=need_point,
        text_fields=TEXTS,
    )
    return rounded(found, Latitude=6, Longitude=6)


def _help_oracle(condition: str = "") -> str:
    numbers = 'SELECT * REPLACE (CAST("Latitude" AS double) AS "Latitude", CAST("Longitude" AS double) AS "Longitude")'
    return with_posts(f"{numbers} FROM ({_HELP_SQL} {condition})")


@checked("q6_help_requests", _help_oracle("AND point_lon IS NOT NULL"))
def q6(spark, sf_dir):
    return _help(spark, sf_dir, need_point=True)


@checked("q6b_help_requests_any_place", _help_oracle())
def q6b(spark, sf_dir):
    return _help(spark, sf_dir, need_point=False)


@checked(
    "q7_engagement",
    with_posts(
        """
        SELECT user_name AS "NomeAmplificatore", user_followers AS "FollowerAmplificatore",
          user_verified AS "AmplificatoreVerificato", favorite_count AS "MiPiaceDelRetweet",
          retweet_count AS "RetweetDelRetweet", reply_count AS "RisposteDelRetweet",
          quote_count AS "CitazioniDelRetweet",
          favorite_count + retweet_count + reply_count + quote_count AS "InterazioniTotaliDelRetweet",
          rt_user_name AS "NomeAutoreOriginale", rt_user_followers AS "FollowerAutoreOriginale",
          rt_user_verified AS "AutoreOriginaleVerificato", rt_favorite_count AS "MiPiaceOriginale",
          rt_retweet_count AS "RetweetOriginale", rt_reply_count AS "RisposteOriginale",
          rt_quote_count AS "CitazioniOriginale",
          rt_favorite_count + rt_retweet_count + rt_reply_count + rt_quote_count
            AS "InterazioniTotaliOriginale"
        FROM posts WHERE is_reshare
        """
    ),
)
def q7(spark, sf_dir):
    return reports.engagement(posts(spark, sf_dir))


_DAILY_SQL = """
    SELECT day AS "Giorno", rt_user_name AS "name", rt_user_screen AS screen_name,
      max(rt_user_followers) AS "Followers", count(rt_id_str) AS "NumeroTweet",
      CAST(sum(rt_favorite_count) AS bigint) AS "Mi_Piace_Totali"
    FROM posts WHERE is_reshare AND created_at IS NOT NULL {more}
    GROUP BY day, rt_user_name, rt_user_screen
"""


@checked(
    "q8_daily_keyword_activity",
    with_posts(_DAILY_SQL.format(more="AND regexp_matches(rt_body, '(?i)ment|lich')")),
)
def q8(spark, sf_dir):
    return reports.daily_keyword_activity(
        posts(spark, sf_dir), keywords=("ment", "lich"), text_fields=TEXTS
    )


@checked(
    "q8b_keywords_found",
    with_posts(
        "SELECT id, concat_ws(', ', "
        + ", ".join(f"CASE WHEN contains(lower(rt_body), '{w}') THEN '{w}' END" for w in KEYWORDS)
        + ') AS "KeywordTrovate" FROM posts WHERE is_reshare AND '
        + f"regexp_matches(rt_body, '(?i){'|'.join(KEYWORDS)}')"
    ),
)
def q8b(spark, sf_dir):
    tagged = reports.keyword_posts(posts(spark, sf_dir), keywords=KEYWORDS, text_fields=TEXTS)
    return tagged.select("id", "KeywordTrovate")


@checked(
    "q9_viral_labels",
    with_posts(
        """
        SELECT tweet_id, "Followers", is_verified, CAST(CASE WHEN s > 100 THEN 1 ELSE 0 END AS integer) AS is_viral
        FROM (
          SELECT rt_id_str AS tweet_id, max(rt_user_followers) AS "Followers",
            max(rt_user_verified) AS is_verified, max(rt_retweet_count) + max(retweet_count)
              + max(rt_favorite_count) + max(favorite_count) AS s
          FROM posts WHERE is_reshare GROUP BY rt_id_str
          UNION ALL
          SELECT id_str, user_followers, user_verified, retweet_count + favorite_count
          FROM posts WHERE NOT is_reshare)
        """
    ),
)
def q9(spark, sf_dir):
    return reports.viral_labels(posts(spark, sf_dir))


@checked("q10_daily_activity", with_posts(_DAILY_SQL.format(more="")))
def q10(spark, sf_dir):
    return reports.daily_activity(posts(spark, sf_dir))


@checked("q11_days_present", with_posts('SELECT DISTINCT day AS "Giorno" FROM posts'))
def q11(spark, sf_dir):
    return reports.days_present(posts(spark, sf_dir))


@checked(
    "t1_by_author",
    with_posts(
        """
        SELECT id_str, user_screen AS screen_name, favorite_count FROM posts
        WHERE user_screen IN ('customer#000000005', 'customer#000000010') AND user_verified
        """
    ),
)
def t1(spark, sf_dir):
    found = filters.by_author(
        posts(spark, sf_dir), screen_names=("Customer#000000005", "customer#000000010"), verified=True
    )
    return found.select("id_str", F.col("user.screen_name").alias("screen_name"), "favorite_count")


@checked(
    "t2_by_time",
    with_posts(
        """
        SELECT id_str, created_at FROM posts
        WHERE strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') >= TIMESTAMP '2024-01-03 06:00:00'
          AND strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') < TIMESTAMP '2024-01-09 18:30:00'
        """
    ),
)
def t2(spark, sf_dir):
    found = filters.by_time(
        posts(spark, sf_dir), start="2024-01-03T06:00:00+00:00", end="2024-01-09T18:30:00+00:00"
    )
    return found.select("id_str", "created_at")


@checked(
    "t2b_by_time_pruned",
    with_posts(
        """
        SELECT id_str, created_at FROM posts
        WHERE strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') >= TIMESTAMP '2024-01-03 06:00:00'
          AND strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') < TIMESTAMP '2024-01-09 18:30:00'
        """
    ),
)
def t2b(spark, sf_dir):
    """As t2, on posts stored by day."""
    folder = scratch_path(spark, "posts_by_day")
    sinks.save_posts(posts(spark, sf_dir), folder)
    stored = spark.read.parquet(folder)
    return filters.by_time(stored, start="2024-01-03T06:00:00+00:00", end="2024-01-09T18:30:00+00:00").select("id_str", "created_at")


@checked(
    "t3c_by_hashtag",
    with_posts("SELECT id_str, lang FROM posts WHERE regexp_matches(lower(body), '(^|\\s)#on([^\\p{L}\\p{N}_]|$)')"),
)
def t3c(spark, sf_dir):
    return filters.by_hashtag(posts(spark, sf_dir), ["#ON"]).select("id_str", "lang")


@checked(
    "t3_by_keyword",
    with_posts(
        "SELECT id_str, lang FROM posts "
        "WHERE regexp_matches(lower(body), '(^|[^\\p{L}\\p{N}_])(und|les)([^\\p{L}\\p{N}_]|$)')"
    ),
)
def t3(spark, sf_dir):
    found = filters.by_keyword(posts(spark, sf_dir), ("und", "les"), text_fields=TEXTS)
    return found.select("id_str", "lang")


@checked(
    "t3b_hashtags",
    """
    SELECT hashtag, count(*) AS n_posts FROM (
      SELECT DISTINCT page_id, unnest(regexp_extract_all(lower(url || ' ' || html), '#([\\p{L}\\p{N}_]+)', 1)) AS hashtag
      FROM pages)
    GROUP BY hashtag
    """,
)
def t3b(spark, sf_dir):
    return filters.hashtag_counts(table(spark, sf_dir, "pages"), text=F.concat_ws(" ", "url", "html"))


@checked(
    "t4_top_authors",
    with_posts(
        """
        SELECT user_screen AS screen_name, count(*) AS posts, CAST(sum(favorite_count) AS bigint) AS likes
        FROM posts GROUP BY user_screen ORDER BY likes DESC, screen_name LIMIT 25
        """
    ),
)
def t4(spark, sf_dir):
    return filters.top_authors(posts(spark, sf_dir), n=25)


@checked(
    "t4b_top_posts_per_author",
    with_posts(
        """
        SELECT user_screen AS screen_name, id_str, favorite_count, CAST(rank_in_author AS integer) AS rank_in_author
        FROM (SELECT *, row_number() OVER (PARTITION BY user_screen
                ORDER BY favorite_count DESC, id_str) AS rank_in_author FROM posts)
        WHERE rank_in_author <= 3
        """
    ),
)
def t4b(spark, sf_dir):
    return filters.top_posts_per_author(posts(spark, sf_dir), n=3).select(
        F.col("user.screen_name").alias("screen_name"), "id_str", "favorite_count", "rank_in_author"
    )


@checked(
    "t5_volume_peaks",
    with_posts(
        """
        , hours AS (
          SELECT date_trunc('hour', strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y')) AS h, count(*) AS n
          FROM posts GROUP BY 1),
        sums AS (
          SELECT h, n, least(24, date_diff('hour', min(h) OVER (), h)) AS k, coalesce(sum(n) OVER w, 0) AS s, coalesce(sum(n * n) OVER w, 0) AS q
          FROM hours WINDOW w AS (ORDER BY h RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING)),
        stats AS (
          SELECT h, n, k, s, k * q - s * s AS spread,
            CASE WHEN k > 1 AND k * q - s * s > 0 THEN (n - s / k) / sqrt((k * q - s * s) / (k * (k - 1))) END AS z
          FROM sums)
        SELECT strftime(h, '%Y-%m-%d %H:%M') AS bucket, n AS volume, round(z, 6) AS z_score,
          coalesce(z >= 2.0, false) OR (k > 1 AND spread = 0 AND n * k > s) AS is_peak
        FROM stats
        """
    ),
)
def t5(spark, sf_dir):
    found = filters.volume_peaks(
        posts(spark, sf_dir), bucket_seconds=3600, history=24, z_limit=2.0
    )
    in_utc = F.to_utc_timestamp("bucket", F.current_timezone())
    return rounded(found, z_score=6).withColumn("bucket", F.date_format(in_utc, "yyyy-MM-dd HH:mm"))


_RANGE = {"start": "2024-01-03T06:00:00+00:00", "end": "2024-01-20T18:30:00+00:00"}
_IN_RANGE = """strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') >= TIMESTAMP '2024-01-03 06:00:00'
          AND strptime(created_at, '%a %b %d %H:%M:%S +0000 %Y') < TIMESTAMP '2024-01-20 18:30:00'"""


def _stored_loads(spark, sf_dir):
    """The posts in two loads, the second written twice, and their roll-ups."""
    folder, sums, rows = scratch_path(spark, "posts"), scratch_path(spark, "rollups"), posts(spark, sf_dir)
    for load, part in (("even", 0), ("odd", 1), ("odd", 1)):
        sinks.save_posts(rows.filter(F.col("id") % 2 == part), folder, load)
        rollups.save_rollups(spark, folder, sums, load)
    return folder, sums


@checked(
    "q5b_volume_of_range",
    with_posts(f'SELECT day AS "Data", minute AS "Orario", count(*) AS "Volume_Tweet" FROM posts WHERE {_IN_RANGE} GROUP BY day, minute'),
)
def q5b(spark, sf_dir):
    return rollups.volume_by_minute(spark, *_stored_loads(spark, sf_dir), **_RANGE)


@checked("q10b_activity_of_range", with_posts(_DAILY_SQL.format(more=f"AND {_IN_RANGE}")))
def q10b(spark, sf_dir):
    return rollups.daily_activity(spark, *_stored_loads(spark, sf_dir), **_RANGE)


@checked("t5c_peaks_of_range", ORACLES["t5_volume_peaks"].replace("FROM posts GROUP BY 1", f"FROM posts WHERE {_IN_RANGE} GROUP BY 1"))
def t5c(spark, sf_dir):
    found = rollups.volume_peaks(spark, *_stored_loads(spark, sf_dir), **_RANGE, bucket_minutes=60, history=24, z_limit=2.0)
    in_utc = F.to_utc_timestamp("bucket", F.current_timezone())
    return rounded(found, z_score=6).withColumn("bucket", F.date_format(in_utc, "yyyy-MM-dd HH:mm"))
