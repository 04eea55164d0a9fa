"""Reports on the post table, one function per saved query.

Every function takes the nested post DataFrame and returns a DataFrame. Null tests that prune rows
come before pattern matches, and only the leaves named here are read from wide structs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as fixed
from tidemark.functions.columns import (
    any_case,
    box_centre_axis,
    found_keywords,
    point_axis,
    post_day,
    post_minute,
    ratio,
    text_of,
    whole_words,
)

TEXT_FIELDS = ("full_text", "text")
ORIGINAL = "retweeted_status"


# Always true. Using one field beside a null test lets Spark read that field instead of the whole struct.
_ONE_FIELD = "coalesce(length(retweeted_status.id_str), 0) >= 0"


def is_reshare() -> Column:
    """Whether a post reshares another one."""
    return F.col(ORIGINAL).isNotNull() & F.expr(_ONE_FIELD)


def is_plain() -> Column:
    """Whether a post reshares nothing."""
    return F.col(ORIGINAL).isNull() & F.expr(_ONE_FIELD)


def bot_candidates(
    posts: DataFrame,
    *,
    min_posts: int = fixed.BOT_MIN_POSTS,
    max_mean_likes: float = fixed.BOT_MAX_MEAN_LIKES,
    max_mean_reshares: float = fixed.BOT_MAX_MEAN_RESHARES,
    min_reshare_share: float = fixed.BOT_MIN_RESHARE_SHARE,
    max_follower_ratio: float = fixed.BOT_MAX_FOLLOWER_RATIO,
) -> DataFrame:
    """Very active accounts that mostly reshare, are hardly liked and follow many more than follow them."""
    per_author = (
        posts.filter(F.col("user.id_str").isNotNull())
        .groupBy(F.col("user.screen_name").alias("Username"))
        .agg(
            F.count(F.lit(1)).alias("Num_Tweet"),
            F.avg("favorite_count").alias("Media_Like_Ricevuti"),
            F.avg("retweet_count").alias("ReTweet_Da_Altri"),
            F.count("retweeted_status.id_str").alias("Num_ReTweet"),
            F.max("user.followers_count").alias("Followers"),
            F.max("user.friends_count").alias("Following"),
        )
    )
    return (
        per_author.withColumns(
            {
                "Perc_Retweet": ratio(F.col("Num_ReTweet"), F.col("Num_Tweet")),
                "Ratio_Followers_Following": ratio(F.col("Followers"), F.col("Following")),
            }
        )
        .filter(
            (F.col("Num_Tweet") > min_posts)
            & (F.col("Media_Like_Ricevuti") < max_mean_likes)
            & (F.col("ReTweet_Da_Altri") < max_mean_reshares)
            & (F.col("Perc_Retweet") > min_reshare_share)
            & (F.col("Ratio_Followers_Following") < max_follower_ratio)
        )
        .select(
            "Username",
            "Num_Tweet",
            "Media_Like_Ricevuti",
            "ReTweet_Da_Altri",
            "Num_ReTweet",
            "Perc_Retweet",
            "Followers",
            "Following",
            "Ratio_Followers_Following",
        )
        .orderBy(F.desc("Num_Tweet"))
    )


def word_frequency(
    posts: DataFrame,
    *,
    text_pattern: str = fixed.WORD_TEXT_PATTERN,
    stop_words: Sequence[str] = fixed.STOP_WORDS,
    letters: str = fixed.WORD_LETTERS,
    text_fields: Sequence[str] = TEXT_FIELDS,
) -> DataFrame:
    """Words of the reshared texts that match ``text_pattern``, most frequent first.

    All but ``letters`` and white space is removed once per text, and unwanted words leave the array
    before it is exploded; measured several times faster than a filter on the exploded words.
    """
    text = text_of(ORIGINAL, text_fields)
    cleaned = F.regexp_replace(F.lower(text), rf"[^{letters}\s]", "")
    words = F.filter(F.split(cleaned, r"\s+"), lambda word: ~word.isin("", *stop_words))
    return (
        posts.filter(F.col(ORIGINAL).isNotNull())
        .filter(text.rlike(any_case(text_pattern)))
        .select(F.explode(words).alias("parola_pulita"))
        .groupBy("parola_pulita")
        .agg(F.count(F.lit(1)).alias("frequenza"))
        .orderBy(F.desc("frequenza"))
    )


def first_category(text: Column, categories: Sequence[tuple[str, str]]) -> Column:
    """Label of the first pattern found in the lower-cased text, else NULL."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(lowered.rlike(pattern), F.lit(label)) for label, pattern in categories])


def author_categories(
    posts: DataFrame, *, categories: Sequence[tuple[str, str]] = fixed.AUTHOR_CATEGORIES
) -> DataFrame:
    """Distinct authors and posts per category of the reshared author's profile text."""
    category = first_category(F.col("retweeted_status.user.description"), categories)
    return (
        posts.filter(F.col("retweeted_status.user.description").isNotNull())
        .select(
            category.alias("CategoriaUtente"),
            F.col("retweeted_status.user.screen_name").alias("screen_name"),
            F.col("retweeted_status.id_str").alias("id_str"),
        )
        .filter(F.col("CategoriaUtente").isNotNull())
        # Per author first: a category may hold most rows, its authors are spread over all tasks.
        .groupBy("CategoriaUtente", "screen_name")
        .agg(F.count("id_str").alias("posts"))
        .groupBy("CategoriaUtente")
        .agg(
            F.count("screen_name").alias("NumeroUtentiUnici"),
            F.sum("posts").alias("NumeroTweetTotali"),
        )
        .orderBy(F.desc("NumeroUtentiUnici"))
    )


def post_types(posts: DataFrame) -> DataFrame:
    """Reshares, quotes, posts with replies and plain originals."""
    kind = (
        F.when(is_reshare(), fixed.POST_TYPE_RESHARE)
        .when(F.col("quoted_status_id_str").isNotNull(), fixed.POST_TYPE_QUOTE)
        .when(F.col("reply_count") > 0, fixed.POST_TYPE_REPLIED)
        .otherwise(fixed.POST_TYPE_ORIGINAL)
    )
    return (
        posts.groupBy(kind.alias("tweet_type"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"))
    )


def volume_by_minute(posts: DataFrame) -> DataFrame:
    """Posts per day and minute."""
    created = F.col("created_at")
    return (
        posts.filter(created.isNotNull())
        .groupBy(post_day(created).alias("Data"), post_minute(created).alias("Orario"))
        .agg(F.count(F.lit(1)).alias("Volume_Tweet"))
        .orderBy("Data", "Orario")
    )


def help_requests(
    posts: DataFrame,
    *,
    phrases: Sequence[str] = fixed.HELP_PHRASES,
    urgency: Sequence[tuple[int, Sequence[str]]] = fixed.URGENCY_WORDS,
    need_point: bool = True,
    text_fields: Sequence[str] = TEXT_FIELDS,
) -> DataFrame:
    """Posts that ask for help, with place and urgency.

    The position is the point, else the centre of the bounding box. ``need_point=False`` also keeps
    posts without a point.
    """
    text = text_of(None, text_fields)
    created = F.col("created_at")
    point, box = F.col("coordinates.coordinates"), F.col("place.bounding_box.coordinates")
    chosen = posts.filter(point.isNotNull()) if need_point else posts
    score = F.coalesce(
        *[F.when(F.lower(text).rlike(whole_words(words)), F.lit(level)) for level, words in urgency],
        F.lit(0),
    )
    return (
        chosen.filter(F.lower(text).rlike(whole_words(phrases)))
        .select(
            F.coalesce(point_axis(point, 1), box_centre_axis(box, 1)).alias("Latitude"),
            F.coalesce(point_axis(point, 0), box_centre_axis(box, 0)).alias("Longitude"),
            F.col("place.name").alias("Luogo"),
            score.alias("PunteggioUrgenza"),
            text.alias("TestoTweet"),
            F.col("user.screen_name").alias("Utente"),
            F.concat(post_day(created).cast("string"), F.lit(" "), post_minute(created)).alias("Data"),
        )
        .orderBy(F.desc("PunteggioUrgenza"), "Data")
    )


def engagement(posts: DataFrame) -> DataFrame:
    """Counters of each reshare beside those of its original; a total is NULL if a counter is."""

    def total(inside: str) -> Column:
        names = ("favorite_count", "retweet_count", "reply_count", "quote_count")
        first, *rest = [F.col(inside + name) for name in names]
        for counter in rest:
            first = first + counter
        return first

    original = ORIGINAL + "."
    return (
        posts.filter(F.col(ORIGINAL).isNotNull())
        .select(
            F.col("user.name").alias("NomeAmplificatore"),
            F.col("user.followers_count").alias("FollowerAmplificatore"),
            F.col("user.verified").alias("AmplificatoreVerificato"),
            F.col("favorite_count").alias("MiPiaceDelRetweet"),
            F.col("retweet_count").alias("RetweetDelRetweet"),
            F.col("reply_count").alias("RisposteDelRetweet"),
            F.col("quote_count").alias("CitazioniDelRetweet"),
            total("").alias("InterazioniTotaliDelRetweet"),
            F.col(original + "user.name").alias("NomeAutoreOriginale"),
            F.col(original + "user.followers_count").alias("FollowerAutoreOriginale"),
            F.col(original + "user.verified").alias("AutoreOriginaleVerificato"),
            F.col(original + "favorite_count").alias("MiPiaceOriginale"),
            F.col(original + "retweet_count").alias("RetweetOriginale"),
            F.col(original + "reply_count").alias("RisposteOriginale"),
            F.col(original + "quote_count").alias("CitazioniOriginale"),
            total(original).alias("InterazioniTotaliOriginale"),
        )
        .orderBy(F.desc("InterazioniTotaliOriginale"))
    )


def keyword_posts(
    posts: DataFrame,
    *,
    keywords: Sequence[str] = fixed.DAILY_KEYWORDS,
    text_fields: Sequence[str] = TEXT_FIELDS,
) -> DataFrame:
    """Reshares whose original text holds a keyword, with the keywords found as ``KeywordTrovate``."""
    text = text_of(ORIGINAL, text_fields)
    return (
        posts.filter(F.col(ORIGINAL).isNotNull())
        .filter(text.rlike(any_case("|".join(rf"\Q{word}\E" for word in keywords))))
        .withColumn("KeywordTrovate", found_keywords(text, keywords))
    )


def daily_activity(posts: DataFrame) -> DataFrame:
    """Per day and reshared author: most followers, posts, likes."""
    author = "retweeted_status.user."
    return (
        posts.filter(F.col(ORIGINAL).isNotNull() & F.col("created_at").isNotNull())
        .groupBy(
            post_day(F.col("created_at")).alias("Giorno"),
            F.col(author + "name").alias("name"),
            F.col(author + "screen_name").alias("screen_name"),
        )
        .agg(
            F.max(author + "followers_count").alias("Followers"),
            F.count("retweeted_status.id_str").alias("NumeroTweet"),
            F.sum("retweeted_status.favorite_count").alias("Mi_Piace_Totali"),
        )
        .orderBy("Giorno", F.desc("Mi_Piace_Totali"))
    )


def daily_keyword_activity(
    posts: DataFrame,
    *,
    keywords: Sequence[str] = fixed.DAILY_KEYWORDS,
    text_fields: Sequence[str] = TEXT_FIELDS,
) -> DataFrame:
    """``daily_activity`` of the posts that hold a keyword."""
    return daily_activity(keyword_posts(posts, keywords=keywords, text_fields=text_fields))


def viral_labels(posts: DataFrame, *, viral_above: int = fixed.VIRAL_ABOVE) -> DataFrame:
    """One row per reshared original and one per plain original, with ``is_viral`` 0 or 1.

    The table holds no reshared original as a row of its own kind; both branches stay apart.
    """

    def labelled(branch: DataFrame) -> DataFrame:
        return branch.select(
            "tweet_id",
            "Followers",
            "is_verified",
            F.when(F.col("reshares") + F.col("likes") > viral_above, 1).otherwise(0).alias("is_viral"),
        )

    reshared = (
        posts.filter(F.col(ORIGINAL).isNotNull())
        .groupBy(F.col("retweeted_status.id_str").alias("tweet_id"))
        .agg(
            F.max("retweeted_status.user.followers_count").alias("Followers"),
            F.max("retweeted_status.user.verified").alias("is_verified"),
            (F.max("retweeted_status.retweet_count") + F.max("retweet_count")).alias("reshares"),
            (F.max("retweeted_status.favorite_count") + F.max("favorite_count")).alias("likes"),
        )
    )
    plain = posts.filter(is_plain()).select(
        F.col("id_str").alias("tweet_id"),
        F.col("user.followers_count").alias("Followers"),
        F.col("user.verified").alias("is_verified"),
        F.col("retweet_count").alias("reshares"),
        F.col("favorite_count").alias("likes"),
    )
    return labelled(reshared).unionByName(labelled(plain))


def days_present(posts: DataFrame) -> DataFrame:
    """The distinct days of the table."""
    return (
        posts.filter(F.col("created_at").isNotNull())
        .select(post_day(F.col("created_at")).alias("Giorno"))
        .distinct()
        .orderBy("Giorno")
    )
