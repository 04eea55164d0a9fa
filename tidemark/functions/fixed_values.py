"""Word lists, patterns, labels and limits that results depend on.

They are the defaults of the operators; every operator takes other values as arguments.
"""

# Name of the registered view.
DEFAULT_VIEW = "disasters"

# Read-only SQL: allowed first words, rejected words.
SQL_FIRST_WORDS = ("SELECT", "WITH", "SHOW", "DESCRIBE", "EXPLAIN")
SQL_REJECTED_WORDS = ("DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "CREATE", "TRUNCATE")

# Keys that mark a record as a post, and how many of them are needed.
POST_MARKERS = ("created_at", "user", "entities", "text", "id", "id_str", "retweet_count")
POST_MARKERS_NEEDED = 3

# Bot candidates.
BOT_MIN_POSTS = 100
BOT_MAX_MEAN_LIKES = 1.0
BOT_MAX_MEAN_RESHARES = 1.0
BOT_MIN_RESHARE_SHARE = 0.9
BOT_MAX_FOLLOWER_RATIO = 0.1

# Word frequency: which texts, which words are left out.
WORD_TEXT_PATTERN = "hurricane|emergency|help"
WORD_LETTERS = "a-zA-Zàèéìòù"
STOP_WORDS = (
    "a", "an", "the", "is", "in", "on", "for", "with", "of", "to", "and", "rt", "i", "you", "he",
    "she", "our", "are", "this", "by", "at", "as", "we", "who", "it", "all", "have", "so", "about",
    "just",
)

# Author categories: label and pattern on the lower-cased profile text; the first match wins.
AUTHOR_CATEGORIES = (
    ("Media/Giornalista", "journalist|reporter|media|news"),
    ("Volontario/Soccorritore", "volunteer|rescue|relief|red cross"),
    ("Governo/Ufficiale", "official|government|department|emergency management|fema"),
    ("Esperto/Scienziato", "expert|scientist|researcher|meteorologist"),
    ("Organizzazione/ONG", "organization|ngo|non-profit"),
)

# Labels of the post types.
POST_TYPE_RESHARE = "Retweet"
POST_TYPE_QUOTE = "Quote Tweet"
POST_TYPE_REPLIED = "Tweet con Reply"
POST_TYPE_ORIGINAL = "Tweet Originale"

# Help requests: phrases that select a post, words that set its urgency.
HELP_PHRASES = (
    "need help", "needs help", "send help", "please help", "we are stuck", "i am stuck",
    "we are trapped", "i am trapped", "stuck in", "trapped by", "water is rising", "sos",
    "need rescue", "send rescue", "hit", "hitted", "#fay", "#rescue", "#911us",
)
URGENCY_WORDS = (
    (3, ("sos", "trapped", "911", "mayday")),
    (2, ("stuck", "rescue", "rising", "surrounded")),
    (1, ("help", "assistance")),
)

# Keywords of the daily author report.
DAILY_KEYWORDS = (
    "hurricane", "emergency", "fema", "donation", "disaster", "storm", "relief", "rescue",
    "damage", "flood", "wind", "volunteer", "support", "help", "victim",
)

# Likes plus reshares above which a post is viral.
VIRAL_ABOVE = 100

# Fields dropped from a post and from the posts inside it.
POST_FIELDS_DROPPED = (
    "id", "lang", "in_reply_to_status_id", "quoted_status_id", "possibly_sensitive", "source",
    "truncated", "favorited", "retweeted", "geo", "filter_level", "timestamp_ms", "contributors",
    "extended_entities", "in_reply_to_screen_name", "in_reply_to_status_id_str",
    "in_reply_to_user_id", "in_reply_to_user_id_str", "is_quote_status", "entities",
)

# Fields dropped from the author of a post.
USER_FIELDS_DROPPED = (
    "id", "listed_count", "created_at", "utc_offset", "time_zone", "url", "entities",
    "geo_enabled", "contributors_enabled", "is_translator", "favourites_count",
    "is_translation_enabled", "profile_background_color", "statuses_count",
    "profile_background_image_url", "profile_background_image_url_https",
    "profile_background_tile", "profile_image_url", "profile_image_url_https",
    "profile_banner_url", "profile_link_color", "profile_sidebar_border_color",
    "profile_sidebar_fill_color", "profile_text_color", "profile_use_background_image",
    "has_extended_profile", "default_profile", "default_profile_image", "protected",
    "translator_type", "following", "follow_request_sent", "notifications",
)

# Nested columns written as JSON text.
JSON_TEXT_COLUMNS = (
    "place", "retweeted_status", "user", "entities", "extended_entities", "quoted_status",
)

# Marker row of the type report for a file that is not valid JSON.
BROKEN_FILE_COLUMN = "_FILE_CORROTTO_O_ILLEGGIBILE_"
BROKEN_FILE_TYPE = "JSONDecodeError"

# Chart limits.
CHART_MAX_POINTS = 500
PIE_MAX_SLICES = 10
CROSSTAB_MAX_VALUES = 50
DENSITY_BINS = 50
COUNT_NAME = "Conteggio"

# Machine learning.
ML_SEED = 42
ROWS_PER_TASK_LEAST = 20_000
ROWS_PER_TASK_MOST = 2_000_000
MIN_ROWS_CLUSTERING = 10
MIN_ROWS_SUPERVISED = 50
HASHED_FEATURES = 256
KMEANS_MAX_K = 10
KMEANS_MAX_ITER = 20
KMEANS_TOL = 1e-4
FOREST_TREES = (10, 20, 50)
FOREST_DEPTHS = (5, 10, 15)
BOOST_ROUNDS = (10, 20)
BOOST_DEPTHS = (5, 10)
CV_FOLDS = 3
LINEAR_MAX_ITER = 10
LINEAR_REG = 0.1
CLASS_MAX_VALUES = 10
DBSCAN_EPS = (0.3, 0.5, 0.7, 1.0)
DBSCAN_MIN_SAMPLES = (5, 10)
CONTAMINATION_LEVELS = (0.05, 0.1, 0.15)
ISOLATION_TREES = 100
ISOLATION_ROWS = 256
NOISE_NAME = "Noise"
