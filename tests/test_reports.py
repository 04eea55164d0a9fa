"""Reports with their default words and limits on hand-written posts."""

import datetime

import pytest

from tidemark.operators import filters, reports, view

USER = "struct<id_str:string,name:string,screen_name:string,description:string,followers_count:bigint,friends_count:bigint,verified:boolean>"
INNER = f"struct<id_str:string,text:string,full_text:string,favorite_count:bigint,retweet_count:bigint,reply_count:bigint,quote_count:bigint,user:{USER}>"
SCHEMA = (
    "id_str string, created_at string, text string, full_text string, favorite_count bigint, retweet_count bigint, "
    "reply_count bigint, quote_count bigint, quoted_status_id_str string, coordinates struct<coordinates:string>, "
    f"place struct<name:string,bounding_box:struct<coordinates:string>>, user {USER}, retweeted_status {INNER}, "
    "entities struct<hashtags:array<struct<text:string>>>"
)
WHEN = "Sat Aug 26 21:39:07 +0000 2017"


def user(name="ann", about=None, followers=10, friends=20, verified=False, id_str="u"):
    return (id_str, name.title(), name, about, followers, friends, verified)


def original(id_str="o", text=None, full_text=None, likes=1, reshares=1, replies=1, quotes=1, author=None):
    return (id_str, text, full_text, likes, reshares, replies, quotes, author or user("orig"))


def post(id_str="p", when=WHEN, text=None, full_text=None, likes=0, reshares=0, replies=0, quotes=0, quoted=None,
         point=None, place=None, author=None, of=None, tags=None):
    return (
        id_str, when, text, full_text, likes, reshares, replies, quotes, quoted,
        (point,) if point else None, place, author or user(), of, ([(t,) for t in tags],) if tags else None,
    )


@pytest.fixture
def table(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_bot_candidates_default_limits(table):
    busy = user("bot", followers=1, friends=100)
    rows = [post(f"b{i}", author=busy, of=original() if i else None) for i in range(102)]
    rows += [post(f"n{i}", author=user("nofriends", friends=0), of=original()) for i in range(102)]
    rows += [post("few", author=user("quiet", followers=1, friends=100), of=original())]
    rows += [post("x", author=user("noid", id_str=None))]
    found = reports.bot_candidates(table(*rows)).collect()
    assert [(r["Username"], r["Num_Tweet"], r["Num_ReTweet"]) for r in found] == [("bot", 102, 101)]
    assert found[0]["Perc_Retweet"] == pytest.approx(101 / 102)
    assert found[0]["Ratio_Followers_Following"] == pytest.approx(0.01)


def test_word_frequency(table):
    rows = [
        post(of=original(text="short hurricane", full_text="The HURRICANE, is   perché naïve; I help! è")),
        post(of=original(text="nothing of interest")),
        post(text="hurricane in a plain post"),
    ]
    found = {r["parola_pulita"]: r["frequenza"] for r in reports.word_frequency(table(*rows)).collect()}
    assert found == {"hurricane": 1, "perché": 1, "nave": 1, "help": 1, "è": 1}


def test_author_categories_first_match_wins(table):
    rows = [
        post(of=original("1", author=user("a", about="News volunteer"))),
        post(of=original("2", author=user("a", about="News volunteer"))),
        post(of=original("3", author=user("b", about="RED CROSS"))),
        post(of=original(None, author=user("c", about="FEMA official"))),
        post(of=original("5", author=user("d", about="gardener"))),
        post(of=original("6", author=user("e"))),
    ]
    found = {tuple(r) for r in reports.author_categories(table(*rows)).collect()}
    assert found == {("Media/Giornalista", 1, 2), ("Volontario/Soccorritore", 1, 1), ("Governo/Ufficiale", 1, 0)}


def test_post_types_first_match_wins(table):
    rows = [post(of=original(), quoted="1"), post(quoted="1", replies=3), post(replies=1), post(), post(replies=None)]
    found = {r["tweet_type"]: r["count"] for r in reports.post_types(table(*rows)).collect()}
    assert found == {"Retweet": 1, "Quote Tweet": 1, "Tweet con Reply": 1, "Tweet Originale": 2}


def test_volume_keeps_malformed_times(table):
    found = reports.volume_by_minute(table(post(), post(), post(when="xx"), post(when=None))).collect()
    assert [tuple(r) for r in found] == [(None, ":", 1), (datetime.date(2017, 8, 26), "21:39", 2)]


def test_help_requests(table):
    box = ("Here", ("[[[-96, 29], [-96, 31], [-94, 31], [-94, 29]]]",))
    rows = [
        post(text="We are TRAPPED, send help", point="[-95.5, 29.25]", place=("Town", (None,))),
        post(text="please help", point="[-95.5, 29.25]", when="Sat Aug 26 20:00:00 +0000 2017"),
        post(text="please help", point="not a point", place=box),
        post(text="stuck in water", place=box),
        post(text="white hits are no help", point="[1, 2]"),
        post(text="see #Fay now", point="[1, 2]"),
    ]
    found = reports.help_requests(table(*rows)).collect()
    assert [(r["PunteggioUrgenza"], r["Latitude"], r["Longitude"], r["Luogo"]) for r in found] == [
        (3, 29.25, -95.5, "Town"), (1, 29.25, -95.5, None), (1, 30.0, -95.0, "Here"), (0, 2.0, 1.0, None),
    ]
    assert found[0]["Data"] == "2017-08-26 21:39"
    everywhere = reports.help_requests(table(*rows), need_point=False).collect()
    assert [r["PunteggioUrgenza"] for r in everywhere] == [3, 2, 1, 1, 0]


def test_engagement_total_is_null_when_a_counter_is(table):
    rows = [post(likes=1, reshares=2, replies=3, quotes=4, of=original(likes=None)), post(of=original(likes=7)), post()]
    found = reports.engagement(table(*rows)).collect()
    assert [(r["InterazioniTotaliDelRetweet"], r["InterazioniTotaliOriginale"]) for r in found] == [(0, 10), (10, None)]


def test_daily_activity_and_keywords(table):
    rows = [
        post(of=original("1", text="Storm and FLOOD", likes=5)),
        post(of=original("2", text="nice", likes=1)),
        post(of=original("3", text="window", likes=None), when="Sun Aug 27 21:39:07 +0000 2017"),
        post(text="storm"),
    ]
    all_days = [tuple(r) for r in reports.daily_activity(table(*rows)).collect()]
    first, second = datetime.date(2017, 8, 26), datetime.date(2017, 8, 27)
    assert all_days == [(first, "Orig", "orig", 10, 2, 6), (second, "Orig", "orig", 10, 1, None)]
    tagged = reports.daily_keyword_activity(table(*rows)).collect()
    assert [(r["Giorno"], r["NumeroTweet"]) for r in tagged] == [(first, 1), (second, 1)]
    words = [r["KeywordTrovate"] for r in reports.keyword_posts(table(*rows)).collect()]
    assert sorted(words) == ["storm, flood", "wind"]


def test_viral_labels(table):
    rows = [
        post("1", likes=1, reshares=0, of=original("o", likes=60, reshares=40)),
        post("2", likes=0, reshares=1, of=original("o", likes=50, reshares=40)),
        post("3", likes=100, reshares=1),
        post("4", likes=None, reshares=500),
        post("5", likes=100, reshares=0),
    ]
    found = {r["tweet_id"]: r["is_viral"] for r in reports.viral_labels(table(*rows)).collect()}
    assert found == {"o": 1, "3": 1, "4": 0, "5": 0}


def test_read_only_view(spark, table):
    view.register(table(post(), post(of=original())))
    assert view.run_sql(spark, "select count(*) AS n from disasters;").first()["n"] == 2
    assert view.run_sql(spark, "SELECT 'dropped' AS drop_it FROM disasters").count() == 2
    for text in ("", "drop table x", "INSERT INTO t SELECT 1", "WITH a AS (SELECT 1) DELETE FROM t", "SELECT 1;DROP VIEW v"):
        with pytest.raises(ValueError):
            view.run_sql(spark, text)
    many = spark.range(50)
    assert view.limited(many, 3, order_by=["id"]).count() == 3
    assert view.limited(many).count() == view.run_sql(spark, "SELECT * FROM range(50)").count() == 50
    assert view.run_sql(spark, "SELECT 'please drop food' AS t, `id` AS `update` FROM range(9) -- delete", limit=5).count() == 5
    assert view.limited(many, 20).first()["total_rows"] == 50
    assert view.limited(many.filter("id < 0")).count() == 0


def test_filters(table):
    posts = table(
        post("1", text="Water is rising #Harvey", author=user("Ann", verified=True), tags=["Harvey"]),
        post("2", text="the rising", when="Sun Aug 27 00:00:00 +0000 2017", author=user("bob")),
        post("3", text="surprising", when="broken"),
    )
    ids = lambda df: sorted(r["id_str"] for r in df.collect())
    assert ids(filters.by_author(posts, screen_names=["ANN", "bob"])) == ["1", "2", "3"]
    assert ids(filters.by_author(posts, verified=True)) == ["1"]
    assert ids(filters.by_time(posts, start="2017-08-27T00:00:00Z")) == ["2"]
    assert ids(filters.by_time(posts, end="2017-08-27T00:00:00Z")) == ["1"]
    assert ids(filters.by_keyword(posts, ["Rising"])) == ["1", "2"]
    assert ids(filters.by_hashtag(posts, ["#harvey"])) == ["1"]
    assert ids(filters.by_hashtag(posts, ["harvey"], from_entities=True)) == ["1"]
    assert [r["id_str"] for r in filters.top_posts(posts, n=2).collect()] == ["1", "2"]


def test_volume_peaks_across_stretches(spark, table, monkeypatch):
    start = datetime.datetime(2017, 8, 26)
    rows = []
    for minute in range(40):
        when = (start + datetime.timedelta(minutes=minute)).strftime("%a %b %d %H:%M:%S +0000 %Y")
        rows += [post(f"{minute}-{i}", when=when) for i in range(9 if minute == 35 else 1 + minute % 2)]
    found = filters.volume_peaks(table(*rows), bucket_seconds=60, history=10, z_limit=3.0)
    assert [r["bucket"] for r in found.filter("is_peak").collect()] == [start + datetime.timedelta(minutes=35)]
    # The same with stretches barely longer than the history.
    monkeypatch.setattr(filters, "STRETCH_SLOTS", 10)
    short = filters.volume_peaks(table(*rows), bucket_seconds=60, history=10, z_limit=3.0)
    assert sorted(found.collect()) == sorted(short.collect())


def test_a_burst_after_silence_is_a_peak(table):
    start = datetime.datetime(2017, 8, 26)
    rows = []
    for minute, n in [(0, 1), (1, 1), (2, 1), (242, 30)]:
        when = (start + datetime.timedelta(minutes=minute)).strftime("%a %b %d %H:%M:%S +0000 %Y")
        rows += [post(f"{minute}-{i}", when=when) for i in range(n)]
    found = filters.volume_peaks(table(*rows), bucket_seconds=60, history=60).filter("is_peak").collect()
    assert [(r["bucket"], r["z_score"]) for r in found] == [(start + datetime.timedelta(minutes=242), None)]


def test_stored_posts_are_pruned_by_day(spark, table, tmp_path):
    from tidemark.sources import sinks

    rows = [post(str(i), when=f"Sat Aug {26 + i} 10:00:00 +0000 2017") for i in range(4)] + [post("9", when="broken")]
    sinks.save_posts(table(*rows), str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    found = filters.by_time(stored, start="2017-08-27T00:00:00Z", end="2017-08-28T10:00:00Z")
    assert [r["id_str"] for r in found.collect()] == ["1"] and stored.count() == 5
    plan = found._jdf.queryExecution().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_reports_read_only_the_fields_they_need(spark, table, tmp_path):
    table(post(of=original())).write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    for report in (reports.post_types, reports.viral_labels, reports.volume_by_minute, reports.daily_activity):
        plan = report(stored)._jdf.queryExecution().executedPlan().toString()
        assert "text:string" not in plan and "ReadSchema" in plan
