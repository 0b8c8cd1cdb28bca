from datetime import timedelta

from conftest import at, micros
from pyspark.sql import functions as F

from driftlake.plans import marts, panels
from driftlake.plans.views import register_views
from driftlake.schemas import TABLES

AS_OF = at("12:00:00")


def tables(rows, **given):
    return {name: rows(name, *given.get(name, ())) for name in TABLES}


def tag_rows(tag, minute, count):
    start = at("00:00:00") + timedelta(minutes=12 * 60 - minute)
    return [{"tag": tag, "author_did": "a", "event_time": start} for _ in range(count)]


def test_trending_needs_five_uses_and_ranks_new_tags_last(rows):
    spikes = panels.panel_trending_hashtags(
        tables(
            rows,
            core_hashtags=[
                *tag_rows("hot", 2, 6),
                *tag_rows("hot", 10, 2),
                *tag_rows("hot", 20, 4),
                *tag_rows("new", 1, 5),
                *tag_rows("rare", 1, 4),
                *tag_rows("old", 12, 50),
                *tag_rows("older", 45, 50),
            ],
        ),
        AS_OF,
    ).collect()
    assert [(row.tag, row.current_count, row.baseline_count, row.spike_ratio) for row in spikes] == [
        ("hot", 6, 3.0, 2.0),
        ("new", 5, 0.0, None),
    ]


def test_trending_window_edges(rows):
    """A minute belongs to the side its start is on; the baseline ends where the current side starts."""
    spikes = panels.panel_trending_hashtags(
        tables(rows, core_hashtags=[*tag_rows("t", 5, 5), *tag_rows("t", 6, 7), *tag_rows("t", 30, 9), *tag_rows("t", 31, 99)]),
        AS_OF,
    ).first()
    assert (spikes.current_count, spikes.baseline_count) == (5, 8.0)


def test_trending_plan_has_one_scan_and_no_join(spark, rows, tmp_path):
    rows("core_hashtags", *tag_rows("t", 1, 5)).write.parquet(str(tmp_path / "tags"))
    panel = panels.panel_trending_hashtags({"core_hashtags": spark.read.parquet(str(tmp_path / "tags"))}, AS_OF)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange") == 1
    assert "GreaterThanOrEqual(event_time" in plan


def test_top_panels_are_limited_and_stable(rows):
    mentions = [{"author_did": "a", "mentioned_did": f"did:{n:02d}", "event_time": at("11:55:00")} for n in range(25)]
    top = panels.panel_most_mentioned(tables(rows, core_mentions=mentions), AS_OF).collect()
    assert [row.mentioned_did for row in top] == [f"did:{n:02d}" for n in range(20)]


def test_panels_drop_the_partly_covered_bucket(rows):
    """The bucket starts before the window although its event lies inside."""
    posts = [
        {"event_time": at("11:45:40"), "primary_lang": "en"},
        {"event_time": at("11:46:10"), "primary_lang": "ja"},
    ]
    as_of = at("12:00:30")
    mix = panels.panel_language_distribution(tables(rows, core_posts=posts), as_of).collect()
    assert [(row.primary_lang, row.post_count) for row in mix] == [("ja", 1)]


def test_unknown_embeds_and_empty_sums(rows):
    given = tables(rows, core_posts=[{"event_time": at("11:59:00"), "embed_type": None, "content_type": None}])
    assert panels.panel_embed_usage(given, AS_OF).first().embed_category == "unknown"
    assert panels.panel_content_breakdown(given, AS_OF).first().content_type == "unknown"
    assert panels.panel_total_events(given, AS_OF).first().total_events == 0
    assert panels.panel_active_users(given, AS_OF).first().active_users == 0
    assert panels.panel_active_users(given, AS_OF, distinct=True).first().active_users == 0


def test_pipeline_health_of_nothing_is_one_row(rows):
    health = marts.mart_pipeline_health(tables(rows), AS_OF).collect()
    assert len(health) == 1
    assert health[0].events_last_minute == 0 and health[0].processing_lag_seconds is None


def test_pipeline_health(rows):
    raw = [
        {"ingested_at": at("11:59:30.9"), "time_us": micros(at("11:59:29"))},
        {"ingested_at": at("11:59:00"), "time_us": 1},
        {"ingested_at": at("11:58:59.999"), "time_us": 2},
    ]
    health = marts.mart_pipeline_health(tables(rows, raw_events=raw), AS_OF).select(
        "*", F.unix_micros("max_event_time").alias("us")
    ).first()
    assert health.events_last_minute == 2
    assert health.events_per_second == 2 / 60
    assert health.processing_lag_seconds == 30.0
    assert health.us == micros(at("11:59:29"))


def test_active_users_adds_buckets_unless_distinct(rows):
    raw = [
        {"did": "a", "collection": "x", "ingested_at": at("11:50:01")},
        {"did": "a", "collection": "y", "ingested_at": at("11:50:02")},
        {"did": "a", "collection": "x", "ingested_at": at("11:50:12")},
        {"did": "b", "collection": None, "ingested_at": at("11:50:12")},
    ]
    given = tables(rows, raw_events=raw)
    assert panels.panel_active_users(given, AS_OF, exact=True).first().active_users == 4
    assert panels.panel_active_users(given, AS_OF, exact=True, distinct=True).first().active_users == 2
    assert panels.panel_active_users(given, AS_OF, distinct=True).first().active_users == 2
    stats = marts.mart_firehose_stats(given, AS_OF, exact=True)
    assert stats.filter("collection IS NULL").first()["count"] == 1


def test_top_posts_need_both_sides_today(rows):
    posts = [{"did": "a", "time_us": 1, "event_time": at("10:00:00"), "text": "t"}, {"did": "b", "time_us": 2, "event_time": at("10:00:00")}]
    scores = [
        {"did": "a", "time_us": 1, "event_time": at("10:00:00"), "sentiment_positive": 0.9},
        {"did": "b", "time_us": 2, "event_time": at("00:00:00") - timedelta(seconds=1), "sentiment_positive": 0.8},
    ]
    given = tables(rows, core_posts=posts, core_post_sentiment=scores)
    assert [row.did for row in marts.mart_top_posts(given, AS_OF).collect()] == ["a"]
    assert panels.panel_top_posts_positive(given, AS_OF).first().sentiment_positive == 0.9


def test_top_posts_keep_copies_and_break_ties(rows):
    posts = [{"did": d, "time_us": 1, "rkey": "r", "event_time": at("10:00:00"), "text": f"{d}{n}"} for d in "abc" for n in range(2)]
    scores = [
        {"did": d, "time_us": 1, "event_time": at("10:00:00"), "sentiment_negative": v, "sentiment_label": "x"}
        for d, v in (("a", 0.1), ("b", 0.5), ("c", 0.5))
    ]
    given = tables(rows, core_posts=posts, core_post_sentiment=[*scores, scores[1]])
    top = panels.panel_top_posts_negative(given, AS_OF).collect()
    assert sorted(row.text for row in top)[:4] == ["b0", "b0", "b1", "b1"]
    assert len(top) == 5 and top[4].text in ("c0", "c1")


def test_top_posts_shuffle_no_text(spark, rows, tmp_path):
    for name in ("core_posts", "core_post_sentiment"):
        rows(name, {"event_time": at("10:00:00"), "text": "t"}).write.parquet(str(tmp_path / name))
    given = {name: spark.read.parquet(str(tmp_path / name)) for name in ("core_posts", "core_post_sentiment")}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = panels.panel_top_posts_positive(given, AS_OF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("text:string" in scan for scan in scans) == 1


def test_rates_divide_by_ten(rows):
    likes = [{"event_type": "like", "actor_did": "a", "event_time": at("11:30:05")}] * 3
    likes += [{"event_type": "repost", "actor_did": "a", "event_time": at("11:30:05")}]
    likes += [{"event_type": "like", "actor_did": "a", "event_time": at("10:30:05")}]
    given = tables(rows, core_engagement=likes)
    assert [row.events_per_second for row in panels.panel_likes_per_second(given, AS_OF).collect()] == [0.3]
    assert [row.events_per_second for row in panels.panel_reposts_per_second(given, AS_OF).collect()] == [0.1]
    assert marts.mart_engagement_velocity(given, AS_OF).count() == 3


def test_views_answer_plain_sql(spark, rows):
    given = tables(rows, core_posts=[{"event_time": at("11:59:00"), "content_type": "original"}])
    names = register_views(given, AS_OF)
    assert len([name for name in names if name.startswith("mart_")]) == 11
    assert len([name for name in names if name.startswith("panel_")]) == 17
    assert spark.sql("SELECT * FROM panel_content_breakdown").first().post_count == 1


def test_wall_clock_is_the_default(rows):
    assert panels.panel_total_events(tables(rows)).first().total_events == 0
