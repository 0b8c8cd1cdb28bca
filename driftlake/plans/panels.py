"""Dashboard panels.

A panel filters on bucket starts, as the dashboards always did, so its oldest, partly
covered bucket is left out.  The same bound also goes to the rows below, where it prunes
the scan: a bucket that starts in the window holds only rows in the window.

Panels that add a mart's buckets up again count the rows of those buckets directly, which
gives the same numbers with one shuffle less.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions.clock import Clock, ago, bucket_start, clock, day_start, time_range
from driftlake.plans import marts
from driftlake.plans.marts import Tables


def _newest(mart: DataFrame, bucket: str, since: Column) -> DataFrame:
    return mart.filter(F.col(bucket) >= since)


def _in_minutes(table: DataFrame, since: Column) -> DataFrame:
    """Rows of the minutes that start in the window."""
    return time_range(table, "event_time", since).filter(F.date_trunc("minute", "event_time") >= since)


def _in_ten_seconds(table: DataFrame, since: Column) -> DataFrame:
    """Rows of the ten-second buckets that start in the window."""
    return time_range(table, "ingested_at", since).filter(bucket_start("ingested_at", 10) >= since)


# -- sentiment -----------------------------------------------------------------------
def panel_sentiment_timeseries(tables: Tables, as_of: Clock = None) -> DataFrame:
    today = time_range(tables["core_post_sentiment"], "event_time", day_start(as_of))
    return (
        today.groupBy(F.date_trunc("minute", "event_time").alias("window_start"))
        .agg(
            F.avg("sentiment_positive").alias("avg_positive"),
            F.avg("sentiment_negative").alias("avg_negative"),
            F.avg("sentiment_neutral").alias("avg_neutral"),
            F.count(F.lit(1)).alias("post_count"),
        )
        .orderBy("window_start")
    )


def panel_current_sentiment(tables: Tables, as_of: Clock = None) -> DataFrame:
    """Today's most frequent label."""
    today = time_range(tables["core_post_sentiment"], "event_time", day_start(as_of))
    counted = today.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("post_count"))
    return counted.orderBy(F.desc("post_count"), "sentiment_label").limit(1)


def _top_posts(tables: Tables, as_of: Clock, score: str) -> DataFrame:
    """Today's five highest posts.

    The ranking joins keys and scores only; texts are read for the at most five keys it
    leaves, so no text is shuffled.  Copies of a key stay copies, as the winners are joined
    and ranked again in full.
    """
    key = ["did", "time_us"]
    order = [F.desc(score), *key, "rkey"]

    def ranked(from_tables: Tables) -> DataFrame:
        posts = _newest(marts.mart_top_posts(from_tables, as_of), "bucket_min", day_start(as_of))
        return posts.orderBy(*order).limit(5)

    winners = ranked(tables).select(*key).distinct()
    # Over day partitions the first of their times becomes a scalar in the second scan's
    # pushed filters, and its day prunes partitions.
    first = winners.agg(F.min("time_us")).scalar()

    def cut(table: DataFrame) -> DataFrame:
        if "event_date" in table.columns:
            day = F.to_date(F.timestamp_micros(first))
            table = table.filter((F.col("time_us") >= first) & (F.col("event_date") >= day))
        return table.join(F.broadcast(winners), key, "left_semi")

    only_winners = {name: cut(tables[name]) for name in ("core_posts", "core_post_sentiment")}
    return ranked(only_winners).select("text", score, "sentiment_label", "primary_lang", "content_type")


def panel_top_posts_positive(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _top_posts(tables, as_of, "sentiment_positive")


def panel_top_posts_negative(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _top_posts(tables, as_of, "sentiment_negative")


# -- rates ---------------------------------------------------------------------------
def panel_events_per_second_by_collection(tables: Tables, as_of: Clock = None) -> DataFrame:
    since = ago(as_of, minutes=60)
    # Only the counts are read, so the distinct accounts of the mart are not computed.
    stats = _newest(marts.mart_firehose_stats(tables, as_of, since), "bucket", since)
    return stats.select(
        F.col("bucket").alias("window_start"),
        "collection",
        (F.col("count") / F.lit(10.0)).alias("events_per_second"),
    ).orderBy("window_start")


def panel_operations_breakdown(tables: Tables, as_of: Clock = None) -> DataFrame:
    recent = time_range(tables["raw_events"], "ingested_at", ago(as_of, minutes=60))
    return (
        recent.groupBy(bucket_start("ingested_at", 10).alias("window_start"), "operation")
        .agg(F.count(F.lit(1)).alias("op_count"))
        .orderBy("window_start")
    )


def _engagement_rate(tables: Tables, as_of: Clock, event_type: str) -> DataFrame:
    since = ago(as_of, minutes=60)
    velocity = _newest(marts.mart_engagement_velocity(tables, as_of, since), "bucket", since)
    return (
        velocity.filter(F.col("event_type") == event_type)
        .select(
            F.col("bucket").alias("window_start"),
            (F.col("count") / F.lit(10.0)).alias("events_per_second"),
        )
        .orderBy("window_start")
    )


def panel_likes_per_second(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _engagement_rate(tables, as_of, "like")


def panel_reposts_per_second(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _engagement_rate(tables, as_of, "repost")


def panel_follows_per_second(tables: Tables, as_of: Clock = None) -> DataFrame:
    created = time_range(tables["stg_follows"], "event_time", ago(as_of, minutes=60)).filter(
        F.col("operation") == "create"
    )
    return (
        created.groupBy(bucket_start("event_time", 10).alias("window_start"))
        .agg((F.count(F.lit(1)) / F.lit(10.0)).alias("events_per_second"))
        .orderBy("window_start")
    )


# -- totals --------------------------------------------------------------------------
def panel_active_users(
    tables: Tables, as_of: Clock = None, exact: bool = False, distinct: bool = False
) -> DataFrame:
    """Accounts active in the last 15 minutes.

    The default adds up the buckets' distinct accounts, so an account counts once per
    bucket and record type.  ``distinct=True`` counts each account once, from sketches
    merged over the buckets (``exact`` then counts without sketches).
    """
    since = ago(as_of, minutes=15)
    if not distinct:
        stats = _newest(marts.mart_firehose_stats(tables, as_of, since, exact), "bucket", since)
        return stats.agg(F.coalesce(F.sum("unique_dids_approx"), F.lit(0)).alias("active_users"))
    inside = _in_ten_seconds(tables["raw_events"], since)
    if exact:
        return inside.agg(F.count_distinct("did").alias("active_users"))
    sketches = inside.groupBy(bucket_start("ingested_at", 10).alias("bucket")).agg(
        F.hll_sketch_agg("did").alias("sketch")
    )
    merged = sketches.agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("active_users"))


def panel_total_events(tables: Tables, as_of: Clock = None) -> DataFrame:
    recent = _in_ten_seconds(tables["raw_events"], ago(as_of, minutes=15))
    return recent.agg(F.count(F.lit(1)).alias("total_events"))


# -- mixes ---------------------------------------------------------------------------
def _mix(table: DataFrame, as_of: Clock, key: str, name: str) -> DataFrame:
    return (
        _in_minutes(table, ago(as_of, minutes=15))
        .groupBy(F.coalesce(key, F.lit("unknown")).alias(name))
        .agg(F.count(F.lit(1)).alias("post_count"))
        .orderBy(F.desc("post_count"), name)
    )


def panel_language_distribution(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _mix(tables["core_posts"], as_of, "primary_lang", "primary_lang").limit(10)


def panel_content_breakdown(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _mix(tables["core_posts"], as_of, "content_type", "content_type")


def panel_embed_usage(tables: Tables, as_of: Clock = None) -> DataFrame:
    return _mix(tables["core_posts"], as_of, "embed_type", "embed_category")


def panel_most_mentioned(tables: Tables, as_of: Clock = None) -> DataFrame:
    return (
        _in_minutes(tables["core_mentions"], ago(as_of, minutes=15))
        .groupBy("mentioned_did")
        .agg(F.count(F.lit(1)).alias("mention_count"))
        .orderBy(F.desc("mention_count"), "mentioned_did")
        .limit(20)
    )


def panel_trending_hashtags(tables: Tables, as_of: Clock = None) -> DataFrame:
    """Tags of the last five minutes against their average earlier five-minute window.

    One pass and one shuffle: per tag the uses on either side, and the earlier windows that
    hold it as bits of a mask.  Windows without the tag do not enter its average.
    """
    since, turn = ago(as_of, minutes=30), ago(as_of, minutes=5)
    used = _in_minutes(tables["core_hashtags"], since)
    is_current = F.date_trunc("minute", "event_time") >= turn
    elapsed = F.unix_micros(bucket_start("event_time", 300)) - F.unix_micros(bucket_start(since, 300))
    window_bit = F.expr("shiftleft(1L, window_number)")
    numbered = used.select(
        "tag", is_current.alias("is_current"), (elapsed / F.lit(300_000_000)).cast("int").alias("window_number")
    )
    sides = numbered.groupBy("tag").agg(
        F.count_if("is_current").alias("current_count"),
        F.count_if(~F.col("is_current")).alias("earlier_count"),
        F.bit_count(F.bit_or(F.when(~F.col("is_current"), window_bit))).alias("earlier_windows"),
    )
    baseline = F.try_divide(F.col("earlier_count").cast("double"), F.col("earlier_windows").cast("double"))
    return (
        sides.filter(F.col("current_count") >= 5)
        .select(
            clock(as_of).alias("computed_at"),
            "tag",
            "current_count",
            F.coalesce(baseline, F.lit(0.0)).alias("baseline_count"),
            (F.col("current_count") / baseline).alias("spike_ratio"),
        )
        .orderBy(F.desc_nulls_last("spike_ratio"), "tag")
        .limit(50)
    )


def panel_pipeline_health(tables: Tables, as_of: Clock = None) -> DataFrame:
    return marts.mart_pipeline_health(tables, as_of)


PANELS: dict[str, Callable[..., DataFrame]] = {
    "panel_sentiment_timeseries": panel_sentiment_timeseries,
    "panel_current_sentiment": panel_current_sentiment,
    "panel_top_posts_positive": panel_top_posts_positive,
    "panel_top_posts_negative": panel_top_posts_negative,
    "panel_events_per_second_by_collection": panel_events_per_second_by_collection,
    "panel_operations_breakdown": panel_operations_breakdown,
    "panel_active_users": panel_active_users,
    "panel_total_events": panel_total_events,
    "panel_language_distribution": panel_language_distribution,
    "panel_content_breakdown": panel_content_breakdown,
    "panel_embed_usage": panel_embed_usage,
    "panel_trending_hashtags": panel_trending_hashtags,
    "panel_likes_per_second": panel_likes_per_second,
    "panel_reposts_per_second": panel_reposts_per_second,
    "panel_follows_per_second": panel_follows_per_second,
    "panel_most_mentioned": panel_most_mentioned,
    "panel_pipeline_health": panel_pipeline_health,
}
