"""Base marts: counts per time bucket over the lake tables.

Each takes the tables (a mapping from name to DataFrame), the clock, and ``since``, a lower
bound a panel can pass so that only the needed days are scanned.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions.clock import Clock, ago, bucket_start, clock, day_start, time_range

Tables = Mapping[str, DataFrame]


def _per_minute(
    df: DataFrame, time_column: str, keys: list[str], since: Column | None
) -> DataFrame:
    rows = time_range(df, time_column, since)
    return rows.groupBy(F.date_trunc("minute", time_column).alias("bucket_min"), *keys).agg(
        F.count(F.lit(1)).alias("count")
    )


def _later_of(own: Column, since: Column | None) -> Column:
    return own if since is None else F.greatest(own, since)


def mart_events_per_second(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["raw_events"], "ingested_at", [], since)


def mart_trending_hashtags(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["core_hashtags"], "event_time", ["tag"], since)


def mart_most_mentioned(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["core_mentions"], "event_time", ["mentioned_did"], since)


def mart_language_distribution(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["core_posts"], "event_time", ["primary_lang"], since)


def mart_content_breakdown(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["core_posts"], "event_time", ["content_type"], since)


def mart_embed_usage(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    return _per_minute(tables["core_posts"], "event_time", ["embed_type"], since)


def mart_sentiment_timeseries(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    start = _later_of(day_start(as_of), since)
    return _per_minute(tables["core_post_sentiment"], "event_time", ["sentiment_label"], start)


def mart_engagement_velocity(tables: Tables, as_of: Clock = None, since: Column | None = None) -> DataFrame:
    """Likes and reposts per ten seconds over the last two hours."""
    start = _later_of(ago(as_of, hours=2), since)
    rows = time_range(tables["core_engagement"], "event_time", start)
    return rows.groupBy(bucket_start("event_time", 10).alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("count")
    )


def mart_firehose_stats(
    tables: Tables, as_of: Clock = None, since: Column | None = None, exact: bool = False
) -> DataFrame:
    """Events and accounts per ten seconds and record type over the last two hours."""
    start = _later_of(ago(as_of, hours=2), since)
    rows = time_range(tables["raw_events"], "ingested_at", start)
    accounts = F.count_distinct("did") if exact else F.approx_count_distinct("did")
    return rows.groupBy(bucket_start("ingested_at", 10).alias("bucket"), "collection").agg(
        F.count(F.lit(1)).alias("count"), accounts.alias("unique_dids_approx")
    )


def mart_top_posts(tables: Tables, as_of: Clock = None) -> DataFrame:
    """Today's posts with their scores."""
    start = day_start(as_of)
    posts = time_range(tables["core_posts"], "event_time", start).select(
        F.date_trunc("minute", "event_time").alias("bucket_min"),
        "did", "time_us", "rkey", "text", "primary_lang", "content_type",
    )
    scores = time_range(tables["core_post_sentiment"], "event_time", start).select(
        "did", "time_us", "sentiment_positive", "sentiment_negative", "sentiment_neutral",
        "sentiment_label", "sentiment_confidence",
    )
    return posts.join(scores, ["did", "time_us"]).select(
        "bucket_min", "did", "time_us", "rkey", "text", "primary_lang", "content_type",
        "sentiment_positive", "sentiment_negative", "sentiment_neutral",
        "sentiment_label", "sentiment_confidence",
    )


def mart_pipeline_health(tables: Tables, as_of: Clock = None) -> DataFrame:
    """One row on the last minute, also when nothing came in."""
    now = clock(as_of)
    recent = time_range(tables["raw_events"], "ingested_at", ago(as_of, minutes=1))
    totals = recent.agg(
        F.count(F.lit(1)).alias("events_last_minute"),
        F.max("ingested_at").alias("last_event_ingested"),
        F.max("time_us").alias("_newest_us"),
    )
    lag = F.unix_timestamp(now) - F.unix_timestamp("last_event_ingested")
    return totals.select(
        now.alias("measured_at"),
        "events_last_minute",
        (F.col("events_last_minute") / F.lit(60.0)).alias("events_per_second"),
        "last_event_ingested",
        lag.cast("double").alias("processing_lag_seconds"),
        F.timestamp_micros("_newest_us").alias("max_event_time"),
    )


MARTS: dict[str, Callable[..., DataFrame]] = {
    "mart_events_per_second": mart_events_per_second,
    "mart_engagement_velocity": mart_engagement_velocity,
    "mart_sentiment_timeseries": mart_sentiment_timeseries,
    "mart_trending_hashtags": mart_trending_hashtags,
    "mart_most_mentioned": mart_most_mentioned,
    "mart_language_distribution": mart_language_distribution,
    "mart_content_breakdown": mart_content_breakdown,
    "mart_embed_usage": mart_embed_usage,
    "mart_firehose_stats": mart_firehose_stats,
    "mart_top_posts": mart_top_posts,
    "mart_pipeline_health": mart_pipeline_health,
}
