"""Marts kept as streams: tumbling windows, late events up to 15 minutes.

A window is written once, when the watermark has passed it; nothing is ranked or cut at
write time.  Windows are a minute long, or ten seconds where the batch mart's are.

Two marts need more than a count.  ``firehose_stats`` keeps a mergeable sketch of the
accounts of each ten seconds as its state and stores it, so that distinct accounts over any
stretch are read from stored buckets (``stored_firehose_stats``, ``stored_active_users``).
``top_posts`` joins two streams, posts and their scores.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.functions.clock import Clock, ago

WATERMARK = "15 minutes"
WINDOW = "1 minute"
SHORT_WINDOW = "10 seconds"


def _windows(events: DataFrame, time_column: str, keys: list[str], watermark: str, window: str):
    timed = events.withWatermark(time_column, watermark)
    return timed.groupBy(F.window(time_column, window).alias("_window"), *keys)


def windowed_counts(
    events: DataFrame,
    time_column: str,
    keys: list[str],
    watermark: str = WATERMARK,
    window: str = WINDOW,
    name: str = "bucket_min",
) -> DataFrame:
    """Counts per tumbling window and keys, in append mode once a window is closed."""
    counted = _windows(events, time_column, keys, watermark, window).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(F.col("_window.start").alias(name), *keys, "count")


def firehose_stats(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Events, and a sketch of their accounts, per ten seconds and record type."""
    counted = _windows(events, "ingested_at", ["collection"], watermark, SHORT_WINDOW).agg(
        F.count(F.lit(1)).alias("count"), F.hll_sketch_agg("did").alias("dids")
    )
    return counted.select(F.col("_window.start").alias("bucket"), "collection", "count", "dids")


def stored_firehose_stats(stored: DataFrame) -> DataFrame:
    """The firehose mart from stored buckets."""
    return stored.select("bucket", "collection", "count", F.hll_sketch_estimate("dids").alias("unique_dids_approx"))


def stored_active_users(stored: DataFrame, as_of: Clock = None, minutes: int = 15) -> DataFrame:
    """Accounts active in the last minutes, each counted once: merged sketches, no event is read."""
    recent = stored.filter(F.col("bucket") >= ago(as_of, minutes=minutes))
    merged = recent.agg(F.hll_union_agg("dids").alias("dids"))
    return merged.select(F.coalesce(F.hll_sketch_estimate("dids"), F.lit(0)).alias("active_users"))


def top_posts(posts: DataFrame, scores: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Posts with their scores as both arrive, whichever comes first.

    A post and its score carry one event time, which is part of the join key: a row waits
    for its partner until the watermark passes that time and is dropped from state then, so
    state holds the rows of one watermark's length, not the table's.
    """
    posts = posts.select("did", "time_us", "event_time", "rkey", "text", "primary_lang", "content_type")
    scores = scores.select(
        "did", "time_us", "event_time", "sentiment_positive", "sentiment_negative", "sentiment_neutral",
        "sentiment_label", "sentiment_confidence",
    )
    joined = posts.withWatermark("event_time", watermark).join(
        scores.withWatermark("event_time", watermark), ["did", "time_us", "event_time"]
    )
    return joined.select(
        F.date_trunc("minute", "event_time").alias("bucket_min"), "did", "time_us", "rkey", "text", "primary_lang",
        "content_type", "sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_label",
        "sentiment_confidence",
    )


def _mart(time_column: str, *keys: str, window: str = WINDOW, name: str = "bucket_min") -> Callable[..., DataFrame]:
    def build(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
        return windowed_counts(events, time_column, list(keys), watermark, window, name)

    return build


# Mart name -> (input table, stream transform).
STREAM_MARTS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "mart_events_per_second": ("raw_events", _mart("ingested_at")),
    "mart_engagement_velocity": (
        "core_engagement", _mart("event_time", "event_type", window=SHORT_WINDOW, name="bucket"),
    ),
    "mart_sentiment_timeseries": ("core_post_sentiment", _mart("event_time", "sentiment_label")),
    "mart_trending_hashtags": ("core_hashtags", _mart("event_time", "tag")),
    "mart_most_mentioned": ("core_mentions", _mart("event_time", "mentioned_did")),
    "mart_language_distribution": ("core_posts", _mart("event_time", "primary_lang")),
    "mart_content_breakdown": ("core_posts", _mart("event_time", "content_type")),
    "mart_embed_usage": ("core_posts", _mart("event_time", "embed_type")),
    "mart_firehose_stats": ("raw_events", firehose_stats),
}


def write_mart(name: str, rows: DataFrame, path: str, checkpoint: str, **trigger: object):
    """Write a streamed mart as parquet files."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(f"stream_{name}")
        .trigger(**trigger)
        .start()
    )


def start_mart(
    name: str, events: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK, **trigger: object
):
    """Start the stream of one mart over its input table."""
    _, build = STREAM_MARTS[name]
    return write_mart(name, build(events, watermark), path, checkpoint, **trigger)


def start_top_posts(
    posts: DataFrame, scores: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK, **trigger: object
):
    """Start the stream of posts joined with their scores."""
    return write_mart("mart_top_posts", top_posts(posts, scores, watermark), path, checkpoint, **trigger)
