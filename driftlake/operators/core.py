"""Staged records to the core tables the dashboards read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions import records
from driftlake.schemas import TABLES


def _stamp(stamp: Column | None) -> Column:
    return (F.current_timestamp() if stamp is None else stamp).alias("ingested_at")


def _created(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("operation") == "create")


def _lowered(tags: Column) -> Column:
    return F.coalesce(F.transform(tags, F.lower), F.array().cast("array<string>"))


def with_facets(stg_posts: DataFrame, facets: str = "pattern") -> DataFrame:
    """Created posts with what their facets name as lists: ``_tags``, ``_mentions`` and ``_links``.

    The three tables made of posts share these, so a post's facets are read once for all.
    ``facets="typed"`` reads the facets as JSON, so it also finds features whose keys come
    in another order than the pattern expects.
    """
    facets_json = F.col("facets_json")
    return _created(stg_posts).select(
        "*",
        F.when(facets_json.contains("facet#tag"), records.facet_tags(facets_json, facets)).alias("_tags"),
        records.facet_mentions(facets_json, facets).alias("_mentions"),
        records.facet_links(facets_json, facets).alias("_links"),
    )


def posts_of(faceted: DataFrame, stamp: Column | None = None, char_count: bool = False) -> DataFrame:
    columns = {
        "primary_lang": records.primary_language(F.col("langs")),
        "content_type": records.content_kind(F.col("is_reply"), F.col("embed_type"), F.col("has_embed")),
        "hashtags": F.array_union(_lowered(F.col("_tags")), _lowered(F.col("tags"))),
        "mention_dids": F.col("_mentions"),
        "link_urls": F.col("_links"),
        "ingested_at": _stamp(stamp),
    }
    names = TABLES["core_posts"].schema.names
    made = [columns[name].alias(name) if name in columns else F.col(name) for name in names]
    if char_count:
        made.append(F.length("text").alias("char_count"))
    return faceted.select(*made)


def mentions_of(faceted: DataFrame, stamp: Column | None = None) -> DataFrame:
    mentioning = faceted.filter(F.col("facets_json").contains("facet#mention"))
    return mentioning.select(
        F.col("did").alias("author_did"),
        F.explode("_mentions").alias("mentioned_did"),
        F.col("rkey").alias("post_rkey"),
        "event_time",
        _stamp(stamp),
    )


def hashtags_of(faceted: DataFrame, stamp: Column | None = None) -> DataFrame:
    tagged = faceted.filter(F.col("facets_json").contains("facet#tag") | (F.size("tags") > 0))
    exploded = tagged.select(
        F.explode(F.concat(_lowered(F.col("_tags")), _lowered(F.col("tags")))).alias("tag"),
        F.col("did").alias("author_did"),
        F.col("rkey").alias("post_rkey"),
        "event_time",
        _stamp(stamp),
    )
    return exploded.filter(F.col("tag").isNotNull())


def core_posts(
    stg_posts: DataFrame, stamp: Column | None = None, facets: str = "pattern", char_count: bool = False
) -> DataFrame:
    """Created posts with language, content type and what their facets name.

    ``char_count`` adds the text's length.
    """
    return posts_of(with_facets(stg_posts, facets), stamp, char_count)


def core_mentions(stg_posts: DataFrame, stamp: Column | None = None, facets: str = "pattern") -> DataFrame:
    """One row per mention in a created post."""
    return mentions_of(with_facets(stg_posts, facets), stamp)


def core_hashtags(stg_posts: DataFrame, stamp: Column | None = None, facets: str = "pattern") -> DataFrame:
    """One row per tag of a created post; a tag that stands in both places gives two.

    Both sources of tags are read in one pass over the posts.
    """
    return hashtags_of(with_facets(stg_posts, facets), stamp)


def _engaged(staged: DataFrame, event_type: str, stamp: Column | None) -> DataFrame:
    return _created(staged).select(
        F.lit(event_type).alias("event_type"),
        F.col("did").alias("actor_did"),
        "subject_uri",
        "event_time",
        "time_us",
        _stamp(stamp),
    )


def core_engagement(stg_likes: DataFrame, stg_reposts: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Created likes and reposts in one table."""
    return _engaged(stg_likes, "like", stamp).unionByName(_engaged(stg_reposts, "repost", stamp))


POST_FAN_OUT: dict[str, Callable[..., DataFrame]] = {
    "core_posts": core_posts,
    "core_mentions": core_mentions,
    "core_hashtags": core_hashtags,
}

# The same three tables from posts whose facets are read already.
FACETED_FAN_OUT: dict[str, Callable[..., DataFrame]] = {
    "core_posts": posts_of,
    "core_mentions": mentions_of,
    "core_hashtags": hashtags_of,
}
