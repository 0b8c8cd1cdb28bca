"""Raw events to one typed table per record type.

``operation`` is the raw table's own column, so a filter on it reaches the scan instead
of parsing every document first; the record is parsed once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions import records
from driftlake.functions.clock import micros_to_timestamp
from driftlake.schemas import BLOCK, FOLLOW, LIKE, POST, PROFILE, REPOST, ROUTES, TABLES


def _stage(
    raw_events: DataFrame,
    collection: str,
    fields: str,
    columns: Callable[[Callable[[str], Column]], dict[str, Column]],
    stamp: Column | None,
) -> DataFrame:
    wanted = raw_events.filter(F.col("collection") == collection)
    document = F.from_json("raw_json", f"commit struct<rkey:string,record:struct<{fields}>>")
    parsed = wanted.select(
        "did",
        "time_us",
        micros_to_timestamp("time_us").alias("event_time"),
        "operation",
        document.alias("_document"),
        (F.current_timestamp() if stamp is None else stamp).alias("ingested_at"),
    )
    made = columns(lambda name: F.col(f"_document.commit.record.{name}"))
    made = {"rkey": F.col("_document.commit.rkey"), **made}
    spec = TABLES[ROUTES[collection]]
    return parsed.select(
        *[made[name].alias(name) if name in made else F.col(name) for name in spec.schema.names]
    )


def _member(json: Column, path: str) -> Column:
    return F.get_json_object(json, path)


def stg_posts(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    fields = (
        "text:string,createdAt:string,langs:array<string>,embed:string,reply:string,"
        "facets:string,labels:string,tags:array<string>"
    )

    def columns(record: Callable[[str], Column]) -> dict[str, Column]:
        return {
            "text": record("text"),
            "created_at": records.client_timestamp(record("createdAt")),
            "langs": record("langs"),
            "has_embed": record("embed").isNotNull(),
            "embed_type": records.embed_kind(_member(record("embed"), "$.$type")),
            "is_reply": record("reply").isNotNull(),
            "reply_root_uri": _member(record("reply"), "$.root.uri"),
            "reply_parent_uri": _member(record("reply"), "$.parent.uri"),
            "facets_json": record("facets"),
            "labels_json": record("labels"),
            "tags": record("tags"),
        }

    return _stage(raw_events, POST, fields, columns, stamp)


def _subject(record: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "subject_uri": _member(record("subject"), "$.uri"),
        "subject_cid": _member(record("subject"), "$.cid"),
        "created_at": records.client_timestamp(record("createdAt")),
    }


def stg_likes(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    def columns(record: Callable[[str], Column]) -> dict[str, Column]:
        return {**_subject(record), "has_via": record("via").isNotNull()}

    return _stage(raw_events, LIKE, "subject:string,createdAt:string,via:string", columns, stamp)


def stg_reposts(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    return _stage(raw_events, REPOST, "subject:string,createdAt:string", _subject, stamp)


def _edge(record: Callable[[str], Column]) -> dict[str, Column]:
    return {
        "subject_did": record("subject"),
        "created_at": records.client_timestamp(record("createdAt")),
    }


def stg_follows(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    return _stage(raw_events, FOLLOW, "subject:string,createdAt:string", _edge, stamp)


def stg_blocks(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    return _stage(raw_events, BLOCK, "subject:string,createdAt:string", _edge, stamp)


def stg_profiles(raw_events: DataFrame, stamp: Column | None = None) -> DataFrame:
    def columns(record: Callable[[str], Column]) -> dict[str, Column]:
        return {"display_name": record("displayName"), "description": record("description")}

    return _stage(raw_events, PROFILE, "displayName:string,description:string", columns, stamp)


STAGING: dict[str, Callable[..., DataFrame]] = {
    "stg_posts": stg_posts,
    "stg_likes": stg_likes,
    "stg_reposts": stg_reposts,
    "stg_follows": stg_follows,
    "stg_blocks": stg_blocks,
    "stg_profiles": stg_profiles,
}
