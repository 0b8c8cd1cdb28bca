"""Pieces of the JSON records: embeds, client dates, facets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Embed kinds in the order they are tried; the first name found in the
# embed's type wins, so the longer record name stands before the shorter one.
EMBED_KINDS = ("images", "video", "external", "recordWithMedia", "record")

# Patterns of the default facet reading.
TAG_PATTERN = r'"\$type"\s*:\s*"app\.bsky\.richtext\.facet#tag"\s*,\s*"tag"\s*:\s*"([^"]+)"'
MENTION_PATTERN = r'"\$type"\s*:\s*"app\.bsky\.richtext\.facet#mention"\s*,\s*"did"\s*:\s*"(did:[^"]+)"'
LINK_PATTERN = r'"\$type"\s*:\s*"app\.bsky\.richtext\.facet#link"\s*,\s*"uri"\s*:\s*"([^"]+)"'

# Feature types of a facet.
TAG_FEATURE = "app.bsky.richtext.facet#tag"
MENTION_FEATURE = "app.bsky.richtext.facet#mention"
LINK_FEATURE = "app.bsky.richtext.facet#link"

FACETS_SCHEMA = (
    "array<struct<index:struct<byteStart:int,byteEnd:int>,"
    "features:array<struct<`$type`:string,tag:string,did:string,uri:string>>>>"
)


def embed_kind(type_name: Column) -> Column:
    """Classify an embed by its type name; unknown types give NULL."""
    return F.coalesce(*[F.when(type_name.contains(kind), F.lit(kind)) for kind in EMBED_KINDS])


def client_timestamp(text: Column) -> Column:
    """A date written by a client; what is not a date becomes NULL, it fails no batch."""
    return text.try_cast("timestamp")


def primary_language(langs: Column) -> Column:
    return F.coalesce(F.get(langs, F.lit(0)), F.lit("unknown"))


def content_kind(is_reply: Column, embed_type: Column, has_embed: Column) -> Column:
    return (
        F.when(is_reply, "reply")
        .when(embed_type == "record", "quote")
        .when(has_embed, "media_post")
        .otherwise("original")
    )


def _matches(facets_json: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(facets_json, F.lit(pattern), F.lit(1))
    return F.coalesce(found, F.array().cast("array<string>"))


def typed_features(facets_json: Column) -> Column:
    """All features of all facets as ``(byteStart, byteEnd, $type, tag, did, uri)``."""
    facets = F.from_json(facets_json, FACETS_SCHEMA)
    spread = F.transform(
        facets,
        lambda facet: F.transform(
            facet["features"],
            lambda feature: F.struct(
                facet["index"]["byteStart"].alias("byte_start"),
                facet["index"]["byteEnd"].alias("byte_end"),
                feature["$type"].alias("feature_type"),
                feature["tag"].alias("tag"),
                feature["did"].alias("did"),
                feature["uri"].alias("uri"),
            ),
        ),
    )
    return F.flatten(F.filter(spread, lambda features: features.isNotNull()))


def _typed(facets_json: Column, feature_type: str, field: str) -> Column:
    wanted = F.filter(
        typed_features(facets_json),
        lambda feature: (feature["feature_type"] == feature_type) & feature[field].isNotNull(),
    )
    values = F.transform(wanted, lambda feature: feature[field])
    return F.coalesce(values, F.array().cast("array<string>"))


def facet_tags(facets_json: Column, facets: str = "pattern") -> Column:
    if facets == "typed":
        return _typed(facets_json, TAG_FEATURE, "tag")
    return _matches(facets_json, TAG_PATTERN)


def facet_mentions(facets_json: Column, facets: str = "pattern") -> Column:
    if facets == "typed":
        return F.filter(_typed(facets_json, MENTION_FEATURE, "did"), lambda did: did.startswith("did:"))
    return _matches(facets_json, MENTION_PATTERN)


def facet_links(facets_json: Column, facets: str = "pattern") -> Column:
    if facets == "typed":
        return _typed(facets_json, LINK_FEATURE, "uri")
    return _matches(facets_json, LINK_PATTERN)
