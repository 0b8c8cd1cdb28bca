"""Columns, partitioning and sort order of every lake table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, LONG, TIMESTAMP = T.StringType(), T.LongType(), T.TimestampType()
BOOLEAN, DOUBLE, STRINGS = T.BooleanType(), T.DoubleType(), T.ArrayType(T.StringType())

# Record types of the event protocol.
POST = "app.bsky.feed.post"
LIKE = "app.bsky.feed.like"
REPOST = "app.bsky.feed.repost"
FOLLOW = "app.bsky.graph.follow"
BLOCK = "app.bsky.graph.block"
PROFILE = "app.bsky.actor.profile"

# Event kinds and operations of the event protocol.
KINDS = ("commit", "identity", "account")
OPERATIONS = ("create", "update", "delete")


def _struct(required: dict[str, T.DataType], optional: dict[str, T.DataType]) -> list[T.StructField]:
    fields = [T.StructField(name, kind, False) for name, kind in required.items()]
    return fields + [T.StructField(name, kind, True) for name, kind in optional.items()]


_STAMP = {"ingested_at": TIMESTAMP}
_KEY = {"did": STRING, "time_us": LONG, "event_time": TIMESTAMP}
_COMMIT = {"rkey": STRING, "operation": STRING}


def _staged(**columns: T.DataType) -> T.StructType:
    return T.StructType(_struct(_KEY, {**_COMMIT, **columns}) + _struct(_STAMP, {}))


# The innermost folder of a table: which write a file came with.
BATCH = "batch"


@dataclass(frozen=True)
class TableSpec:
    """A table's columns, the timestamp its day partition comes from, and its sort."""

    name: str
    schema: T.StructType
    time_column: str
    extra_partitions: tuple[str, ...] = ()

    @property
    def date_column(self) -> str:
        return date_column(self.time_column)

    @property
    def partitions(self) -> tuple[str, ...]:
        return (self.date_column, *self.extra_partitions)

    @property
    def columns(self) -> list[str]:
        """What a reader sees: the table's columns, then the derived day."""
        return [*self.schema.names, self.date_column]

    @property
    def stored_partitions(self) -> tuple[str, ...]:
        """The folders on disk; the innermost tells writes apart."""
        return (*self.partitions, BATCH)

    @property
    def stored_schema(self) -> T.StructType:
        """The schema on disk: partition columns come last, in the order of the folders.

        A stream fixes its column order when it starts, maybe before the first folder is
        there, so the declared order has to be the one the folders will give.
        """
        data = [field for field in self.schema.fields if field.name not in self.extra_partitions]
        extra = [self.schema[name] for name in self.extra_partitions]
        folders = [T.StructField(self.date_column, T.DateType()), *extra, T.StructField(BATCH, STRING)]
        return T.StructType([*data, *folders])


def date_column(time_column: str) -> str:
    return time_column.removesuffix("_time").removesuffix("_at") + "_date"


RAW_EVENTS = TableSpec(
    "raw_events",
    T.StructType(
        _struct({"did": STRING, "time_us": LONG, "kind": STRING}, {"collection": STRING, "operation": STRING})
        + _struct({"raw_json": STRING, **_STAMP}, {})
    ),
    "ingested_at",
    ("collection",),
)

_TABLES = [
    RAW_EVENTS,
    TableSpec(
        "stg_posts",
        _staged(
            text=STRING, created_at=TIMESTAMP, langs=STRINGS, has_embed=BOOLEAN, embed_type=STRING,
            is_reply=BOOLEAN, reply_root_uri=STRING, reply_parent_uri=STRING, facets_json=STRING,
            labels_json=STRING, tags=STRINGS,
        ),
        "event_time",
    ),
    TableSpec(
        "stg_likes",
        _staged(subject_uri=STRING, subject_cid=STRING, created_at=TIMESTAMP, has_via=BOOLEAN),
        "event_time",
    ),
    TableSpec(
        "stg_reposts",
        _staged(subject_uri=STRING, subject_cid=STRING, created_at=TIMESTAMP),
        "event_time",
    ),
    TableSpec("stg_follows", _staged(subject_did=STRING, created_at=TIMESTAMP), "event_time"),
    TableSpec("stg_blocks", _staged(subject_did=STRING, created_at=TIMESTAMP), "event_time"),
    TableSpec("stg_profiles", _staged(display_name=STRING, description=STRING), "event_time"),
    TableSpec(
        "core_posts",
        T.StructType(
            _struct(
                _KEY,
                dict(
                    rkey=STRING, text=STRING, created_at=TIMESTAMP, primary_lang=STRING,
                    is_reply=BOOLEAN, has_embed=BOOLEAN, embed_type=STRING, content_type=STRING,
                    hashtags=STRINGS, mention_dids=STRINGS, link_urls=STRINGS,
                ),
            )
            + _struct(_STAMP, {})
        ),
        "event_time",
    ),
    TableSpec(
        "core_mentions",
        T.StructType(
            _struct({"author_did": STRING, "mentioned_did": STRING}, {"post_rkey": STRING})
            + _struct({"event_time": TIMESTAMP, **_STAMP}, {})
        ),
        "event_time",
    ),
    TableSpec(
        "core_hashtags",
        T.StructType(
            _struct({"tag": STRING, "author_did": STRING}, {"post_rkey": STRING})
            + _struct({"event_time": TIMESTAMP, **_STAMP}, {})
        ),
        "event_time",
    ),
    TableSpec(
        "core_engagement",
        T.StructType(
            _struct({"event_type": STRING, "actor_did": STRING}, {"subject_uri": STRING})
            + _struct({"event_time": TIMESTAMP, "time_us": LONG, **_STAMP}, {})
        ),
        "event_time",
    ),
    TableSpec(
        "core_post_sentiment",
        T.StructType(
            _struct(
                _KEY,
                dict(
                    rkey=STRING, text=STRING, sentiment_positive=DOUBLE, sentiment_negative=DOUBLE,
                    sentiment_neutral=DOUBLE, sentiment_label=STRING, sentiment_confidence=DOUBLE,
                ),
            )
            + _struct(_STAMP, {})
        ),
        "event_time",
    ),
]

# Lines that held no event; kept beside the raw table.
QUARANTINE = TableSpec("quarantine", T.StructType(_struct({"raw_json": STRING, **_STAMP}, {})), "ingested_at")

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _TABLES}

# Which staging table each record type lands in.
ROUTES: dict[str, str] = {
    POST: "stg_posts",
    LIKE: "stg_likes",
    REPOST: "stg_reposts",
    FOLLOW: "stg_follows",
    BLOCK: "stg_blocks",
    PROFILE: "stg_profiles",
}

CHECK_RESULTS = T.StructType(
    _struct({"ts": LONG, "check_name": STRING}, {"metric_key": STRING})
    + _struct({"status": STRING}, {"message": STRING, "value_num": DOUBLE, "value_str": STRING, "duration_ms": LONG})
)
HEALS = T.StructType(
    _struct({"ts": LONG, "target": STRING, "action": STRING}, {"reason": STRING, "outcome": STRING})
)
