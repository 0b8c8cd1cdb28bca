"""Landed event lines to the rows of the raw table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = (
    "did string, time_us bigint, kind string, "
    "commit struct<collection:string,operation:string>, _malformed string"
)

# Fixed value: how far before the last seen event a resumed reader starts again.
REPLAY_OVERLAP_US = 5_000_000


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited event files as one ``value`` column."""
    return spark.read.text(path)


def read_events_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """The landing zone as an unbounded stream; the limits bound each micro-batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path)


def parse_lines(lines: DataFrame, payload: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """Each line's ``envelope``, its text as ``raw_json``, and when it came in."""
    envelope = F.from_json(payload, ENVELOPE, {"columnNameOfCorruptRecord": "_malformed"})
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    row = F.struct(envelope.alias("envelope"), F.col(payload).alias("raw_json"), stamp.alias("ingested_at"))
    # One-row inline: a filter stays above it, so each line is parsed once.
    return lines.select(F.inline(F.array(row)))


def _is_malformed() -> Column:
    return F.col("raw_json").isNotNull() & (
        F.col("envelope").isNull() | F.col("envelope._malformed").isNotNull()
    )


def events_of(parsed: DataFrame) -> DataFrame:
    """The complete events among parsed lines."""
    events = parsed.filter(F.col("envelope._malformed").isNull()).select(
        "envelope.did",
        "envelope.time_us",
        "envelope.kind",
        "envelope.commit.collection",
        "envelope.commit.operation",
        "raw_json",
        "ingested_at",
    )
    return events.filter(
        (F.col("did") != "") & (F.col("time_us") != 0) & (F.col("kind") != "")
    )


def to_raw_events(lines: DataFrame, payload: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """Lift the envelope out of each line.

    A line that is not a JSON object, or whose did, time_us or kind is missing, empty or
    zero, gives no row.  Collection and operation are NULL for events without a commit.
    """
    return events_of(parse_lines(lines, payload, ingested_at))


def malformed_of(parsed: DataFrame) -> DataFrame:
    """The parsed lines that are no JSON object, with the time they came in."""
    return parsed.filter(_is_malformed()).select("raw_json", "ingested_at")


def quarantine(lines: DataFrame, payload: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """The lines ``to_raw_events`` could not read as JSON, with the time they came in."""
    return malformed_of(parse_lines(lines, payload, ingested_at))


def split_malformed(
    lines: DataFrame, payload: str = "value", ingested_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantined)``: together every line that held a complete or broken event."""
    return to_raw_events(lines, payload, ingested_at), quarantine(lines, payload, ingested_at)


def since_offset(events: DataFrame, start_us: int | Column) -> DataFrame:
    return events.filter(F.col("time_us") >= start_us)


def next_offset(events: DataFrame, start_us: int) -> DataFrame:
    """One row: where the next read starts; unchanged when nothing new came."""
    fresh = since_offset(events, start_us)
    return fresh.agg(
        F.coalesce(F.max("time_us") + F.lit(1), F.lit(start_us)).cast("bigint").alias("next_time_us"),
        F.count(F.lit(1)).alias("rows_read"),
    )


def replay_from(events: DataFrame, cursor_us: int, overlap_us: int = REPLAY_OVERLAP_US) -> DataFrame:
    """What a reader gets that resumes a little before its last seen event."""
    return since_offset(events, cursor_us - overlap_us)


def drop_replayed(events: DataFrame, keys: Sequence[str] = ("did", "time_us", "kind")) -> DataFrame:
    """One row per event identity.

    An aggregate, not a window: copies collapse before the shuffle, however many there are.
    """
    return events.dropDuplicates(list(keys))


def drop_replayed_stream(
    events: DataFrame, delay: str = "15 minutes", keys: Sequence[str] = ("did", "time_us", "kind")
) -> DataFrame:
    """The streaming form; state is kept for ``delay`` behind the newest event."""
    timed = events.withColumn("event_time", F.timestamp_micros("time_us"))
    unique = timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))
    return unique.drop("event_time")


def wanted_collections(events: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep events of the wanted record types; ``prefix.*`` takes a whole family.

    Events without a commit pass, as they carry no record type.  An empty list wants all.
    """
    if not wanted:
        return events
    keep = F.col("collection").isNull()
    exact = [name for name in wanted if not name.endswith(".*")]
    if exact:
        keep = keep | F.col("collection").isin(exact)
    for family in (name[:-1] for name in wanted if name.endswith(".*")):
        keep = keep | F.col("collection").startswith(family)
    return events.filter(keep)


def wanted_dids(events: DataFrame, dids: DataFrame) -> DataFrame:
    """Keep events of the listed accounts (a DataFrame with a ``did`` column)."""
    return events.join(dids.select("did"), "did", "left_semi")
