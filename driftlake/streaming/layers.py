"""Raw, staging, core and sentiment layers as streams between lake tables.

One query reads an input; what it makes may go to several tables.  Landed lines are parsed
once, for events and for what is no event; posts are read once, with their facets, for the
three tables made of them.  A micro-batch that runs again after a restart from the
checkpoint overwrites its first run's folders, so it appears exactly once.  (A stream that
has read a batch whose writer then breaks off within it reads that batch again.)  A staging query reads only its record
type's partition of the raw table.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from driftlake.functions.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS
from driftlake.operators import core, sentiment, staging
from driftlake.schemas import LIKE, QUARANTINE, RAW_EVENTS, REPOST, ROUTES, TABLES, TableSpec
from driftlake.sources.events import events_of, malformed_of, parse_lines, read_events_stream, wanted_dids
from driftlake.sources.lake import COMPRESSION, Lake

# Fixed value: how often each layer looks for new input.
TRIGGER = "5 seconds"

# Rows a file of a scoring round may hold, and files a device takes in a round.
ROUND_ROWS = 5_000
ROUND_FILES = 16


@dataclass(frozen=True)
class LayerConfig:
    """Where a run reads and writes, and how much it takes at once."""

    landing: str
    lake_root: str
    checkpoints: str
    trigger: str = TRIGGER
    available_now: bool = False
    max_files: int | None = None
    max_bytes: str | None = None
    # At most this many files per partition and micro-batch; None writes one per input task.
    write_tasks: int | None = None
    lexicon: tuple[tuple[str, ...], tuple[str, ...]] = (POSITIVE_WORDS, NEGATIVE_WORDS)

    def trigger_options(self) -> dict[str, object]:
        return {"availableNow": True} if self.available_now else {"processingTime": self.trigger}


def _writer(batch: DataFrame) -> str:
    """The stream a micro-batch is of; the same after a restart from its checkpoint."""
    return (batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0" * 8)[:8]


def _start(
    df: DataFrame, name: str, checkpoint: str, write: Callable[[DataFrame, int], None], trigger: dict[str, object]
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(f"to_{name}")
        .trigger(**trigger)
        .start()
    )


def append_stream(df: DataFrame, spec: TableSpec, lake: Lake, config: LayerConfig) -> StreamingQuery:
    """Append a stream to a lake table, in its day partitions."""
    lake.ensure_table(spec)
    return _start(
        df,
        spec.name,
        os.path.join(config.checkpoints, spec.name),
        lambda batch, batch_id: lake.write_batch(spec, batch, _writer(batch), batch_id, config.write_tasks),
        config.trigger_options(),
    )


def write_all(
    lake: Lake, batch: DataFrame, batch_id: int, targets: Mapping[TableSpec, Callable[[DataFrame], DataFrame]],
    writer: str | None = None, files_per_day: int | None = None, keep: bool = True,
) -> None:
    """One micro-batch to several tables, for ``foreachBatch``.

    With ``keep`` the batch is kept for the writes, so what it is made by runs once; no counts or
    emptiness checks run it again.  Each table gets it under its number, so running again leaves no
    duplicates in any of them.
    """
    if keep:
        batch.persist()
    try:
        for spec, build in targets.items():
            lake.write_batch(spec, build(batch), writer or _writer(batch), batch_id, files_per_day)
    finally:
        if keep:
            batch.unpersist()


def start_raw(spark: SparkSession, config: LayerConfig, ingested_at: Column | None = None) -> list[StreamingQuery]:
    """Landed lines to the raw table, and those that are no event to the quarantine, from one parse."""
    lake = Lake(spark, config.lake_root)
    lines = read_events_stream(spark, config.landing, config.max_files, config.max_bytes)
    targets = {RAW_EVENTS: events_of, QUARANTINE: malformed_of}
    for spec in targets:
        lake.ensure_table(spec)
    # Stamped in the stream, where a batch that runs again has its first run's clock.
    parsed = parse_lines(lines, ingested_at=ingested_at)
    return [
        _start(
            parsed,
            RAW_EVENTS.name,
            os.path.join(config.checkpoints, RAW_EVENTS.name),
            lambda batch, batch_id: write_all(lake, batch, batch_id, targets, files_per_day=config.write_tasks),
            config.trigger_options(),
        )
    ]


def _input(lake: Lake, name: str, config: LayerConfig) -> DataFrame:
    return lake.stream(name, config.max_files, config.max_bytes)


def start_staging(spark: SparkSession, config: LayerConfig) -> list[StreamingQuery]:
    """Six queries, one per record type."""
    lake = Lake(spark, config.lake_root)
    return [
        append_stream(staging.STAGING[name](_input(lake, "raw_events", config)), TABLES[name], lake, config)
        for name in ROUTES.values()
    ]


def start_core(spark: SparkSession, config: LayerConfig) -> list[StreamingQuery]:
    """Posts fan out to three tables from one query; likes and reposts join in one table."""
    lake = Lake(spark, config.lake_root)
    targets = {TABLES[name]: build for name, build in core.FACETED_FAN_OUT.items()}
    for spec in targets:
        lake.ensure_table(spec)
    posts = _start(
        core.with_facets(_input(lake, "stg_posts", config)),
        "core_posts",
        os.path.join(config.checkpoints, "core_posts"),
        lambda batch, batch_id: write_all(lake, batch, batch_id, targets, files_per_day=config.write_tasks),
        config.trigger_options(),
    )
    engagement = core.core_engagement(
        _input(lake, ROUTES[LIKE], config), _input(lake, ROUTES[REPOST], config)
    )
    return [posts, append_stream(engagement, TABLES["core_engagement"], lake, config)]


def start_sentiment(
    spark: SparkSession, config: LayerConfig, scorer: Callable[[DataFrame], DataFrame] | None = None
) -> list[StreamingQuery]:
    """Score new posts; ``scorer`` replaces the lexicon, e.g. by ``score_with_model``."""
    lake = Lake(spark, config.lake_root)
    posts = _input(lake, "core_posts", config)
    if scorer is None:
        positive, negative = config.lexicon
        scored = sentiment.score_posts(posts, positive=positive, negative=negative)
    else:
        scored = scorer(posts)
    return [append_stream(scored, TABLES["core_post_sentiment"], lake, config)]


def start_rounds(
    posts: DataFrame, scorer: Callable[[DataFrame], DataFrame], devices: int, root: str,
    rows: int = ROUND_ROWS, files: int = ROUND_FILES,
) -> StreamingQuery:
    """Score a whole table on few devices in rounds, which are as large however large the table is.

    The posts are made by as many tasks as their plan has, and written with at most ``rows`` rows a
    file.  A round is a micro-batch of ``files`` files a device; ``scorer`` narrows it to as many
    tasks as there are devices, e.g. by ``score_with_model(partitions=devices)``.  What it gives is
    written to ``root/scored``, round by round.
    """
    posts.write.option("maxRecordsPerFile", rows).parquet(f"{root}/posts", compression=COMPRESSION)
    rounds = posts.sparkSession.readStream.schema(posts.schema).option("maxFilesPerTrigger", devices * files)
    return (
        scorer(rounds.parquet(f"{root}/posts"))
        .writeStream.format("parquet")
        .option("path", f"{root}/scored")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


LAYERS: dict[str, Callable[[SparkSession, LayerConfig], list[StreamingQuery]]] = {
    "raw": start_raw,
    "staging": start_staging,
    "core": start_core,
    "sentiment": start_sentiment,
}


def run_layers(spark: SparkSession, config: LayerConfig) -> list[StreamingQuery]:
    """Start every layer.

    With ``available_now`` each layer is drained before the next starts, so one call takes
    what has landed all the way through.  Otherwise all layers run side by side; block on
    them with ``spark.streams.awaitAnyTermination()``.
    """
    started: list[StreamingQuery] = []
    if not config.available_now:
        # A stream cannot be read before its table exists.
        Lake(spark, config.lake_root).ensure_all()
    for start in LAYERS.values():
        queries = start(spark, config)
        if config.available_now:
            for query in queries:
                query.awaitTermination()
        started.extend(queries)
    return started


def start_listed(
    events: DataFrame, lake: Lake, spec: TableSpec, dids: Callable[[], DataFrame], checkpoint: str, **trigger: object
) -> StreamingQuery:
    """Append the events of listed accounts to a table; the list is read anew for every micro-batch.

    ``dids`` gives the list as it is then (a DataFrame with a ``did`` column), so an account that is added between
    two batches counts from the next one on.
    """
    lake.ensure_table(spec)
    return _start(
        events,
        f"listed_{spec.name}",
        checkpoint,
        lambda batch, batch_id: lake.write_batch(spec, wanted_dids(batch, dids()), _writer(batch), batch_id),
        trigger,
    )


def route_batch(lake: Lake, batch: DataFrame, batch_id: int, writer: str | None = None) -> None:
    """One raw micro-batch to all staging tables, for ``foreachBatch``.

    Every table scans the batch's files: nothing is made before, and kept rows would be several
    times as large as their files, in tasks as much larger.
    """
    targets = {TABLES[name]: build for name, build in staging.STAGING.items()}
    write_all(lake, batch, batch_id, targets, writer, keep=False)


def start_router(
    spark: SparkSession, raw_events: DataFrame, lake: Lake, checkpoint: str, **trigger: object
) -> StreamingQuery:
    """All staging tables from one query, reading the raw stream once."""
    for name in staging.STAGING:
        lake.ensure_table(TABLES[name])
    return _start(
        raw_events, "staging", checkpoint, lambda batch, batch_id: route_batch(lake, batch, batch_id), trigger
    )
