"""File hygiene of lake tables: sizes, compaction, retention, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.functions.clock import Clock, clock
from driftlake.operators.positions import running_totals
from driftlake.schemas import BATCH, TABLES, TableSpec
from driftlake.sources.lake import Lake

# When a table is compacted, how often, and when its files are unhealthy.
COMPACT_FILE_COUNT = 500
COMPACT_AVG_KB = 30.0
COMPACT_EVERY_MINUTES = 10
HYGIENE_FILE_COUNT = 5000
HYGIENE_AVG_KB = 32.0
HYGIENE_SMALL_RATIO = 0.50
RETAIN_DAYS = 30
COMPACT_MIN_FILES = 2

# What counts as well below the target size.
SMALL_SHARE = 0.75

TARGET_FILE_BYTES = 256 * 1024 * 1024


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The parquet files below a path, or several, with their sizes; no file is opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path if isinstance(path, str) else list(path))
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified_at"))
    )


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def file_stats(
    spark: SparkSession, paths: Mapping[str, str | Sequence[str]], small_kb: float = HYGIENE_AVG_KB
) -> DataFrame:
    """Files, bytes, records and the share of small files per table, which is one folder or several.

    Sizes come from the listing.  Records are counted by a scan that reads no column, so
    only file footers are touched.
    """
    parts = []
    for name, path in paths.items():
        table = F.lit(name).alias("table")
        listed = list_files(spark, path).select(
            table,
            F.lit(1).alias("files"),
            "bytes",
            (F.col("bytes") < small_kb * 1024).cast("int").alias("small"),
            F.lit(0).cast("bigint").alias("records"),
        )
        footers = spark.read.option("recursiveFileLookup", "true")
        counted = footers.parquet(*([path] if isinstance(path, str) else path)).agg(F.count(F.lit(1)).alias("records"))
        parts.append(listed)
        parts.append(
            counted.select(
                table, F.lit(0).alias("files"), F.lit(0).cast("bigint").alias("bytes"), F.lit(0).alias("small"), "records"
            )
        )
    grouped = _union(parts).groupBy("table").agg(
        F.sum("files").alias("file_count"),
        F.sum("bytes").alias("total_bytes"),
        F.sum("records").alias("record_count"),
        F.sum("small").alias("small_files"),
    )
    return with_averages(grouped)


def with_averages(stats: DataFrame) -> DataFrame:
    """Add average size and small-file share to counts; both 0 for an empty table."""
    count = F.col("file_count").cast("double")
    return stats.withColumn(
        "avg_file_kb", F.coalesce(F.try_divide(F.col("total_bytes").cast("double"), count) / 1024.0, F.lit(0.0))
    ).withColumn("small_file_ratio", F.coalesce(F.try_divide(F.col("small_files").cast("double"), count), F.lit(0.0)))


def compaction_need(stats: DataFrame) -> DataFrame:
    """Whether a table has too many or too small files, and why."""
    many = F.when(
        F.col("file_count") > COMPACT_FILE_COUNT,
        F.concat(F.lit("file_count="), F.col("file_count"), F.lit(f">{COMPACT_FILE_COUNT}")),
    )
    small = F.when(
        (F.col("avg_file_kb") > 0) & (F.col("avg_file_kb") < COMPACT_AVG_KB),
        F.concat(F.lit("avg_file_kb="), F.format_string("%.1f", "avg_file_kb"), F.lit(f"<{COMPACT_AVG_KB}")),
    )
    reason = F.concat_ws("; ", many, small)
    return stats.withColumn("needs_compaction", many.isNotNull() | small.isNotNull()).withColumn(
        "reason", F.when(reason != "", reason)
    )


def select_for_compaction(
    stats: DataFrame, log: DataFrame, as_of: Clock = None, explicit: Sequence[str] | None = None
) -> DataFrame:
    """Tables to compact now.

    A table compacted in the last ten minutes waits.  An explicit list is taken as it is.
    ``log`` has ``table`` and ``finished_at`` of earlier runs.
    """
    last = log.groupBy("table").agg(F.max("finished_at").alias("last_compacted_at"))
    joined = compaction_need(stats).join(last, "table", "left")
    limited = F.coalesce(
        clock(as_of) - F.expr(f"INTERVAL {COMPACT_EVERY_MINUTES} MINUTES") < F.col("last_compacted_at"), F.lit(False)
    )
    marked = joined.withColumn("rate_limited", limited)
    if explicit is not None:
        return marked.withColumn("selected", F.col("table").isin(list(explicit)))
    return marked.withColumn("selected", F.col("needs_compaction") & ~F.col("rate_limited"))


def hygiene(stats: DataFrame) -> DataFrame:
    """File-count, average-size and small-file verdicts, one row each per table."""
    empty = F.col("file_count") == 0
    checks = F.array(
        F.struct(
            F.lit("table.file_count").alias("check_name"),
            F.col("file_count").cast("double").alias("value_num"),
            F.when(F.col("file_count") > HYGIENE_FILE_COUNT, "breach").otherwise("ok").alias("status"),
        ),
        F.struct(
            F.lit("table.avg_file_kb").alias("check_name"),
            F.col("avg_file_kb").alias("value_num"),
            F.when(~empty & (F.col("avg_file_kb") < HYGIENE_AVG_KB), "warn").otherwise("ok").alias("status"),
        ),
        F.struct(
            F.lit("table.small_file_ratio").alias("check_name"),
            F.col("small_file_ratio").alias("value_num"),
            F.when(~empty & (F.col("small_file_ratio") > HYGIENE_SMALL_RATIO), "warn")
            .otherwise("ok")
            .alias("status"),
        ),
    )
    return stats.select("table", F.inline(checks))


# -- rewriting ---------------------------------------------------------------------------
def _reader_files(lake: Lake, spec: TableSpec) -> DataFrame | None:
    """The files a reader of the table opens, with their ``day`` and ``folder``; None if there are none."""
    folders = lake.reader_files(spec)
    if not folders:
        return None
    return list_files(lake.spark, folders).select(
        "*",
        F.regexp_extract("path", f"{spec.date_column}=([0-9-]+)", 1).alias("day"),
        F.regexp_replace("path", f"(/{BATCH}=[^/]*)?/[^/]*$", "").alias("folder"),
    )


def _totals(lake: Lake, spec: TableSpec) -> tuple[int, int]:
    files = _reader_files(lake, spec)
    if files is None:
        return 0, 0
    row = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    return row["files"], row["bytes"]


def fragmented_days(lake: Lake, spec: TableSpec, target_bytes: int = TARGET_FILE_BYTES) -> list[str]:
    """Days with a partition in which a reader opens two or more files well below the target size."""
    files = _reader_files(lake, spec)
    if files is None:
        return []
    small = files.filter((F.col("day") != "") & (F.col("bytes") < F.lit(target_bytes * SMALL_SHARE)))
    crowded = small.groupBy("day", "folder").count().filter(F.col("count") >= COMPACT_MIN_FILES)
    return [row["day"] for row in crowded.select("day").distinct().orderBy("day").collect()]


def compact_table(
    lake: Lake, spec: TableSpec, target_bytes: int = TARGET_FILE_BYTES, closed_before: str | None = None
) -> dict[str, object]:
    """Pack days that have small files into few files, sorted as before.

    Readers take packed days from their copies; the table's own files stay for streams, which
    may still have to read them, until retention drops the day.  Writers may go on meanwhile:
    a day that gets new files is read from the table until it is packed again, so days before
    ``closed_before`` (``YYYY-MM-DD``) are the ones worth packing.  All days are one write; file
    counts are those that a reader sees.
    """
    files_before, bytes_before = _totals(lake, spec)
    days = [day for day in fragmented_days(lake, spec, target_bytes) if closed_before is None or day < closed_before]
    lake.pack_days(spec, days)
    files_after, bytes_after = _totals(lake, spec)
    return {
        "table": spec.name,
        "files_before": files_before,
        "files_after": files_after,
        "bytes_before": bytes_before,
        "bytes_after": bytes_after,
        "days_rewritten": len(days),
    }


def run_maintenance(
    lake: Lake,
    log: DataFrame,
    as_of: datetime,
    tables: Sequence[str] | None = None,
    closed_before: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Compact the tables that need it, one after another.

    Returns the report and the log with this run added.  Only the names of the chosen
    tables come to the driver.
    """
    spark = lake.spark
    stats = file_stats(spark, {name: lake.reader_files(TABLES[name]) or lake.path(name) for name in lake})
    chosen = select_for_compaction(stats, log, as_of, tables).filter("selected").select("table")
    names = [row["table"] for row in chosen.orderBy("table").collect()]
    rows = [compact_table(lake, TABLES[name], closed_before=closed_before) for name in names]
    report = spark.createDataFrame(
        [tuple(row.values()) for row in rows],
        "table string, files_before bigint, files_after bigint, bytes_before bigint, bytes_after bigint,"
        " days_rewritten bigint",
    )
    done = report.select("table", F.lit(as_of).alias("finished_at"))
    return report, log.select("table", "finished_at").unionByName(done)


def expired_days(days: Sequence[str], as_of: datetime, retain_days: int = RETAIN_DAYS) -> list[str]:
    """Days that lie wholly before the retention window."""
    limit = (as_of - timedelta(days=retain_days)).date().isoformat()
    return [day for day in days if day < limit]


def apply_retention(lake: Lake, spec: TableSpec, as_of: datetime, retain_days: int = RETAIN_DAYS) -> list[str]:
    """Delete the expired day partitions; returns the days that went."""
    gone = expired_days(lake.days(spec), as_of, retain_days)
    lake.drop_days(spec, gone)
    return gone


# -- sizing ------------------------------------------------------------------------------
def partition_rollup(table: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Records and files per partition.  Reads partition values and file names only."""
    files = table.groupBy(*partitions, F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("records")
    )
    return (
        files.groupBy(*partitions)
        .agg(F.sum("records").alias("record_count"), F.count(F.lit(1)).alias("file_count"))
        .orderBy(*partitions)
    )


def commit_history(raw_events: DataFrame, stamp: str = "ingested_at", payload: str | None = None) -> DataFrame:
    """Added and total records per arrival minute; with ``payload`` also the bytes of that column, which is read for it."""
    size = F.sum(F.octet_length(payload)) if payload else F.lit(0).cast("bigint")
    minutes = raw_events.groupBy(F.date_trunc("minute", stamp).alias("committed_at")).agg(
        F.count(F.lit(1)).alias("added_records"), size.alias("added_bytes")
    )
    return running_totals(
        minutes, "committed_at", {"added_records": "total_records", "added_bytes": "total_bytes"}
    )


def file_history(table: DataFrame) -> DataFrame:
    """Added and total records and bytes per minute in which files of the table were written.

    From sizes and times in the listing, and record counts in footers; no column is read.  A file
    without rows, as an empty task writes it, has bytes and a time like any other.
    """
    minute = F.date_trunc("minute", "at").alias("committed_at")
    counted = table.select(F.col("_metadata.file_modification_time").alias("at")).groupBy(minute).agg(
        F.count(F.lit(1)).alias("added_records"), F.lit(0).cast("bigint").alias("added_bytes")
    )
    paths = [unquote(path) for path in table.inputFiles()]
    if paths:
        listed = list_files(table.sparkSession, paths).withColumnRenamed("modified_at", "at")
        sizes = listed.groupBy(minute).agg(
            F.lit(0).cast("bigint").alias("added_records"), F.sum("bytes").alias("added_bytes")
        )
        counted = counted.unionByName(sizes)
    minutes = counted.groupBy("committed_at").agg(
        F.sum("added_records").alias("added_records"), F.sum("added_bytes").alias("added_bytes")
    )
    return running_totals(
        minutes, "committed_at", {"added_records": "total_records", "added_bytes": "total_bytes"}
    )


def project_growth(history: DataFrame) -> DataFrame:
    """Growth rates between the first and the last commit; one row.

    ``guard`` says why there are none: too few commits, no times, or no time between them.
    """
    ends = history.agg(
        F.count(F.lit(1)).alias("commit_count"),
        F.min("committed_at").alias("first_at"),
        F.max("committed_at").alias("last_at"),
        F.min_by("total_records", "committed_at").alias("_r0"),
        F.max_by("total_records", "committed_at").alias("_r1"),
        F.min_by("total_bytes", "committed_at").alias("_b0"),
        F.max_by("total_bytes", "committed_at").alias("_b1"),
    )
    elapsed = (F.unix_micros("last_at") - F.unix_micros("first_at")) / F.lit(1e6)
    guard = (
        F.when(F.col("commit_count") < 2, "too few commits")
        .when(F.col("first_at").isNull(), "no commit times")
        .when(elapsed <= 0, "no time between commits")
    )
    guarded = ends.withColumn("guard", guard).withColumn("elapsed_s", F.when(guard.isNull(), elapsed))
    records, size = F.col("_r1") - F.col("_r0"), F.col("_b1") - F.col("_b0")
    per_second = records / F.col("elapsed_s")
    bytes_per_second = size / F.col("elapsed_s")
    return guarded.select(
        "commit_count",
        "guard",
        F.round("elapsed_s", 1).alias("history_span_seconds"),
        F.when(F.col("guard").isNull(), records).alias("records_added"),
        F.round(per_second, 2).alias("records_per_second"),
        (per_second * 60).cast("bigint").alias("records_per_minute"),
        (per_second * 3600).cast("bigint").alias("records_per_hour"),
        (per_second * 86400).cast("bigint").alias("records_per_day"),
        F.when(F.col("guard").isNull(), size).alias("bytes_added"),
        F.round(bytes_per_second * 3600 / (1024 * 1024), 2).alias("mb_per_hour"),
        F.round(bytes_per_second * 86400 / (1024 * 1024 * 1024), 3).alias("gb_per_day"),
    )


def totals_rollup(stats: DataFrame) -> DataFrame:
    """Bytes, records and files over all tables."""
    return stats.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("total_bytes").alias("total_bytes"),
        F.sum("record_count").alias("record_count"),
        F.sum("file_count").alias("file_count"),
    )
