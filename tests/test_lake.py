from datetime import timedelta

import pytest
from conftest import at
from pyspark.sql import functions as F

from driftlake.operators import maintenance
from driftlake.schemas import RAW_EVENTS, TABLES
from driftlake.sources.lake import Lake, iceberg_ddl

LIKES = TABLES["stg_likes"]


def likes(rows, days=3, per_day=40):
    return rows(
        "stg_likes",
        *[
            {"time_us": day * 1000 + n, "event_time": at("00:00:00") + timedelta(days=day, seconds=per_day - n), "operation": "create"}
            for day in range(days)
            for n in range(per_day)
        ],
    )


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def fragmented(lake, rows, files=10):
    lake.ensure_table(LIKES)
    many = likes(rows).withColumn("event_date", F.to_date("event_time")).withColumn("batch", F.lit("many"))
    many.repartition(files).write.mode("append").partitionBy(*LIKES.stored_partitions).parquet(lake.path(LIKES.name))


def fingerprint(df):
    return df.select(F.sum(F.xxhash64(*LIKES.schema.names).cast("decimal(38,0)"))).first()[0], df.count()


def test_tables_start_empty_and_are_made_once(lake):
    first = lake.ensure_table(LIKES)
    assert lake.ensure_table(LIKES) == first
    assert lake.read(LIKES.name).count() == 0
    assert lake.read(LIKES.name).columns == LIKES.columns
    lake.ensure_all()
    assert set(lake) == set(TABLES) and len(lake) == len(TABLES)
    with pytest.raises(KeyError):
        lake["nothing"]


def test_appended_rows_are_partitioned_and_sorted(spark, lake, rows):
    lake.ensure_table(LIKES)
    lake.append(LIKES, likes(rows), files_per_day=1)
    lake.append(LIKES, likes(rows, days=1))
    assert lake.read(LIKES.name).count() == 160
    day = spark.read.parquet(lake.path(LIKES.name) + "/event_date=2024-01-02")
    times = [row.event_time for row in day.collect()]
    assert times == sorted(times)
    pruned = lake["stg_likes"].filter(F.col("event_date") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(event_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_raw_events_are_partitioned_by_day_and_type(lake, rows):
    lake.ensure_table(RAW_EVENTS)
    lake.append(RAW_EVENTS, rows("raw_events", {"collection": "a"}, {"collection": None}))
    got = maintenance.partition_rollup(lake.read("raw_events"), RAW_EVENTS.partitions).collect()
    assert [(str(r.ingested_date), r.collection, r.record_count, r.file_count) for r in got] == [
        ("2024-01-01", None, 1, 1), ("2024-01-01", "a", 1, 1),
    ]


def test_compaction_keeps_the_rows(lake, rows):
    fragmented(lake, rows)
    before = fingerprint(lake.read(LIKES.name))
    report = maintenance.compact_table(lake, LIKES)
    assert (report["files_before"], report["files_after"], report["days_rewritten"]) == (30, 3, 3)
    assert fingerprint(lake.read(LIKES.name)) == before
    copy = lake.packed_days(LIKES)["2024-01-02"]
    times = [row.event_time for row in lake.spark.read.parquet(copy).collect()]
    assert times == sorted(times) and len(times) == 40
    # The table's own files are there as before, for streams.
    assert lake.live(LIKES).count() == 120 and len(lake.live(LIKES).inputFiles()) == 30


def test_compaction_leaves_days_in_shape_alone(spark, lake, rows):
    fragmented(lake, rows, files=1)
    extra = likes(rows, days=1)
    lake.append(LIKES, extra)
    before = fingerprint(lake.read(LIKES.name))
    untouched = {row.path for row in maintenance.list_files(spark, lake.path(LIKES.name)).collect() if "2024-01-01" not in row.path}
    assert maintenance.fragmented_days(lake, LIKES) == ["2024-01-01"]
    report = maintenance.compact_table(lake, LIKES)
    assert (report["files_before"], report["files_after"], report["days_rewritten"]) == (4, 3, 1)
    assert untouched <= {row.path for row in maintenance.list_files(spark, lake.path(LIKES.name)).collect()}
    assert fingerprint(lake.read(LIKES.name)) == before
    assert maintenance.compact_table(lake, LIKES)["days_rewritten"] == 0


def test_rows_that_come_after_packing_are_read(lake, rows):
    fragmented(lake, rows)
    maintenance.compact_table(lake, LIKES)
    assert set(lake.packed_days(LIKES)) == {"2024-01-01", "2024-01-02", "2024-01-03"}
    lake.append(LIKES, likes(rows, days=1, per_day=5))
    assert set(lake.packed_days(LIKES)) == {"2024-01-02", "2024-01-03"}
    assert lake.read(LIKES.name).count() == 125
    assert maintenance.compact_table(lake, LIKES, closed_before="2024-01-01")["days_rewritten"] == 0
    report = maintenance.compact_table(lake, LIKES)
    assert (report["days_rewritten"], report["files_after"]) == (1, 3)
    assert lake.read(LIKES.name).count() == 125 and set(lake.packed_days(LIKES)) == set(lake.days(LIKES))


def test_a_copy_counts_once_it_is_complete(spark, lake, rows):
    fragmented(lake, rows)
    before = fingerprint(lake.read(LIKES.name))
    maintenance.compact_table(lake, LIKES)
    (marker,) = lake._glob(lake.packed_path(LIKES.name), "run=*", "_SUCCESS")
    fs, path = lake._fs(marker)
    fs.delete(path, False)  # as if the write had broken off
    assert lake.packed_days(LIKES) == {} and fingerprint(lake.read(LIKES.name)) == before
    assert maintenance.compact_table(lake, LIKES)["files_after"] == 3
    assert fingerprint(lake.read(LIKES.name)) == before


def test_filters_reach_packed_and_other_days(lake, rows):
    fragmented(lake, rows)
    lake.pack_days(LIKES, ["2024-01-02"])
    day = lake["stg_likes"].filter(F.col("event_date") == F.lit("2024-01-02").cast("date"))
    assert day.count() == 40
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(event_date") >= 1


def test_compaction_of_a_table_with_null_partitions(lake, rows):
    lake.ensure_table(RAW_EVENTS)
    for n in range(3):
        lake.append(RAW_EVENTS, rows("raw_events", {"time_us": n, "collection": "a"}, {"time_us": n, "collection": None}))
    report = maintenance.compact_table(lake, RAW_EVENTS)
    assert (report["files_before"], report["files_after"]) == (6, 2)
    assert lake.read("raw_events").groupBy("collection").count().orderBy("collection").collect() == [(None, 3), ("a", 3)]


def test_retention_drops_whole_days(lake, rows):
    fragmented(lake, rows)
    as_of = at("10:00:00") + timedelta(days=31)
    assert lake.days(LIKES) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert maintenance.apply_retention(lake, LIKES, as_of) == ["2024-01-01"]
    assert lake.days(LIKES) == ["2024-01-02", "2024-01-03"]
    assert lake.read(LIKES.name).count() == 80


def test_file_stats_and_hygiene(spark, lake, rows):
    fragmented(lake, rows)
    stats = maintenance.file_stats(spark, {"stg_likes": lake.path("stg_likes")})
    row = stats.first()
    assert (row.file_count, row.record_count, row.small_files, row.small_file_ratio) == (30, 120, 30, 1.0)
    verdicts = {r.check_name: r.status for r in maintenance.hygiene(stats).collect()}
    assert verdicts == {"table.file_count": "ok", "table.avg_file_kb": "warn", "table.small_file_ratio": "warn"}
    total = maintenance.totals_rollup(stats).first()
    assert (total.tables, total.record_count, total.file_count) == (1, 120, 30)


def test_compaction_need(spark):
    rows = [("a", 501, 501 * 31 * 1024), ("b", 10, 10 * 29 * 1024), ("c", 501, 501 * 1024), ("d", 500, 500 * 30 * 1024), ("e", 0, 0)]
    stats = spark.createDataFrame(rows, "table string, file_count long, total_bytes long").withColumn("small_files", F.lit(0))
    got = {r.table: r.reason for r in maintenance.compaction_need(maintenance.with_averages(stats)).collect()}
    assert got == {
        "a": "file_count=501>500",
        "b": "avg_file_kb=29.0<30.0",
        "c": "file_count=501>500; avg_file_kb=1.0<30.0",
        "d": None,
        "e": None,
    }


def test_selection_waits_ten_minutes_unless_named(spark):
    stats = maintenance.with_averages(
        spark.createDataFrame([(t, 600, 1, 0) for t in "abc"], "table string, file_count long, total_bytes long, small_files int")
    )
    log = spark.createDataFrame(
        [("a", at("11:50:01")), ("a", at("09:00:00")), ("b", at("11:50:00"))], "table string, finished_at timestamp"
    )
    chosen = maintenance.select_for_compaction(stats, log, at("12:00:00"))
    assert {r.table: (r.rate_limited, r.selected) for r in chosen.collect()} == {
        "a": (True, False), "b": (False, True), "c": (False, True),
    }
    named = maintenance.select_for_compaction(stats, log, at("12:00:00"), ["a"])
    assert [r.table for r in named.filter("selected").collect()] == ["a"]


def test_maintenance_run(spark, lake, rows):
    fragmented(lake, rows)
    log = spark.createDataFrame([], "table string, finished_at timestamp")
    report, log = maintenance.run_maintenance(lake, log, at("12:00:00"))
    assert [(r.table, r.files_after) for r in report.collect()] == [("stg_likes", 3)]
    again, _ = maintenance.run_maintenance(lake, log, at("12:05:00"))
    assert again.count() == 0


def test_publish_days_replaces_only_its_days(spark, lake, rows, tmp_path):
    fragmented(lake, rows)
    serving = Lake(spark, str(tmp_path / "serving"))
    lake.publish_days(LIKES, serving, "2024-01-01", "2024-01-03", files_per_day=1)
    lake.publish_days(LIKES, serving, "2024-01-02", "2024-01-02", files_per_day=1)
    assert fingerprint(serving.read(LIKES.name)) == fingerprint(lake.read(LIKES.name))
    assert maintenance.file_stats(spark, {"t": serving.path(LIKES.name)}).first().file_count == 3


def test_commit_history_and_growth(rows):
    raw = rows("raw_events", *[{"ingested_at": at("10:00:00") + timedelta(minutes=n), "raw_json": "x" * 1024} for n in (0, 0, 1, 10)])
    history = maintenance.commit_history(raw, payload="raw_json")
    assert [(r.added_records, r.total_records, r.total_bytes) for r in history.orderBy("committed_at").collect()] == [
        (2, 2, 2048), (1, 3, 3072), (1, 4, 4096),
    ]
    growth = maintenance.project_growth(history).first()
    assert (growth.commit_count, growth.guard, growth.history_span_seconds) == (3, None, 600.0)
    assert (growth.records_added, growth.records_per_hour, growth.records_per_day) == (2, 12, 288)
    assert growth.mb_per_hour == round(2048 / 600 * 3600 / 1024**2, 2)


def test_file_history_reads_no_column(spark, lake, rows):
    fragmented(lake, rows)
    table = lake.live(LIKES)
    history = maintenance.file_history(table).collect()
    listed = maintenance.list_files(spark, lake.path(LIKES.name)).agg(F.sum("bytes")).first()[0]
    last = max(history, key=lambda row: row.committed_at)
    assert (last.total_records, last.total_bytes) == (120, listed)
    assert sum(row.added_bytes for row in history) == listed
    plan = table.groupBy("_metadata.file_path").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_file_history_counts_files_without_rows(spark, tmp_path):
    path = str(tmp_path / "a b=c%d")
    for rows in (5, 0):  # a write without rows leaves a file with a footer
        spark.range(rows).coalesce(1).write.mode("append").parquet(path)
    listed = maintenance.list_files(spark, path).agg(F.count("path"), F.sum("bytes")).first()
    history = maintenance.file_history(spark.read.parquet(path))
    total = history.agg(F.max("total_records"), F.max("total_bytes")).first()
    assert (listed[0], *total) == (2, 5, listed[1])


def test_small_files_stay_small_whatever_the_table_holds(spark, tmp_path):
    from driftlake_checks.queries import SMALL_FILE_ROWS, write_small_files

    write_small_files(spark.range(100_000), str(tmp_path / "small"))
    files = spark.read.parquet(str(tmp_path / "small")).groupBy("_metadata.file_path").count()
    assert files.agg(F.sum("count"), F.max("count")).first() == (100_000, SMALL_FILE_ROWS)
    assert files.count() == 400


def test_growth_guards(spark):
    schema = "committed_at timestamp, total_records long, total_bytes long"
    cases = {
        "too few commits": [(at("10:00:00"), 1, 1)],
        "no commit times": [(None, 1, 1), (None, 2, 2)],
        "no time between commits": [(at("10:00:00"), 1, 1), (at("10:00:00"), 2, 2)],
    }
    for guard, commits in cases.items():
        row = maintenance.project_growth(spark.createDataFrame(commits, schema)).first()
        assert (row.guard, row.records_per_second, row.records_added) == (guard, None, None)


def test_iceberg_statements():
    create, order = iceberg_ddl(RAW_EVENTS, "lake.raw.raw_events")
    assert "PARTITIONED BY (days(ingested_at), collection)" in create
    assert "did string NOT NULL" in create and "collection string,\n" in create
    assert order == "ALTER TABLE lake.raw.raw_events WRITE ORDERED BY ingested_at ASC"
