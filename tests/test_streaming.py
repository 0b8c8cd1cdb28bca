from datetime import datetime, timedelta, timezone

import pytest
from conftest import at, event, micros
from pyspark.sql import functions as F

from driftlake.operators import core, maintenance, sentiment, staging
from driftlake.schemas import LIKE, POST, QUARANTINE, REPOST, TABLES
from driftlake.sources import events
from driftlake.sources.lake import Lake
from driftlake.streaming import layers
from driftlake.plans import marts
from driftlake.streaming.marts import STREAM_MARTS, start_mart, start_top_posts, windowed_counts
from driftlake.streaming.marts import stored_active_users, stored_firehose_stats


def land(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def post(n, **record):
    return event(time_us=micros(at("10:00:00")) + n, collection=POST, operation="create", rkey=f"r{n}",
                 record={"text": f"good {n}", **record})


TAGGED = [{"features": [{"$type": "app.bsky.richtext.facet#tag", "tag": "A"}]}]


@pytest.fixture
def config(tmp_path):
    return layers.LayerConfig(
        str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "checkpoints"), available_now=True
    )


def first_batch(tmp_path):
    land(
        tmp_path / "landing",
        "one.json",
        post(1, tags=["x"], facets=TAGGED),
        post(2),
        event(time_us=5, collection=LIKE, operation="create", record={"subject": {"uri": "u"}}),
        event(time_us=6, collection=REPOST, operation="create", record={"subject": {"uri": "v"}}),
        event(time_us=7, kind="identity"),
        "broken",
    )


def counts(spark, config):
    lake = Lake(spark, config.lake_root)
    return {name: lake.read(name).count() for name in TABLES}


FIRST = {
    "raw_events": 5, "stg_posts": 2, "stg_likes": 1, "stg_reposts": 1, "stg_follows": 0, "stg_blocks": 0,
    "stg_profiles": 0, "core_posts": 2, "core_mentions": 0, "core_hashtags": 2, "core_engagement": 2,
    "core_post_sentiment": 2,
}


def test_layers_take_landed_lines_all_the_way_and_resume(spark, tmp_path, config):
    first_batch(tmp_path)
    layers.run_layers(spark, config)
    assert counts(spark, config) == FIRST
    # Started again on the same checkpoints, nothing is read twice.
    layers.run_layers(spark, config)
    assert counts(spark, config) == FIRST
    land(tmp_path / "landing", "two.json", post(3), post(4, tags=["y", "z"]))
    layers.run_layers(spark, config)
    assert counts(spark, config) == {
        **FIRST, "raw_events": 7, "stg_posts": 4, "core_posts": 4, "core_hashtags": 4, "core_post_sentiment": 4,
    }


def test_stream_equals_batch(spark, tmp_path, config):
    first_batch(tmp_path)
    layers.run_layers(spark, config)
    lake = Lake(spark, config.lake_root)
    raw = events.to_raw_events(events.read_events(spark, config.landing))
    posts = core.core_posts(staging.stg_posts(raw))
    scored = sentiment.score_posts(posts)
    for name, batch in {"raw_events": raw, "core_posts": posts, "core_post_sentiment": scored}.items():
        columns = [column for column in TABLES[name].schema.names if column != "ingested_at"]
        streamed = lake.read(name).select(*columns)
        assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.select(*columns).collect()))


def test_batch_writers_share_streamed_tables(spark, tmp_path, config, rows):
    first_batch(tmp_path)
    layers.run_layers(spark, config)
    lake = Lake(spark, config.lake_root)
    lake.append(TABLES["stg_posts"], rows("stg_posts", {}))
    assert lake.read("stg_posts").count() == 3
    serving = Lake(spark, str(tmp_path / "serving"))
    for _ in range(2):
        lake.publish_days(TABLES["stg_posts"], serving, "2024-01-01", "2024-01-01")
        assert serving.read("stg_posts").count() == 3


def test_compaction_and_retention_of_streamed_tables(spark, tmp_path, config):
    lake = Lake(spark, config.lake_root)
    for n in range(4):
        land(tmp_path / "landing", f"{n}.json", post(n))
        layers.run_layers(spark, config)
    assert lake.read("core_posts").count() == 4
    for name in ("raw_events", "stg_posts"):
        report = maintenance.compact_table(lake, TABLES[name])
        assert (report["files_before"], report["files_after"]) == (4, 1)
        assert lake.read(name).count() == 4
    # Streams that read the tables take the new event alone, not the packed copies.
    land(tmp_path / "landing", "4.json", post(4))
    layers.run_layers(spark, config)
    assert [lake.read(name).count() for name in ("raw_events", "stg_posts", "core_posts")] == [5, 5, 5]
    days = lake.days(TABLES["stg_posts"])
    later = datetime.fromisoformat(days[-1]).replace(tzinfo=timezone.utc) + timedelta(days=32)
    assert maintenance.apply_retention(lake, TABLES["stg_posts"], later) == days
    assert lake.read("stg_posts").count() == 0


def test_routed_tables_compact_and_replay(spark, tmp_path, config):
    first_batch(tmp_path)
    raw = events.to_raw_events(events.read_events(spark, config.landing))
    lake, spec = Lake(spark, config.lake_root), TABLES["stg_posts"]
    for name in staging.STAGING:
        lake.ensure_table(TABLES[name])
    for batch in range(3):
        layers.route_batch(lake, raw, batch)
    before = sorted(map(str, lake.read(spec.name).collect()))
    assert maintenance.compact_table(lake, spec)["days_rewritten"] == 1
    layers.route_batch(lake, raw, 2)
    assert sorted(map(str, lake.read(spec.name).collect())) == before
    layers.route_batch(lake, raw, 3)
    assert lake.read(spec.name).count() == len(before) + 2


def test_a_stream_that_starts_after_compaction_reads_everything_once(spark, tmp_path, config):
    lake = Lake(spark, config.lake_root)

    def seen():
        lake.stream("raw_events").select("time_us").writeStream.format("parquet").option("path", str(tmp_path / "seen")).option(
            "checkpointLocation", str(tmp_path / "late")
        ).trigger(availableNow=True).start().awaitTermination()
        return sorted(row.time_us for row in spark.read.parquet(str(tmp_path / "seen")).collect())

    for n in range(3):
        land(tmp_path / "landing", f"{n}.json", post(n))
        for query in layers.start_raw(spark, config):
            query.awaitTermination()
    assert maintenance.compact_table(lake, TABLES["raw_events"])["files_after"] == 1
    everything = [micros(at("10:00:00")) + n for n in range(3)]
    assert seen() == everything
    land(tmp_path / "landing", "3.json", post(3))
    for query in layers.start_raw(spark, config):
        query.awaitTermination()
    maintenance.compact_table(lake, TABLES["raw_events"])
    assert seen() == [*everything, micros(at("10:00:00")) + 3]


def test_lines_go_to_the_raw_table_or_to_quarantine_once(spark, tmp_path, config, monkeypatch):
    first_batch(tmp_path)
    lake, parsed, plain = Lake(spark, config.lake_root), [], Lake.write_batch

    def breaks_off(lake, spec, *rest):
        if spec == QUARANTINE and not parsed:
            parsed.append(spec)
            raise OSError("gone")
        return plain(lake, spec, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(Lake, "write_batch", breaks_off)
        (query,) = layers.start_raw(spark, config)
        with pytest.raises(Exception):
            query.awaitTermination()
    # The raw table had its part of the batch; after a restart both have it once.
    assert (lake.read("raw_events").count(), lake.read_table(QUARANTINE).count()) == (5, 0)
    (query,) = layers.start_raw(spark, config)
    query.awaitTermination()
    assert lake.read("raw_events").count() == 5
    assert [row.raw_json for row in lake.read_table(QUARANTINE).collect()] == ["broken"]
    land(tmp_path / "landing", "two.json", post(3), "{", "")
    (query,) = layers.start_raw(spark, config)
    query.awaitTermination()
    assert (lake.read("raw_events").count(), lake.read_table(QUARANTINE).count()) == (6, 3)


def test_batches_of_two_streams_stay_apart(spark, tmp_path, config):
    """Two checkpoints over one table: each stream's batch 0 keeps its own folders."""
    first_batch(tmp_path)
    other = layers.LayerConfig(config.landing, config.lake_root, str(tmp_path / "other"), available_now=True)
    for each in (config, other, config):
        for query in layers.start_raw(spark, each):
            query.awaitTermination()
    assert Lake(spark, config.lake_root).read("raw_events").count() == 10


def test_staging_reads_only_its_partition(spark, tmp_path, config):
    first_batch(tmp_path)
    for query in layers.start_raw(spark, config):
        query.awaitTermination()
    raw = Lake(spark, config.lake_root).read("raw_events")
    plan = staging.stg_likes(raw)._jdf.queryExecution().executedPlan().toString()
    assert "collection" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_layers_run_side_by_side(spark, tmp_path):
    first_batch(tmp_path)
    config = layers.LayerConfig(
        str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "checkpoints"), trigger="200 milliseconds"
    )
    queries = layers.run_layers(spark, config)
    try:
        assert len(queries) == 10
        for _ in range(4):
            for query in queries:
                query.processAllAvailable()
        assert counts(spark, config) == FIRST
    finally:
        for query in queries:
            query.stop()


def test_router_rewrites_a_repeated_batch(spark, tmp_path, config):
    first_batch(tmp_path)
    raw = events.to_raw_events(events.read_events(spark, config.landing))
    lake = Lake(spark, config.lake_root)
    for name in staging.STAGING:
        lake.ensure_table(TABLES[name])
    for _ in range(2):
        layers.route_batch(lake, raw, 0)
    assert {name: lake.read(name).count() for name in staging.STAGING} == {
        name: count for name, count in FIRST.items() if name.startswith("stg_")
    }
    layers.route_batch(lake, raw, 1)
    assert lake.read("stg_posts").count() == 4


def test_an_account_added_between_batches_counts_from_then_on(spark, tmp_path, rows):
    lake, accounts = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "accounts")

    def step(listed, first):
        spark.createDataFrame([(did,) for did in listed], "did string").write.mode("append").parquet(accounts)
        rows("raw_events", *[{"did": did, "time_us": first} for did in "abc"]).write.mode("append").parquet(str(tmp_path / "in"))
        events_in = spark.readStream.schema(TABLES["raw_events"].schema).parquet(str(tmp_path / "in"))
        layers.start_listed(
            events_in, lake, TABLES["raw_events"], lambda: spark.read.parquet(accounts), str(tmp_path / "cp"), availableNow=True
        ).awaitTermination()
        return sorted((r.did, r.time_us) for r in lake.read("raw_events").collect())

    assert step(["a"], 1) == [("a", 1)]
    assert step(["b"], 2) == [("a", 1), ("a", 2), ("b", 2)]


def test_rate_limit_splits_batches(spark, tmp_path):
    for n in range(3):
        land(tmp_path / "landing", f"{n}.json", post(n))
    config = layers.LayerConfig(
        str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "checkpoints"), available_now=True, max_files=1
    )
    (query,) = layers.start_raw(spark, config)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows == 1]) == 3
    assert Lake(spark, config.lake_root).read("raw_events").count() == 3


def test_stream_dedup_drops_replayed_events(spark, tmp_path):
    land(tmp_path / "landing", "a.json", post(1), post(2), post(1))
    stream = events.drop_replayed_stream(
        events.to_raw_events(events.read_events_stream(spark, str(tmp_path / "landing")))
    )

    def run():
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    assert run() == 2
    land(tmp_path / "landing", "b.json", post(2), post(3))
    assert run() == 3


def test_streamed_mart_holds_open_windows_and_drops_late_events(spark, tmp_path):
    def write(name, *times):
        df = spark.createDataFrame([(t, "en") for t in times], "event_time timestamp, primary_lang string")
        df.coalesce(1).write.parquet(str(tmp_path / "source" / name))

    def run():
        # Each run drains what is new; the watermark moves between runs.
        rows = spark.readStream.schema("event_time timestamp, primary_lang string").option(
            "recursiveFileLookup", "true"
        ).parquet(str(tmp_path / "source"))
        start_mart(
            "mart_language_distribution", rows, str(tmp_path / "mart"), str(tmp_path / "cp"), availableNow=True
        ).awaitTermination()
        got = spark.read.parquet(str(tmp_path / "mart")).collect()
        return sorted((r.bucket_min.strftime("%H:%M"), r["count"]) for r in got)

    write("a", at("10:00:10"), at("10:00:50"), at("10:01:00"))
    assert run() == []
    write("b", at("10:16:30"), at("10:00:59"))
    assert run() == [("10:00", 3)]
    write("c", at("10:00:30"), at("10:40:00"))
    assert run() == [("10:00", 3), ("10:01", 1), ("10:16", 1)]


def test_every_streamed_mart_equals_its_batch_mart(spark, rows):
    """The same windows as the batch mart, where that has minute buckets."""
    posts = rows("core_posts", *[{"event_time": at("10:00:00") + timedelta(seconds=7 * n), "content_type": "ab"[n % 2]} for n in range(30)])
    batch = posts.groupBy(F.date_trunc("minute", "event_time").alias("b"), "content_type").count()
    windowed = windowed_counts(posts, "event_time", ["content_type"])
    assert sorted(map(tuple, windowed.collect())) == sorted(map(tuple, batch.collect()))
    assert set(source for source, _ in STREAM_MARTS.values()) <= set(TABLES)


def stepwise(spark, folder, name, rows):
    """Files in turn, one a micro-batch."""
    for step in rows:
        step.coalesce(1).write.mode("append").parquet(str(folder / name))
    return spark.readStream.schema(rows[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder / name))


def test_late_scores_meet_their_posts_and_state_is_let_go(spark, tmp_path, rows):
    def posts(*minutes):
        return rows("core_posts", *[{"time_us": m, "event_time": at("10:00:00") + timedelta(minutes=m), "text": f"t{m}"} for m in minutes])

    def scores(*minutes):
        return rows("core_post_sentiment", *[
            {"time_us": m, "event_time": at("10:00:00") + timedelta(minutes=m), "sentiment_label": "neutral"} for m in minutes])

    # Scores come a step after their posts; 1 never gets one, 70 arrives before its post, 5's comes too late.
    left = stepwise(spark, tmp_path, "posts", [posts(0, 1, 5), posts(10, 12), posts(60, 61), posts(70, 120), posts(121)])
    right = stepwise(spark, tmp_path, "scores", [scores(0), scores(10), scores(12, 70), scores(61, 60, 120), scores(5, 121)])
    query = start_top_posts(left, right, str(tmp_path / "mart"), str(tmp_path / "cp"), availableNow=True)
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "mart")).collect()
    assert sorted((r.time_us, r.text, r.sentiment_label) for r in got) == [
        (m, f"t{m}", "neutral") for m in (0, 10, 12, 60, 61, 70, 120, 121)
    ]
    # Of 9 posts and 9 scores only those within the watermark of the newest are kept.
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert max(kept) <= 14 and kept[-1] == 4


def test_stored_sketches_give_buckets_and_merge(spark, tmp_path, rows):
    def events(second, accounts):
        return [{"did": f"d{n}", "ingested_at": at("10:00:00") + timedelta(seconds=second), "collection": "c"} for n in accounts]

    steps = [rows("raw_events", *events(0, range(300)), *events(5, range(200, 400))),
             rows("raw_events", *events(12, range(350, 450)), *events(3, range(395, 405))),
             rows("raw_events", *events(3600, [0]))]
    stream = stepwise(spark, tmp_path, "events", steps)
    start_mart("mart_firehose_stats", stream, str(tmp_path / "mart"), str(tmp_path / "cp"), availableNow=True).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "mart"))
    got = {(r.bucket.second, r["count"]): r.unique_dids_approx for r in stored_firehose_stats(stored).collect()}
    assert set(got) == {(0, 510), (10, 100)}
    assert abs(got[(0, 510)] - 405) <= 20 and abs(got[(10, 100)] - 100) <= 5
    assert abs(stored_active_users(stored, at("10:15:00")).first().active_users - 450) <= 22
    assert abs(stored_active_users(stored, at("10:15:05")).first().active_users - 100) <= 5
    assert stored_active_users(stored, at("12:00:00")).first().active_users == 0


def test_streamed_velocity_has_the_batch_marts_grain(spark, tmp_path, rows):
    likes = rows("core_engagement", *[{"event_type": "like", "actor_did": "a", "event_time": at("10:00:00") + timedelta(seconds=3 * n)} for n in range(20)])
    late = rows("core_engagement", {"event_type": "like", "actor_did": "a", "event_time": at("11:00:00")})
    stream = stepwise(spark, tmp_path, "likes", [likes, late])
    start_mart("mart_engagement_velocity", stream, str(tmp_path / "mart"), str(tmp_path / "cp"), availableNow=True).awaitTermination()
    batch = marts.mart_engagement_velocity({"core_engagement": likes}, at("11:00:00"))
    got = spark.read.parquet(str(tmp_path / "mart"))
    assert got.columns == batch.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_steps_are_landed_by_the_tasks_that_make_them(spark, tmp_path):
    from driftlake_checks.queries import _in_steps

    times = spark.range(0, 80, 1, 4).selectExpr("id", "timestamp_seconds(id % 20) AS at")
    path, before = str(tmp_path / "in"), set()
    for step, (stream,) in enumerate(_in_steps({path: (times, "at")})):
        assert stream.isStreaming
        landed = spark.read.parquet(path).select("id", "_metadata.file_path").collect()
        fresh = {row.id for row in landed} - before
        assert {n % 20 for n in fresh} == set(range(step * 5, step * 5 + 5))
        assert len({row.file_path for row in landed if row.id in fresh}) == 4
        before |= fresh
    assert len(landed) == 80


def test_landed_files_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    from driftlake_checks import queries

    monkeypatch.setattr(queries, "LANDED_LINES", 10)
    lines, path = spark.range(0, 120, 1, 2).selectExpr("cast(id AS string) AS value", "id"), str(tmp_path / "in")
    queries._land(lines, path, 3)
    files = spark.read.text(path).groupBy("_metadata.file_name").count().collect()
    assert all(row.file_name.endswith(".gz") and row["count"] <= 10 for row in files)
    assert sum(row["count"] for row in files) == spark.read.text(path).distinct().count() == 120
    assert queries._files_a_step(spark, path, 3) == len(files) // 3
    monkeypatch.setattr(queries, "BATCH_FILES", 2)
    assert queries._files_a_step(spark, path, 3) == 2


def test_router_keeps_no_rows(spark, tmp_path, config, monkeypatch):
    first_batch(tmp_path)
    raw = events.to_raw_events(events.read_events(spark, config.landing))
    lake = Lake(spark, config.lake_root)
    for name in staging.STAGING:
        lake.ensure_table(TABLES[name])
    monkeypatch.setattr(type(raw), "persist", lambda *_: pytest.fail("rows were kept"))
    layers.route_batch(lake, raw, 0)
    files = [f for name in staging.STAGING for f in lake.read(name).inputFiles()]
    assert files and all(".zstd." in f for f in files)
