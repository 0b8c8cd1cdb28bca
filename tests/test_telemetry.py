import itertools
import random

import pytest
from conftest import at
from pyspark.sql import functions as F

from driftlake.functions import severity
from driftlake.operators import telemetry
from driftlake.schemas import TABLES

HISTORY = "ts long, seq long, check_name string, status string, value_num double"


def history(spark, *statuses, check="c"):
    return spark.createDataFrame([(n, n, check, s, float(n)) for n, s in enumerate(statuses)], HISTORY)


def should_alert(statuses, index, tolerance):
    """The rule restated: a failing run alerts when it is as long as the tolerance."""
    run = 0
    while run <= index and statuses[index - run] in ("breach", "error"):
        run += 1
    return run == tolerance


def test_alerts_on_every_short_history(spark):
    words = ("ok", "warn", "breach", "error")
    runs = [run for length in range(1, 5) for run in itertools.product(words, repeat=length)]
    data = [(n, n, f"c{number}", s, 0.0) for number, run in enumerate(runs) for n, s in enumerate(run)]
    df = spark.createDataFrame(data, HISTORY)
    for tolerance in (1, 2, 3):
        got = {(row.check_name, row.ts) for row in telemetry.breach_alerts(df, tolerance).collect()}
        want = {
            (f"c{number}", n)
            for number, run in enumerate(runs)
            for n in range(len(run))
            if should_alert(run, n, tolerance)
        }
        assert got == want


def test_alert_runs_cross_slices_and_tolerances_differ(spark):
    chance = random.Random(3)
    statuses = {c: [chance.choice(["ok", "breach", "error"]) for _ in range(400)] for c in ("a", "b")}
    df = history(spark, *statuses["a"], check="a").unionByName(history(spark, *statuses["b"], check="b"))
    got = {(r.check_name, r.ts) for r in telemetry.breach_alerts(df, {"a": 3, "b": 1}).collect()}
    want = {(c, n) for c, t in (("a", 3), ("b", 1)) for n in range(400) if should_alert(statuses[c], n, t)}
    assert got == want


def test_recovery_needs_a_failure_right_before(spark):
    df = history(spark, "ok", "breach", "ok", "warn", "ok", "error", "warn", "ok")
    assert [row.ts for row in telemetry.recoveries(df).collect()] == [2]


def test_latest_keeps_ties_and_last_n_does_not(spark):
    df = spark.createDataFrame(
        [(1, 1, "c", "ok", 0.0), (2, 2, "c", "ok", 0.0), (2, 3, "c", "breach", 0.0), (1, 4, "d", "ok", 0.0)], HISTORY
    )
    assert sorted(r.seq for r in telemetry.latest_results(df).collect()) == [2, 3, 4]
    assert sorted(r.seq for r in telemetry.last_results(df, 2).collect()) == [2, 3, 4]


@pytest.mark.parametrize("count", [1, 3, 50, 5000])
def test_last_results_on_uneven_checks(spark, count):
    chance = random.Random(4)
    data = [(chance.randrange(400_000), n, chance.choice("aaaaab"), "ok", 0.0) for n in range(600)]
    data += [(400_000, 1000 + n, "a", "ok", 0.0) for n in range(40)]
    df = spark.createDataFrame(data, HISTORY)
    got = {(r.check_name, r.seq, r.recency) for r in telemetry.last_results(df, count).collect()}
    want = set()
    for check in "ab":
        own = sorted((row for row in data if row[2] == check), reverse=True)[:count]
        want |= {(check, row[1], place) for place, row in enumerate(own, 1)}
    assert got == want


def test_history_window_and_retention(spark):
    df = history(spark, *["ok"] * 10)
    assert telemetry.recent_history(df, 9, 3).count() == 4
    assert telemetry.prune_history(df.withColumn("ts", F.col("ts") * 86_400), 9 * 86_400, 3).count() == 4


def test_zones(spark):
    zones = ((0.0, 10.0, "green"), (10.0, 20.0, "orange"), (20.0, 30.0, "red"))
    values = [(None, "grey"), (-1.0, "grey"), (0.0, "green"), (10.0, "orange"), (20.0, "red"), (30.0, "red"), (30.1, "grey")]
    df = spark.createDataFrame(values, "v double, want string")
    for row in df.select("want", severity.zone_severity(F.col("v"), zones).alias("got")).collect():
        assert row.got == row.want
    assert df.select(severity.zone_severity(F.col("v"), ()).alias("got")).distinct().collect()[0].got == "grey"


def test_severity_falls_back_to_the_status_and_worst_wins(spark):
    df = spark.createDataFrame(
        [("saturation.sentiment_backlog", "breach", 100.0), ("saturation.sentiment_backlog", "breach", None),
         ("other", "warn", 1.0), ("other", "skip", 1.0)],
        "check_name string, status string, value_num double",
    )
    rated = telemetry.severities(df)
    assert [row.severity for row in rated.collect()] == ["green", "red", "orange", "grey"]
    worst = {row.check_name: row.severity for row in telemetry.worst_by(rated, "check_name").collect()}
    assert worst == {"saturation.sentiment_backlog": "red", "other": "orange"}


def gate_by_hand(results):
    """Cycle by cycle, layer by layer, as a monitor would walk them."""
    previous = {"l1": False, "l2": False}
    out = {}
    for cycle in range(max(r[0] for r in results) + 1):
        live = dict(previous)
        current = {"l1": False, "l2": False}
        for layer in ("l1", "l2", "l3"):
            for _, check, own, status in [r for r in results if r[0] == cycle and r[2] == layer]:
                blocked = (layer == "l2" and live["l1"]) or (layer == "l3" and (live["l1"] or live["l2"]))
                final = "skip" if blocked else status
                out[(cycle, check)] = final
                if final in ("breach", "error") and layer in current:
                    current[layer] = live[layer] = True
        previous = current
    return out


def test_layer_gates_follow_the_walk(spark):
    chance = random.Random(11)
    results = [
        (cycle, f"{layer}-{n}", layer, chance.choice(["ok"] * 8 + ["warn", "breach", "error"]))
        for cycle in range(60)
        for layer in ("l1", "l2", "l3")
        for n in range(2)
    ]
    df = spark.createDataFrame(results, "cycle long, check_name string, layer string, status string")
    got = {(r.cycle, r.check_name): r.gated_status for r in telemetry.layer_gates(df).collect()}
    assert got == gate_by_hand(results)


def test_dependency_skips(spark):
    rows = [(1, "a", "breach"), (1, "b", "ok"), (2, "a", "ok"), (2, "b", "ok"), (3, "b", "ok")]
    df = spark.createDataFrame(rows, "cycle long, check_name string, status string")
    got = telemetry.dependency_skips(df, {"b": ["a"]}).collect()
    assert [(r.cycle, r.check_name) for r in got] == [(2, "b")]


def test_rolling_mean(spark):
    df = spark.createDataFrame(
        [(0, 1, "c", "ok", 4.0), (300, 2, "c", "ok", 8.0), (301, 3, "c", "ok", 3.0), (301, 4, "c", "ok", None)], HISTORY
    )
    got = {r.ts: (r.rolling_mean, r.samples, r.status) for r in telemetry.rolling_mean(df, low=7.0, high=7.5).collect()}
    assert got == {0: (4.0, 1, "ok"), 300: (6.0, 2, "ok"), 301: (5.5, 2, "ok")}
    steady = spark.createDataFrame([(n, n, "c", "ok", 5.0) for n in range(3)], HISTORY)
    assert [r.status for r in telemetry.rolling_mean(steady, low=6.0).orderBy("ts").collect()] == ["ok", "ok", "warn"]


def test_action_limit_counts_earlier_actions_of_the_same_second(spark):
    rows = [(0, 1, "t"), (0, 2, "t"), (0, 3, "t"), (0, 4, "t"), (300, 5, "t"), (301, 6, "t"), (301, 7, "u")]
    df = spark.createDataFrame(rows, "ts long, seq long, target string")
    got = {r.seq: (r.recent_actions, r.decision) for r in telemetry.limit_actions(df).collect()}
    assert got == {
        1: (0, "run"), 2: (1, "run"), 3: (2, "run"), 4: (3, "skipped_rate_limit"),
        5: (4, "skipped_rate_limit"), 6: (1, "run"), 7: (0, "run"),
    }


def verdicts_by_walk(results, dependencies):
    """Cycle by cycle, layer by layer; what is skipped did not fail."""
    before, out = {}, {}
    for cycle in range(max(r[0] for r in results) + 1):
        now = {}
        for layer in ("l1", "l2", "l3"):
            for _, check, own, status in [r for r in results if r[0] == cycle and r[2] == layer]:
                gated = any(low < layer for low in (*before.values(), *now.values()))
                if gated or any(dep in before for dep in dependencies.get(check, ())):
                    status = "skip"
                out[(cycle, check)] = status
                if status in ("breach", "error"):
                    now[check] = layer
        before = now
    return out


@pytest.mark.parametrize("failing", [1, 4])
def test_cycle_verdicts_follow_the_walk(spark, failing):
    chance = random.Random(failing)
    layers = {f"{layer}-{n}": layer for layer in ("l1", "l2", "l3") for n in range(3)}
    dependencies = {"l1-1": ["l1-0"], "l1-2": ["l1-1"], "l2-1": ["l2-0"], "l2-2": ["l2-1", "l1-2"], "l3-0": ["l3-1", "l2-2"]}
    words = ["ok"] * 12 + ["warn"] + ["breach", "error"] * failing
    results = [
        (cycle, check, layer, chance.choice(words))
        for cycle in range(150) if cycle % 40 != 7
        for check, layer in layers.items()
    ]
    df = spark.createDataFrame(results, "cycle long, check_name string, layer string, status string")
    got = {(r.cycle, r.check_name): r.verdict for r in telemetry.cycle_verdicts(df, layers, dependencies).collect()}
    assert got == verdicts_by_walk(results, dependencies)


def test_a_skipped_check_does_not_skip_those_that_depend_on_it(spark):
    layers, needs = {"a": "l1", "b": "l1", "c": "l1"}, {"a": ["b"], "b": ["c"]}
    rows = [(1, "a", "ok"), (1, "b", "ok"), (1, "c", "error"), (2, "b", "breach"), (3, "a", "breach"), (3, "b", "ok")]
    df = spark.createDataFrame([(n, c, layers[c], s) for n, c, s in rows], "cycle long, check_name string, layer string, status string")
    got = {(r.cycle, r.check_name): (r.verdict, r.reason) for r in telemetry.cycle_verdicts(df, layers, needs).collect()}
    assert got[(2, "b")] == ("skip", "dependency failed") and got[(3, "a")] == ("breach", None)
    nothing = telemetry.cycle_verdicts(df, layers, {})
    assert [r.verdict for r in nothing.collect()].count("skip") == 0
    with pytest.raises(ValueError, match="circle"):
        telemetry.cycle_verdicts(df, layers, {"a": ["b"], "b": ["a"]})
    with pytest.raises(ValueError, match="higher layer"):
        telemetry.cycle_verdicts(df, {"a": "l1", "b": "l2"}, {"a": ["b"]})


def test_monitors_prune_day_partitions(spark, tmp_path, rows):
    from driftlake.functions.clock import newest_day
    from driftlake.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    lake.ensure_all()
    posts = rows("core_posts", {"time_us": 1_704_100_000_000_000}).withColumn("event_time", F.timestamp_micros("time_us"))
    lake.append(TABLES["core_posts"], posts)
    lag = telemetry.stage_latency(lake, "post")
    plan = lag._jdf.queryExecution().executedPlan().toString()
    assert "ingested_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0] or "ingested_date#" in plan
    assert telemetry.input_rate(lake, at("12:00:00")).first().value_num == 0.0
    assert newest_day(lake["core_posts"], "event_time").count() == 1
    assert newest_day(lake["core_hashtags"], "event_time").count() == 0


def test_newest_rows_are_found_from_the_newest_days(spark, tmp_path, rows):
    from datetime import timedelta

    from driftlake.sources.lake import Lake

    lake = Lake(spark, str(tmp_path))
    lake.ensure_all()
    moments = [at("12:00:00") + timedelta(days=day, seconds=n) for day in range(30) for n in range(20)]
    likes = rows("core_engagement", *[
        {"event_type": "like" if n % 2 else "repost", "actor_did": "a", "time_us": n, "event_time": t, "ingested_at": t + timedelta(seconds=n % 7)}
        for n, t in enumerate(moments)])
    raw = rows("raw_events", *[{"did": "a", "time_us": n, "collection": "app.bsky.feed.like", "ingested_at": t} for n, t in enumerate(moments)])
    lake.append(TABLES["core_engagement"], likes)
    lake.append(TABLES["raw_events"], raw)
    newest = lake.newest_days("core_engagement", 25, F.col("event_type") == "like")
    assert newest.agg(F.countDistinct("event_date")).first()[0] == 5  # three are needed, probed by twos, and one more
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    whole = {name: lake[name] for name in TABLES}
    for count in (1, 25, 10_000):
        assert telemetry.stage_latency(lake, "like", count).first() == telemetry.stage_latency(whole, "like", count).first()


def test_cycle_summary(spark):
    rows = [(1, "a", "ok"), (1, "b", "breach"), (2, "a", "error"), (2, "b", "breach"), (3, "a", "skip")]
    df = spark.createDataFrame(rows, "cycle long, check_name string, status string")
    got = {r.cycle: (r.ok, r.breach, r.skip, r.breaches, r.errors, r.exit_code) for r in telemetry.cycle_summary(df).collect()}
    assert got == {1: (1, 1, 0, ["b"], [], 1), 2: (0, 1, 0, ["b"], ["a"], 2), 3: (0, 0, 1, [], [], 0)}


def test_thresholds(spark):
    rows = [("traffic.raw_input_rps", 49.0), ("traffic.raw_input_rps", 50.0), ("latency.pipeline.post", 60.5),
            ("table.small_file_ratio", 0.6), ("unknown", 1.0), ("latency.pipeline.post", None)]
    df = spark.createDataFrame(rows, "check_name string, value_num double")
    got = [r.status for r in telemetry.evaluate_thresholds(df).orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(got) == sorted(["breach", "ok", "breach", "warn", "ok", "ok"])


@pytest.fixture
def latency_tables(rows):
    raw = [{"did": "a", "time_us": n, "collection": "app.bsky.feed.like", "ingested_at": at("10:00:00")} for n in range(5)]
    raw += [{"did": "a", "time_us": 0, "collection": "app.bsky.feed.post", "ingested_at": at("09:00:00")}]
    done = [{"event_type": "like", "actor_did": "a", "time_us": n, "ingested_at": at(f"10:00:0{n}.5")} for n in range(5)]
    done += [{"event_type": "repost", "actor_did": "a", "time_us": 0, "ingested_at": at("10:00:09")}]
    given = {name: rows(name) for name in TABLES}
    return {**given, "raw_events": rows("raw_events", *raw), "core_engagement": rows("core_engagement", *done)}


def test_stage_latency(latency_tables):
    row = telemetry.stage_latency(latency_tables, "like").first()
    assert (row.matched, row.value_num) == (5, 2.5)
    newest = telemetry.stage_latency(latency_tables, "like", newest=2).first()
    assert (newest.matched, newest.value_num) == (2, 4.0)
    empty = telemetry.stage_latency(latency_tables, "follow").first()
    assert (empty.matched, empty.value_num) == (0, None)


def test_latency_scan_is_bounded_by_the_recent_rows(spark, latency_tables, tmp_path):
    latency_tables["raw_events"].write.parquet(str(tmp_path / "raw"))
    given = {**latency_tables, "raw_events": spark.read.parquet(str(tmp_path / "raw"))}
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = telemetry.stage_latency(given, "like", newest=2)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(time_us,ScalarSubquery" in plan
    since = telemetry.stage_latency(given, "like", since=F.lit(at("10:00:04"))).first()
    assert (since.matched, since.value_num) == (1, 4.5)


def test_backlog_and_rates(rows):
    posts = [{"did": "a", "time_us": n, "ingested_at": at(f"10:00:{n:02d}")} for n in range(10)]
    scores = [{"did": "a", "time_us": n, "ingested_at": at(f"10:00:{n + 3:02d}")} for n in range(7)]
    given = {"core_posts": rows("core_posts", *posts), "core_post_sentiment": rows("core_post_sentiment", *scores),
             "raw_events": rows("raw_events", *[{"ingested_at": at(f"10:00:{n:02d}")} for n in range(20)])}
    assert telemetry.sentiment_backlog(given).first().asDict() == {"total": 10, "unmatched": 3}
    assert telemetry.sentiment_backlog(given, at("10:00:05")).first().unmatched == 7
    assert telemetry.sentiment_backlog(given, newest=4).first().asDict() == {"total": 4, "unmatched": 3}
    assert telemetry.input_rate(given, at("10:00:19")).first().value_num == 1.1
    assert telemetry.sentiment_lag(given).first().value_num == 3.0
