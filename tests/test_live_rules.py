"""Live rules beside the batch rules over the same rows, in any micro-batches, also after a restart."""

import random

import pytest
from pyspark.sql import functions as F

from driftlake.operators import telemetry
from driftlake.streaming import rules

SCHEMA = "check_name string, ts long, seq long, status string"


def history(rows=600, seed=1):
    chance = random.Random(seed)
    data, second = [], 1_704_067_200
    for n in range(rows):
        second += chance.choice([0, 0, 1, 2, 5])
        key = "hot" if chance.random() < 0.6 else f"k{chance.randrange(4)}"
        data.append((key, second, n, chance.choice(["ok", "ok", "breach", "breach", "error", "warn"])))
    return data


def drain(spark, build, schema, root):
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    build(rows).writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp"
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


def land(spark, rows, schema, root, parts):
    """Files in turn, each a mix of neighbouring seconds."""
    size = -(-len(rows) // parts)
    for start in range(0, len(rows), size):
        spark.createDataFrame(rows[start : start + size], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")


@pytest.mark.parametrize("tolerance", [2, {"hot": 3, "k1": 1}])
def test_live_events_equal_the_batch_rules_also_after_a_restart(spark, tmp_path, tolerance):
    data = history()
    shuffled = random.Random(2)
    jumbled = sorted(data, key=lambda row: row[1] + shuffled.random() * 20)  # up to 20 seconds late
    build = lambda rows: rules.live_check_events(rows, tolerance, "30 seconds")
    land(spark, jumbled[:350], SCHEMA, tmp_path, 3)
    first = drain(spark, build, SCHEMA, tmp_path).count()
    land(spark, jumbled[350:], SCHEMA, tmp_path, 3)
    got = drain(spark, build, SCHEMA, tmp_path)
    assert 0 < first < got.count()
    batch = spark.createDataFrame(data, SCHEMA)
    closed = max(row[1] for row in data) - 30
    alerts = {(r.check_name, r.ts, r.seq) for r in telemetry.breach_alerts(batch, tolerance).collect() if r.ts <= closed}
    back = {(r.check_name, r.ts, r.seq, r.previous_status) for r in telemetry.recoveries(batch).collect() if r.ts <= closed}
    rows = got.collect()
    assert sorted((r.check_name, r.ts, r.seq) for r in rows if r.event == "alert") == sorted(alerts)
    assert sorted((r.check_name, r.ts, r.seq, r.previous_status) for r in rows if r.event == "recovery") == sorted(back)


def test_live_limits_equal_the_batch_rule_also_after_a_restart(spark, tmp_path):
    schema = "target string, ts long, seq long, action string"
    data = [(key, ts, seq, "heal") for key, ts, seq, _ in history(400, 5)]
    build = lambda rows: rules.live_action_limits(rows, 3, 20, "10 seconds")
    land(spark, data[:200], schema, tmp_path, 2)
    drain(spark, build, schema, tmp_path)
    land(spark, data[200:], schema, tmp_path, 2)
    got = drain(spark, build, schema, tmp_path).collect()
    batch = telemetry.limit_actions(spark.createDataFrame(data, schema), 3, 20)
    closed = max(row[1] for row in data) - 10
    want = [(r.target, r.ts, r.seq, r.recent_actions, r.decision) for r in batch.filter(F.col("ts") <= closed).collect()]
    assert sorted((r.target, r.ts, r.seq, r.recent_actions, r.decision) for r in got) == sorted(want)


def test_live_means_equal_plain_windows(spark, tmp_path):
    schema = "check_name string, ts long, value_num double"
    data = [(key, ts, None if seq % 9 == 0 else float(seq % 40)) for key, ts, seq, _ in history(500, 8)]
    build = lambda rows: rules.live_rolling_mean(rows, 300, 60, 15.0, 25.0, "30 seconds")
    land(spark, data, schema, tmp_path, 3)
    got = {(r.check_name, int(r.window_end.timestamp())): r for r in drain(spark, build, schema, tmp_path).collect()}
    closed = max(ts for _, ts, value in data if value is not None) - 30
    windows = {}
    for key, ts, value in data:
        for end in range(ts - ts % 60 + 60, ts - ts % 60 + 301, 60):
            if value is not None and end <= closed:
                windows.setdefault((key, end), []).append(value)
    assert set(got) == set(windows)
    for place, values in windows.items():
        mean = sum(values) / len(values)
        status = "breach" if mean > 25 else "warn" if mean < 15 and len(values) >= 3 else "ok"
        assert (abs(got[place].rolling_mean - mean) < 1e-9, got[place].samples, got[place].status) == (True, len(values), status)
