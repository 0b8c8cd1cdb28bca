import random

from pyspark.sql import functions as F

from driftlake.operators import telemetry
from driftlake.operators.segments import with_previous, with_runs


def skewed(spark, rows=2500, seed=3, failing=0.5):
    """One key holds two thirds of the rows, many in the same second, with runs over many slices."""
    chance = random.Random(seed)
    data, second = [], 0
    for n in range(rows):
        second += chance.choice([0, 0, 1, 3, 60 if chance.random() < 0.02 else 0])
        key = None if chance.random() < 0.03 else "hot" if chance.random() < 0.66 else f"k{chance.randrange(8)}"
        data.append((key, second, n, chance.choices(["ok", "breach", "error", "warn", None], [1 - failing, failing, failing / 3, 0.1, 0.05])[0]))
    return data, spark.createDataFrame(data, "check_name string, ts long, seq long, status string").repartition(7)


def by_key(data):
    keys = {}
    for row in sorted(data, key=lambda row: (row[1], row[2])):
        keys.setdefault(row[0], []).append(row)
    return keys


def test_runs_and_positions_equal_a_walk(spark):
    for seed, failing, slice_s in ((3, 0.5, 10), (4, 0.97, 7), (5, 0.03, 500)):
        data, df = skewed(spark, 1500, seed, failing)
        got = {
            row.seq: (row.position, row.run)
            for row in with_runs(df, ["check_name"], ["ts", "seq"], F.col("status").isin("breach", "error"), slice_s).collect()
        }
        want = {}
        for rows in by_key(data).values():
            run = 0
            for place, (_, _, seq, status) in enumerate(rows, 1):
                run = run + 1 if status in ("breach", "error") else 0
                want[seq] = (place, run)
        assert got == want


def test_previous_values_equal_a_walk(spark):
    data, df = skewed(spark, 1500, 6)
    got = {row.seq: row.before for row in with_previous(df, ["check_name"], ["ts", "seq"], "status", "before", 5).collect()}
    want = {}
    for rows in by_key(data).values():
        want |= {row[2]: before for row, before in zip(rows, [None, *(row[3] for row in rows)])}
    assert got == want


def test_rules_need_no_job_and_no_copy_of_the_history(spark):
    _, df = skewed(spark, 50)
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        built = [
            telemetry.breach_alerts(df),
            telemetry.recoveries(df),
            telemetry.limit_actions(df.withColumnRenamed("check_name", "target")),
        ]
        assert not tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all("ExistingRDD" in plan and "Checkpoint" not in plan for plan in (b._jdf.queryExecution().toString() for b in built))


def test_rules_of_an_empty_history(spark):
    _, df = skewed(spark, 1)
    none = df.limit(0)
    assert telemetry.breach_alerts(none).count() == telemetry.recoveries(none).count() == 0
