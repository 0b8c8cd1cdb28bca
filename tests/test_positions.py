import random

from pyspark.sql import functions as F

from driftlake.operators.positions import running_totals, trailing_totals
from conftest import at
from datetime import timedelta


def skewed(spark, rows=3000, seed=7):
    """One key holds two thirds of the rows, many of them in the same second."""
    chance = random.Random(seed)
    data = [
        ("hot" if chance.random() < 0.66 else f"k{chance.randrange(20)}", chance.randrange(400), n, chance.randrange(4))
        for n in range(rows)
    ]
    return data, spark.createDataFrame(data, "k string, ts long, seq long, v int").repartition(7)


def test_trailing_totals_equal_brute_force(spark):
    data, df = skewed(spark)
    seconds = df.groupBy("k", "ts").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    got = trailing_totals(seconds, ["k"], "ts", ["v", "n"], 30)
    for row in got.collect():
        inside = [r[3] for r in data if r[0] == row.k and row.ts - 30 <= r[1] <= row.ts]
        assert (row.trailing_v, row.trailing_n) == (sum(inside), len(inside))


def test_running_total_over_years(spark):
    start = at("00:00:00")
    steps = [(start + timedelta(hours=11 * n), n % 5) for n in range(1500)]
    df = spark.createDataFrame(steps, "t timestamp, n long")
    got = [row.total for row in running_totals(df, "t", {"n": "total"}).orderBy("t").collect()]
    total, expected = 0, []
    for _, amount in steps:
        total += amount
        expected.append(total)
    assert got == expected
