import random

from pyspark.sql import functions as F

from driftlake.functions.severity import zone_severity
from driftlake.operators import telemetry
from driftlake.operators.zones import ZONE_SCHEMA, zone_pieces, zone_severities, zone_table


def plain(zones, check, value):
    own = sorted((place, low, high, severity) for name, low, high, severity, place in zones if name == check)
    for n, (_, low, high, severity) in enumerate(own):
        if value is not None and low <= value and (value < high or (n == len(own) - 1 and value == high)):
            return severity
    return "grey"


def results(spark, checks, values):
    rows = [(n, check, value) for n, (check, value) in enumerate((c, v) for c in checks for v in values)]
    return rows, spark.createDataFrame(rows, "seq long, check_name string, value_num double")


def test_zones_that_overlap_and_leave_gaps(spark):
    draw = random.Random(1)
    zones = []
    for check in ("a", "b", "c"):
        for place in range(40):
            low = draw.randrange(0, 100)
            zones.append((check, float(low), float(low + draw.choice([0, 1, 5, 30])), draw.choice(["red", "green", "orange"]), place))
    zones.append(("one", 0.0, 1.0, "red", 0))
    rows, df = results(spark, ["a", "b", "c", "one", "unknown", None], [None, -1.0, 1e9, *(n / 2 for n in range(-2, 270))])
    got = {row.seq: row.severity for row in zone_severities(df, spark.createDataFrame(zones, ZONE_SCHEMA)).collect()}
    assert got == {seq: plain(zones, check, value) for seq, check, value in rows}


def test_the_table_equals_the_chain_of_conditions(spark):
    values = [None, -1.0, 0.0, 14.9, 15.0, 60.0, 86400.0, 86400.1, 100.0, 200.0, 1e6, 500.0, 1000.0]
    rows, df = results(spark, [*telemetry.ZONES, "none"], values)
    got = {row.seq: row.severity for row in zone_severities(df, zone_table(spark, telemetry.ZONES)).collect()}
    for name, zones in telemetry.ZONES.items():
        own = df.filter(F.col("check_name") == name).select("seq", zone_severity(F.col("value_num"), zones).alias("s"))
        assert {row.seq: row.s for row in own.collect()}.items() <= got.items()
    assert {got[seq] for seq, check, _ in rows if check == "none"} == {"grey"}


def test_many_zones_make_few_pieces_a_bin(spark):
    zones = [("a", float(n), float(n + 1), str(n % 7), n) for n in range(3000)]
    table = spark.createDataFrame(zones, ZONE_SCHEMA)
    assert zone_pieces(table).count() == 3001
    _, df = results(spark, ["a"], [n + 0.5 for n in range(3000)])
    found = zone_severities(df, table)
    assert all(row.severity == str(int(row.value_num) % 7) for row in found.collect())
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert zone_severities(df.limit(0), table).count() == 0 and {r.severity for r in zone_severities(df, table.limit(0)).collect()} == {"grey"}
