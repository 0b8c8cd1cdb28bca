import time

from conftest import at
from pyspark.sql import functions as F

from driftlake.operators import quality
from driftlake.schemas import KINDS, TABLES
from driftlake.streaming import observed


def test_totals_over_batches_equal_the_batch_rule(spark, tmp_path, rows):
    for kinds in (["commit", "nonsense"], ["account"], ["commit", "commit", "other"]):
        rows("raw_events", *[{"kind": kind} for kind in kinds]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TABLES["raw_events"].schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    watched = observed.observe_rules(stream, "raw_events", {"kind_whitelist": F.col("kind").isin(*KINDS), "stamped": F.col("ingested_at").isNotNull()})
    log = observed.RuleLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        query = watched.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start()
        query.awaitTermination()
        for _ in range(100):  # listeners are told a little later
            if (tmp_path / "log").exists() and spark.read.schema(observed.SCHEMA).parquet(str(tmp_path / "log")).count() >= 6:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    got = {r.rule: (r.rows_checked, r.violations) for r in observed.rule_totals(spark.read.parquet(str(tmp_path / "log"))).collect()}
    given = {name: rows(name) for name in TABLES} | {"raw_events": spark.read.parquet(str(tmp_path / "in"))}
    batch = {r.rule: (r.rows_checked, r.violations) for r in quality.validity(given, at("12:00:00")).collect()}
    assert got["raw_events.kind_whitelist"] == batch["raw_events.kind_whitelist"] == (6, 2)
    assert got["raw_events.stamped"] == (6, 0)
    # Reports of a batch that ran twice count once, and reports are there without a listener too.
    again = [row for progress in query.recentProgress for row in observed.measured(progress)] * 2
    assert {r.rule: r.violations for r in observed.rule_totals(spark.createDataFrame(again, observed.SCHEMA)).collect()}["raw_events.kind_whitelist"] == 2
