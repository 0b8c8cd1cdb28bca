"""Value rules measured while rows flow: no second scan, one result per rule and micro-batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PREFIX = "rules:"
SCHEMA = "query_id string, batch_id long, rule string, rows_checked long, violations long"


def observe_rules(rows: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """``rows`` unchanged; each rule's violations are counted as they pass.

    A rule is a condition that valid rows meet; NULL counts as a violation, as in
    ``operators.quality.validity``.
    """
    counts = [F.count_if(~F.coalesce(valid, F.lit(False))).alias(rule) for rule, valid in rules.items()]
    return rows.observe(f"{PREFIX}{table}", F.count(F.lit(1)).alias("rows_checked"), *counts)


def measured(progress: Mapping) -> list[tuple]:
    """The rows of ``SCHEMA`` in one progress report of a query."""
    found = []
    for name, metrics in (progress.get("observedMetrics") or {}).items():
        if name.startswith(PREFIX):
            values = metrics if isinstance(metrics, dict) else metrics.asDict()
            rows = values.pop("rows_checked")
            table = name.removeprefix(PREFIX)
            found += [(progress["id"], progress["batchId"], f"{table}.{rule}", rows, bad) for rule, bad in values.items()]
    return found


class RuleLog(StreamingQueryListener):
    """Appends what the session's streams measure to a table of results; add it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        rows = measured({"id": str(progress.id), "batchId": progress.batchId, "observedMetrics": metrics})
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...


def rule_totals(log: DataFrame) -> DataFrame:
    """Rows and violations per rule over all batches; a batch that ran again counts once."""
    once = log.groupBy("query_id", "batch_id", "rule").agg(
        F.max("rows_checked").alias("rows_checked"), F.max("violations").alias("violations")
    )
    return once.groupBy("rule").agg(
        F.sum("rows_checked").alias("rows_checked"), F.sum("violations").alias("violations")
    )
