"""Pipeline telemetry: lag, throughput and backlog over the lake, and the history of checks.

Histories are rows of ``schemas.CHECK_RESULTS`` plus ``seq``, which orders the results of
one second.  One check may own most of a history, so nothing here gathers a check's whole
history in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.functions import severity
from driftlake.functions.clock import Clock, ago, clock, micros_to_timestamp, seconds_between, time_range
from driftlake.functions.severity import Zone
from driftlake.operators.positions import trailing_totals
from driftlake.operators.segments import SLICE_S, with_previous, with_runs
from driftlake.schemas import LIKE, POST, REPOST, ROUTES

# Rules of the monitor.
NEWEST_ROWS = 1000
ALERT_TOLERANCE = 2
RETAIN_DAYS = 30
ACTION_LIMIT = 3
ACTION_WINDOW_S = 300
ROLLING_WINDOW_S = 300
ROLLING_MIN_SAMPLES = 3
TRIGGERS = ("breach", "error")
LAYERS = ("l1", "l2", "l3")
# Reasons as the monitor words them.
L1_GATE = "layer gate: L1 breached"
L2_GATE = "layer gate: L1/L2 breached"

# Limit of each metric and what lies beyond it.
THRESHOLDS: tuple[tuple[str, str, float, str], ...] = (
    ("traffic.raw_input_rps", "min", 50.0, "breach"),
    ("latency.pipeline.post", "max", 60.0, "breach"),
    ("latency.pipeline.like", "max", 10.0, "breach"),
    ("latency.pipeline.repost", "max", 10.0, "breach"),
    ("latency.pipeline.follow", "max", 10.0, "breach"),
    ("latency.pipeline.block", "max", 10.0, "breach"),
    ("latency.pipeline.profile", "max", 10.0, "breach"),
    ("latency.sentiment.lag", "max", 60.0, "breach"),
    ("traffic.sentiment_rps", "min", 5.0, "breach"),
    ("saturation.sentiment_backlog", "max", 500.0, "breach"),
    ("quality.raw_events.freshness_s", "max", 15.0, "breach"),
    ("quality.raw_events.null_did_rate", "max", 0.001, "breach"),
    ("quality.mart_trending_hashtags.freshness_s", "max", 120.0, "breach"),
    ("table.file_count", "max", 5000.0, "breach"),
    ("table.avg_file_kb", "min", 32.0, "warn"),
    ("table.small_file_ratio", "max", 0.50, "warn"),
)

# Severity zones of each metric.
LAG_ZONES: tuple[Zone, ...] = ((0.0, 15.0, "green"), (15.0, 60.0, "orange"), (60.0, 86400.0, "red"))
ZONES: dict[str, tuple[Zone, ...]] = {
    "traffic.raw_input_rps": ((0.0, 100.0, "red"), (100.0, 200.0, "orange"), (200.0, 1_000_000.0, "green")),
    "traffic.sentiment_rps": ((0.0, 5.0, "red"), (5.0, 20.0, "orange"), (20.0, 10_000.0, "green")),
    "saturation.sentiment_backlog": ((0.0, 200.0, "green"), (200.0, 500.0, "orange"), (500.0, 1000.0, "red")),
    "latency.sentiment.lag": LAG_ZONES,
    **{f"latency.pipeline.{stage}": LAG_ZONES for stage in ("post", "like", "repost", "follow", "block", "profile")},
}


@dataclass(frozen=True)
class Stage:
    """Where events of one record type end up."""

    collection: str
    table: str
    did: str = "did"
    event_type: str | None = None


def _stage(collection: str, staged: str) -> Stage:
    """Likes and reposts end in one table, posts in their core table, the rest where they are staged."""
    kind = collection.rpartition(".")[2]
    if collection in (LIKE, REPOST):
        return Stage(collection, "core_engagement", "actor_did", kind)
    return Stage(collection, "core_posts" if collection == POST else staged)


STAGES: dict[str, Stage] = {
    collection.rpartition(".")[2]: _stage(collection, staged) for collection, staged in ROUTES.items()
}


# -- metrics over the lake -------------------------------------------------------------
def _rate(df: DataFrame, as_of: Clock, seconds: int, name: str) -> DataFrame:
    recent = time_range(df, "ingested_at", ago(as_of, seconds=seconds))
    return recent.agg((F.count(F.lit(1)) / F.lit(float(seconds))).alias("value_num")).select(
        F.lit(name).alias("check_name"), "value_num"
    )


def input_rate(tables: Mapping[str, DataFrame], as_of: Clock = None) -> DataFrame:
    """Raw rows per second over the last ten seconds."""
    return _rate(tables["raw_events"], as_of, 10, "traffic.raw_input_rps")


def sentiment_rate(tables: Mapping[str, DataFrame], as_of: Clock = None) -> DataFrame:
    """Scored rows per second over the last minute."""
    return _rate(tables["core_post_sentiment"], as_of, 60, "traffic.sentiment_rps")


def _newest(
    tables: Mapping[str, DataFrame], name: str, rows: int, since: Column | None, wanted: Column | None = None,
    did: str = "did",
) -> DataFrame:
    """The newest arrivals of a table as ``(did, time_us, ingested_at)``; ties by key.

    Only the newest days that hold enough rows are sorted, where the tables can tell them
    (``Lake.newest_days``); ``since`` spares the scan of what arrived earlier.
    """
    table = tables[name] if wanted is None else tables[name].filter(wanted)
    if since is not None:
        table = table.filter(F.col("ingested_at") >= since)
    elif hasattr(tables, "newest_days"):
        table = tables.newest_days(name, rows, wanted)
    arrivals = table.select(F.col(did).alias("did"), "time_us", "ingested_at")
    return arrivals.orderBy(F.desc("ingested_at"), "did", "time_us").limit(rows)


def _from_oldest_of(table: DataFrame, recent: DataFrame) -> DataFrame:
    """The part of a table that can match the recent rows.

    Their oldest ``time_us`` becomes a scalar in the scan's pushed filters, so row groups
    from before it are skipped instead of joined.  Day partitions are pruned by it as well:
    an event's day is that of its ``time_us``, and it arrives that day or later (a day is
    left for clocks that disagree).
    """
    oldest = recent.agg(F.min("time_us")).scalar()
    table = table.filter(F.col("time_us") >= oldest)
    day = F.to_date(micros_to_timestamp(oldest))
    if "event_date" in table.columns:
        table = table.filter(F.col("event_date") >= day)
    if "ingested_date" in table.columns:
        table = table.filter(F.col("ingested_date") >= F.date_sub(day, 1))
    return table


def _lag(recent: DataFrame, upstream: DataFrame, name: str) -> DataFrame:
    """Average delay of the recent rows behind their upstream rows.

    ``recent`` holds at most the asked number of rows of three columns.  Spark knows that
    from the limit and chooses the join by it; the upstream table is filtered in place.
    """
    arrived = _from_oldest_of(upstream, recent).select(
        "did", "time_us", F.col("ingested_at").alias("_upstream_at")
    )
    joined = arrived.join(recent, ["did", "time_us"])
    return joined.agg(
        F.count(F.lit(1)).alias("matched"),
        F.avg(seconds_between(F.col("ingested_at"), F.col("_upstream_at"))).alias("value_num"),
    ).select(F.lit(name).alias("check_name"), "matched", "value_num")


def stage_latency(
    tables: Mapping[str, DataFrame], stage: str, newest: int = NEWEST_ROWS, since: Column | None = None
) -> DataFrame:
    """Average delay from the raw row to the end table, over the end table's newest rows."""
    spec = STAGES[stage]
    wanted = F.col("event_type") == spec.event_type if spec.event_type else None
    recent = _newest(tables, spec.table, newest, since, wanted, spec.did)
    raw = tables["raw_events"].filter(F.col("collection") == spec.collection)
    return _lag(recent, raw, f"latency.pipeline.{stage}")


def sentiment_lag(
    tables: Mapping[str, DataFrame], newest: int = NEWEST_ROWS, since: Column | None = None
) -> DataFrame:
    """Average delay from a post's row to its score, over the newest scores."""
    scored = _newest(tables, "core_post_sentiment", newest, since)
    return _lag(scored, tables["core_posts"], "latency.sentiment.lag")


def sentiment_backlog(
    tables: Mapping[str, DataFrame], as_of: Clock = None, newest: int = NEWEST_ROWS, since: Column | None = None
) -> DataFrame:
    """How many of the newest posts have no score yet.

    A score counts once it has arrived by ``as_of``.  The scored side is first cut down to
    the few wanted keys, so the large table is scanned once and not shuffled.
    """
    recent = _newest(tables, "core_posts", newest, since).select("did", "time_us")
    scored = tables["core_post_sentiment"]
    if as_of is not None:
        scored = scored.filter(F.col("ingested_at") <= clock(as_of))
    wanted = _from_oldest_of(scored, recent).select("did", "time_us")
    keys = wanted.join(recent, ["did", "time_us"], "left_semi").distinct()
    joined = recent.join(keys.withColumn("_scored", F.lit(1)), ["did", "time_us"], "left")
    return joined.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("_scored").isNull()).alias("unmatched")
    )


# -- verdicts --------------------------------------------------------------------------
def evaluate_thresholds(
    metrics: DataFrame, thresholds: Sequence[tuple[str, str, float, str]] = THRESHOLDS
) -> DataFrame:
    """Status of each ``(check_name, value_num)``; a missing value or limit is ok."""
    limits = metrics.sparkSession.createDataFrame(
        list(thresholds), "check_name string, bound string, limit_num double, beyond string"
    )
    # A handful of fixed rows.
    joined = metrics.join(F.broadcast(limits), "check_name", "left")
    over = ((F.col("bound") == "max") & (F.col("value_num") > F.col("limit_num"))) | (
        (F.col("bound") == "min") & (F.col("value_num") < F.col("limit_num"))
    )
    status = F.when(over, F.col("beyond")).otherwise("ok")
    return joined.select(*metrics.columns, "bound", "limit_num", status.alias("status"))


def severities(results: DataFrame, zones: Mapping[str, Sequence[Zone]] = ZONES) -> DataFrame:
    """Severity by zone where the check has zones and a value, else by status."""
    by_zone = F.lit(None).cast("string")
    for name, check_zones in zones.items():
        by_zone = F.when(
            F.col("check_name") == name, severity.zone_severity(F.col("value_num"), check_zones)
        ).otherwise(by_zone)
    chosen = F.when(F.col("value_num").isNotNull() & by_zone.isNotNull(), by_zone).otherwise(
        severity.status_severity(F.col("status"))
    )
    return results.withColumn("severity", chosen)


def worst_by(results: DataFrame, *keys: str) -> DataFrame:
    """Worst severity per group."""
    return results.groupBy(*keys).agg(severity.worst_severity(F.col("severity")).alias("severity"))


# -- history ---------------------------------------------------------------------------
def latest_results(history: DataFrame) -> DataFrame:
    """Each check's newest results, ties kept.

    The newest second per check is an aggregate; joining it back on check and second reads
    the history without gathering any check in one place.
    """
    newest = history.groupBy("check_name").agg(F.max("ts").alias("ts"))
    return history.join(newest, ["check_name", "ts"], "left_semi")


def recent_history(history: DataFrame, as_of_ts: int | Column, window_s: int) -> DataFrame:
    """Results of the last ``window_s`` seconds."""
    floor = (F.lit(as_of_ts) if isinstance(as_of_ts, int) else as_of_ts) - F.lit(window_s)
    return history.filter(F.col("ts") >= floor)


def _floors(history: DataFrame, width_s: int, count: int) -> DataFrame:
    """Per check, where the ``width_s`` seconds begin that hold its ``count``-th newest result.

    Results are counted per span before any check meets its other spans.
    """
    spans = history.groupBy("check_name", (F.col("ts") - F.pmod("ts", F.lit(width_s))).alias("_floor")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    newer = Window.partitionBy("check_name").orderBy(F.desc("_floor")).rowsBetween(Window.unboundedPreceding, -1)
    reached = spans.withColumn("_newer", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
    return reached.filter(F.col("_newer") < count).groupBy("check_name").agg(F.min("_floor").alias("_floor"))


def _above(history: DataFrame, floors: DataFrame) -> DataFrame:
    return history.join(floors, "check_name").filter(F.col("ts") >= F.col("_floor")).select(*history.columns)


def last_results(history: DataFrame, count: int) -> DataFrame:
    """Each check's last ``count`` results, ``recency`` 1 being the newest.

    Counts per day, then per second of what is left, say from when on a check's rows can
    be among them.  Only those are ordered: ``count`` rows and the rest of one second.
    """
    recent = _above(history, _floors(history, 86_400, count))
    recent = _above(recent, _floors(recent, 1, count))
    order = Window.partitionBy("check_name").orderBy(F.desc("ts"), F.desc("seq"))
    ranked = recent.select(*history.columns, F.row_number().over(order).alias("recency"))
    return ranked.filter(F.col("recency") <= count)


def prune_history(history: DataFrame, as_of_ts: int | Column, retain_days: int = RETAIN_DAYS) -> DataFrame:
    """Results no older than ``retain_days``."""
    return recent_history(history, as_of_ts, retain_days * 86_400)


def _is_trigger(column: str = "status") -> Column:
    return F.col(column).isin(*TRIGGERS)


def breach_alerts(
    history: DataFrame, tolerance: int | Mapping[str, int] = ALERT_TOLERANCE, slice_s: int = SLICE_S
) -> DataFrame:
    """Results at which a run of breaches or errors reaches the check's tolerance.

    One alert per run: a result alerts when the run up to it is exactly as long as the
    tolerance.  ``position`` is the result's number among the check's results.
    """
    if isinstance(tolerance, int):
        wanted = F.lit(tolerance)
    else:
        wanted = F.lit(ALERT_TOLERANCE)
        for name, rows in tolerance.items():
            wanted = F.when(F.col("check_name") == name, rows).otherwise(wanted)
    runs = with_runs(history, ["check_name"], ["ts", "seq"], _is_trigger(), slice_s)
    return runs.filter((F.col("run") == wanted) & (F.col("run") > 0)).drop("run")


def recoveries(history: DataFrame, slice_s: int = SLICE_S) -> DataFrame:
    """Results that are ok right after a breach or error."""
    viewed = with_previous(history, ["check_name"], ["ts", "seq"], "status", "previous_status", slice_s)
    return viewed.filter((F.col("status") == "ok") & _is_trigger("previous_status"))


def _fold_cycles(cycles: DataFrame, own: Column, after: Column) -> DataFrame:
    """Spread each cycle's flags over itself and the next cycle, and fold them per cycle."""
    spread = cycles.select(F.inline(F.array(own, after)))
    return spread.groupBy("cycle").agg(F.max("l1").alias("l1"), F.max("l2").alias("l2"))


def layer_gates(results: DataFrame) -> DataFrame:
    """Gate each cycle's results by the layers below.

    ``results`` has ``cycle`` (consecutive numbers), ``check_name``, ``layer`` (l1, l2, l3)
    and ``status``.  A layer-2 result becomes ``skip`` when layer 1 failed in this cycle or
    the one before, a layer-3 result when layer 1 or 2 did; a skipped failure is no failure.
    Layer 1 is never gated, so its failures decide layer 2's, and both decide layer 3's.
    Failures fold to one row per cycle before any cycle meets its neighbour.
    """
    none = F.lit(False)
    following = (F.col("cycle") + 1).alias("cycle")
    failed = results.filter(_is_trigger() & F.col("layer").isin("l1", "l2"))
    cycles = failed.groupBy("cycle").agg(
        F.max(F.col("layer") == "l1").alias("l1"), F.max(F.col("layer") == "l2").alias("l2")
    )
    # A layer-1 failure gates its own cycle and the next; so does a layer-2 failure that ran.
    first = _fold_cycles(cycles, F.struct("cycle", "l1", "l2"), F.struct(following, "l1", none.alias("l2")))
    ran = first.select("cycle", "l1", (F.col("l2") & ~F.col("l1")).alias("l2"))
    gates = _fold_cycles(ran, F.struct("cycle", "l1", "l2"), F.struct(following, none.alias("l1"), "l2"))
    joined = results.join(gates, "cycle", "left")
    reason = F.when((F.col("layer") == "l2") & F.col("l1"), L1_GATE).when(
        (F.col("layer") == "l3") & (F.col("l1") | F.col("l2")), L2_GATE
    )
    return joined.select(
        *results.columns,
        reason.alias("gate_reason"),
        F.when(reason.isNotNull(), "skip").otherwise(F.col("status")).alias("gated_status"),
    )


def dependency_skips(results: DataFrame, dependencies: Mapping[str, Sequence[str]]) -> DataFrame:
    """Results to skip because a check they depend on failed in the cycle before.

    ``status`` is taken as recorded: a check recorded as ``skip`` did not fail.  Where raw
    statuses are at hand, ``cycle_verdicts`` also applies the gates and follows chains.
    """
    pairs = [(name, dep) for name, deps in dependencies.items() for dep in deps]
    wanted = results.sparkSession.createDataFrame(pairs, "dependency_of string, check_name string")
    failed = results.filter(_is_trigger()).select("cycle", "check_name").distinct()
    skipped = (
        failed.join(F.broadcast(wanted), "check_name")
        .select((F.col("cycle") + 1).alias("cycle"), F.col("dependency_of").alias("check_name"))
        .distinct()
    )
    return results.join(skipped, ["cycle", "check_name"], "left_semi")


def _reach(layers: Mapping[str, str], dependencies: Mapping[str, Sequence[str]]) -> int:
    """How many cycles back a verdict can depend on; dependencies must not lead in circles."""

    def depth(name: str, path: tuple[str, ...] = ()) -> int:
        if name in path:
            raise ValueError(f"dependencies lead in a circle: {' > '.join((*path, name))}")
        return 1 + max((depth(dep, (*path, name)) for dep in dependencies.get(name, ())), default=0)

    for name, deps in dependencies.items():
        for dep in deps:
            if layers[dep] > layers[name]:
                raise ValueError(f"{name} depends on {dep}, which is in a higher layer and gated by it")
    longest = max((depth(name) for name in dependencies), default=1)
    return longest * len(LAYERS)


def cycle_verdicts(
    results: DataFrame, layers: Mapping[str, str], dependencies: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Status of each result after layer gates and dependencies, and why it is skipped.

    ``results`` has ``cycle`` (consecutive numbers), ``check_name``, ``layer`` and raw
    ``status``.  A check is skipped when a layer below failed in this cycle or the one
    before; else when one it depends on failed in the cycle before.  What is skipped did
    not fail, for gates and dependencies alike, so a verdict rests on earlier verdicts: as
    many cycles back as there are layers times links in the longest chain.  Failing check
    names (a set per cycle) are sent that many cycles ahead and walked there; results meet
    them by one join on the cycle.
    """
    back = _reach(layers, dependencies)
    failed = results.filter(_is_trigger()).groupBy("cycle").agg(
        F.array_sort(F.collect_set(F.struct("layer", "check_name"))).alias("failed")
    )
    ahead = failed.select(F.explode(F.sequence(F.lit(0), F.lit(back))).alias("ago"), "cycle", "failed")
    seen = ahead.groupBy((F.col("cycle") + F.col("ago")).alias("cycle")).agg(
        F.map_from_entries(F.collect_list(F.struct("ago", "failed"))).alias("by_ago")
    )
    none = F.expr("CAST(array() AS array<struct<layer:string,check_name:string>>)")
    needs = F.map_from_arrays(
        F.array(*[F.lit(name) for name in dependencies]).cast("array<string>"),
        F.array(*[F.array(*[F.lit(dep) for dep in deps]) for deps in dependencies.values()]).cast(
            "array<array<string>>"
        ),
    )

    def held(check: Column, before: Column) -> Column:
        """A check it depends on failed in the cycle before."""
        names = F.transform(before, lambda x: x["check_name"])
        return F.coalesce(F.arrays_overlap(F.try_element_at(needs, check), names), F.lit(False))

    def any_of(failing: Column, layer: str) -> Column:
        return F.exists(failing, lambda x: x["layer"] == layer)

    def admit(state: Column, check: Column) -> Column:
        """Checks come lowest layer first, so those that let it run are known."""
        before, now = state["before"], state["now"]

        def below(failing: Column) -> Column:
            return F.exists(failing, lambda x: x["layer"] < check["layer"])

        skipped = below(before) | below(now) | held(check["check_name"], before)
        return F.struct(before.alias("before"), F.when(skipped, now).otherwise(F.concat(now, F.array(check))).alias("now"))

    def walk(state: Column, ago_: Column) -> Column:
        raw = F.coalesce(F.try_element_at(F.col("by_ago"), ago_), none)
        return F.aggregate(raw, F.struct(state["now"].alias("before"), none.alias("now")), admit)

    steps = F.sequence(F.lit(back), F.lit(0), F.lit(-1))
    start = F.struct(none.alias("before"), none.alias("now"))
    walked = seen.select("cycle", F.aggregate(steps, start, walk).alias("_walked"))
    joined = results.join(walked, "cycle", "left")
    before = F.coalesce("_walked.before", none)
    now = F.coalesce("_walked.now", none)
    low = {layer: any_of(before, layer) | any_of(now, layer) for layer in LAYERS[:2]}
    reason = (
        F.when((F.col("layer") == "l2") & low["l1"], L1_GATE)
        .when((F.col("layer") == "l3") & (low["l1"] | low["l2"]), L2_GATE)
        .when(held(F.col("check_name"), before), "dependency failed")
    )
    return joined.select(
        *results.columns,
        reason.alias("reason"),
        F.when(reason.isNotNull(), "skip").otherwise(F.col("status")).alias("verdict"),
    )


def rolling_mean(
    history: DataFrame, window_s: int = ROLLING_WINDOW_S, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Mean of each check's values over the last ``window_s`` seconds, per second.

    Below ``low`` is a warning once there are enough samples, above ``high`` a breach.
    """
    measured = history.filter(F.col("value_num").isNotNull())
    seconds = measured.groupBy("check_name", "ts").agg(
        F.sum("value_num").alias("total"), F.count(F.lit(1)).alias("samples")
    )
    totals = trailing_totals(seconds, ["check_name"], "ts", ["total", "samples"], window_s)
    mean = F.col("trailing_total") / F.col("trailing_samples")
    status = F.lit("ok")
    if low is not None:
        starved = (mean < low) & (F.col("trailing_samples") >= ROLLING_MIN_SAMPLES)
        status = F.when(starved, "warn").otherwise(status)
    if high is not None:
        status = F.when(mean > high, "breach").otherwise(status)
    return totals.select(
        "check_name",
        "ts",
        mean.alias("rolling_mean"),
        F.col("trailing_samples").alias("samples"),
        status.alias("status"),
    )


def limit_actions(
    actions: DataFrame, limit: int = ACTION_LIMIT, window_s: int = ACTION_WINDOW_S
) -> DataFrame:
    """Skip an action when its target already had ``limit`` in the last ``window_s`` seconds.

    Skipped actions count too.  Earlier actions of the same second count as recent: a
    window numbers the rows of one target and second, whole seconds come as totals.
    """
    seconds = actions.groupBy("target", "ts").agg(F.count(F.lit(1)).alias("actions"))
    totals = trailing_totals(seconds, ["target"], "ts", ["actions"], window_s).select(
        F.col("target").alias("_target"), F.col("ts").alias("_ts"),
        (F.col("trailing_actions") - F.col("actions")).alias("_earlier"),
    )
    place = F.row_number().over(Window.partitionBy("target", "ts").orderBy("seq"))
    same = F.col("target").eqNullSafe(F.col("_target")) & (F.col("ts") == F.col("_ts"))
    joined = actions.withColumn("_place", place).join(totals, same)
    recent = F.col("_earlier") + F.col("_place") - 1
    return joined.select(
        *actions.columns,
        recent.alias("recent_actions"),
        F.when(recent >= limit, "skipped_rate_limit").otherwise("run").alias("decision"),
    )


def cycle_summary(results: DataFrame) -> DataFrame:
    """Per cycle: results by status, failing checks by name, and the exit code."""
    statuses = ("ok", "warn", "breach", "error", "skip")
    counted = results.groupBy("cycle").agg(
        *[F.count_if(F.col("status") == status).alias(status) for status in statuses],
        F.array_sort(F.collect_set(F.when(F.col("status") == "breach", F.col("check_name")))).alias("breaches"),
        F.array_sort(F.collect_set(F.when(F.col("status") == "error", F.col("check_name")))).alias("errors"),
    )
    code = F.when(F.col("error") > 0, 2).when(F.col("breach") > 0, 1).otherwise(0)
    return counted.withColumn("exit_code", code)
