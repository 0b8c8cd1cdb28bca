"""Ordered rules on streams: alerts, recoveries and action limits as keyed state with timers.

Rows of a key wait until the watermark has passed their second; then that second's rows are
taken in order.  So the result is that of the batch rules (``driftlake.operators.telemetry``)
over the same rows, however rows are dealt to micro-batches, as long as none is later than
the delay.  What is kept of a key: the rows still waiting, the length of the run and the last
status, or the actions per second of one window.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from driftlake.operators.telemetry import (
    ACTION_LIMIT,
    ACTION_WINDOW_S,
    ALERT_TOLERANCE,
    ROLLING_MIN_SAMPLES,
    ROLLING_WINDOW_S,
    TRIGGERS,
)
from driftlake.session import SETTINGS

# How late a row may be.
DELAY = "15 minutes"


class InOrder(StatefulProcessor):
    """Hands a key's rows to ``second``, one second after the other."""

    key: str
    fields: tuple[str, ...]
    output: tuple[str, ...]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "ts long", "rows string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh: dict[int, list] = {}
        for frame in rows:
            for ts, *row in zip(frame["ts"], *(frame[name] for name in self.fields)):
                fresh.setdefault(int(ts), []).append([None if pd.isna(value) else value for value in row])
        for ts, new in fresh.items():
            held = []
            if self.waiting.containsKey((ts,)):
                held = json.loads(self.waiting.getValue((ts,))[0])
            else:
                self.handle.registerTimer(ts * 1000)
            self.waiting.updateValue((ts,), (json.dumps([*held, *new], default=int),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.waiting.containsKey((expiredTimerInfo.getExpiryTimeInMs() // 1000,)):
            return  # taken with an earlier second's timer
        passed = timerValues.getCurrentWatermarkInMs()
        due = sorted(ts for (ts,) in self.waiting.keys() if ts * 1000 <= passed)
        made = []
        for ts in due:
            rows = sorted(json.loads(self.waiting.getValue((ts,))[0]), key=lambda row: row[0])
            made.extend((key[0], ts, *row) for row in self.second(ts, rows))
            self.waiting.removeKey((ts,))
        self.settled()
        if made:
            yield pd.DataFrame(made, columns=[self.key, "ts", *self.output])

    def second(self, ts: int, rows: list[list]) -> Iterator[tuple]:
        """The results of one second's rows, which come by their first field."""
        raise NotImplementedError

    def settled(self) -> None:
        """Called after the seconds that were due."""


class CheckEvents(InOrder):
    """Alerts and recoveries of one check."""

    key, fields, output = "check_name", ("seq", "status"), ("seq", "status", "event", "previous_status")

    def __init__(self, tolerance: int | Mapping[str, int]):
        self.tolerance = tolerance if isinstance(tolerance, int) else dict(tolerance)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "run long, status string")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run, self.status = self.last.get() if self.last.exists() else (0, None)
        self.wanted = (
            self.tolerance if isinstance(self.tolerance, int) else self.tolerance.get(key[0], ALERT_TOLERANCE)
        )
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    def second(self, ts: int, rows: list[list]) -> Iterator[tuple]:
        for seq, status in rows:
            self.run = self.run + 1 if status in TRIGGERS else 0
            if self.run and self.run == self.wanted:
                yield seq, status, "alert", self.status
            if status == "ok" and self.status in TRIGGERS:
                yield seq, status, "recovery", self.status
            self.status = status

    def settled(self) -> None:
        self.last.update((self.run, self.status))


class ActionDecisions(InOrder):
    """Which actions of one target run, and which come too often."""

    key, fields, output = "target", ("seq", "action"), ("seq", "action", "recent_actions", "decision")

    def __init__(self, limit: int, window_s: int):
        self.limit, self.window_s = limit, window_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.counts = handle.getMapState("counts", "ts long", "actions long")

    def second(self, ts: int, rows: list[list]) -> Iterator[tuple]:
        known = {second: actions for (second,), (actions,) in self.counts.iterator()}
        for second in [second for second in known if second < ts - self.window_s]:
            self.counts.removeKey((second,))
            del known[second]
        recent = sum(known.values())
        for seq, action in rows:
            yield seq, action, recent, "skipped_rate_limit" if recent >= self.limit else "run"
            recent += 1
        self.counts.updateValue((ts,), (len(rows),))


def _by_key(rows: DataFrame, processor: InOrder, schema: str, delay: str) -> DataFrame:
    # Timers and maps are kept by this state store only; a session of one's own may have another.
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", SETTINGS["spark.sql.streaming.stateStore.providerClass"])
    timed = rows.select(processor.key, "ts", *processor.fields, F.timestamp_seconds("ts").alias("_at"))
    return timed.withWatermark("_at", delay).groupBy(processor.key).transformWithStateInPandas(
        processor, schema, "append", "EventTime"
    )


def live_check_events(
    history: DataFrame, tolerance: int | Mapping[str, int] = ALERT_TOLERANCE, delay: str = DELAY
) -> DataFrame:
    """Alerts and recoveries (``event``) of a stream of check results, once their second is past."""
    return _by_key(
        history,
        CheckEvents(tolerance),
        "check_name string, ts long, seq long, status string, event string, previous_status string",
        delay,
    )


def live_action_limits(
    actions: DataFrame, limit: int = ACTION_LIMIT, window_s: int = ACTION_WINDOW_S, delay: str = DELAY
) -> DataFrame:
    """A stream of requested actions with their decisions, once their second is past."""
    return _by_key(
        actions,
        ActionDecisions(limit, window_s),
        "target string, ts long, seq long, action string, recent_actions long, decision string",
        delay,
    )


def live_rolling_mean(
    history: DataFrame,
    window_s: int = ROLLING_WINDOW_S,
    slide_s: int = 60,
    low: float | None = None,
    high: float | None = None,
    delay: str = DELAY,
) -> DataFrame:
    """Mean of each check's values over sliding windows, once a window is closed.

    Below ``low`` is a warning if the window has enough samples, above ``high`` a breach.
    """
    measured = history.filter(F.col("value_num").isNotNull())
    timed = measured.select("check_name", "value_num", F.timestamp_seconds("ts").alias("_at")).withWatermark("_at", delay)
    windows = F.window("_at", f"{window_s} seconds", f"{slide_s} seconds").alias("_window")
    means = timed.groupBy(windows, "check_name").agg(
        F.avg("value_num").alias("rolling_mean"), F.count(F.lit(1)).alias("samples")
    )
    status = F.lit("ok")
    if low is not None:
        starved = (F.col("rolling_mean") < low) & (F.col("samples") >= ROLLING_MIN_SAMPLES)
        status = F.when(starved, "warn").otherwise(status)
    if high is not None:
        status = F.when(F.col("rolling_mean") > high, "breach").otherwise(status)
    return means.select(
        "check_name", F.col("_window.end").alias("window_end"), "rolling_mean", "samples", status.alias("status")
    )
