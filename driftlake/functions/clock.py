"""Explicit clocks, tumbling buckets and prunable time ranges."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.schemas import date_column

Clock = datetime | Column | None


def clock(as_of: Clock = None) -> Column:
    """The moment a query is asked at: the given one, else the wall clock."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def ago(as_of: Clock, **parts: int) -> Column:
    """``ago(as_of, minutes=15)``: that long before the clock."""
    span = " ".join(f"{amount} {unit}" for unit, amount in parts.items())
    return clock(as_of) - F.expr(f"INTERVAL {span}")


def day_start(as_of: Clock) -> Column:
    return F.date_trunc("day", clock(as_of))


def micros_to_timestamp(time_us: Column | str) -> Column:
    return F.timestamp_micros(F.col(time_us) if isinstance(time_us, str) else time_us)


def bucket_start(column: Column | str, seconds: int) -> Column:
    """Start of the tumbling bucket of ``seconds`` a timestamp falls in."""
    micros = F.unix_micros(F.col(column) if isinstance(column, str) else column)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(seconds * 1_000_000)))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microseconds kept."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def time_range(
    df: DataFrame, column: str, since: Column | None = None, until: Column | None = None
) -> DataFrame:
    """Keep ``since <= column < until``.

    Where the table carries the derived day column the same bounds are put on it too:
    Spark does not derive a partition predicate from a timestamp one.
    """
    day = date_column(column)
    partitioned = day in df.columns
    if since is not None:
        df = df.filter(F.col(column) >= since)
        if partitioned:
            df = df.filter(F.col(day) >= F.to_date(since))
    if until is not None:
        df = df.filter(F.col(column) < until)
        if partitioned:
            df = df.filter(F.col(day) <= F.to_date(until))
    return df


def newest_day(df: DataFrame, column: str) -> DataFrame:
    """The newest day partition, where the table carries the derived day; else the table."""
    day = date_column(column)
    if day not in df.columns:
        return df
    return df.filter(F.col(day) == df.agg(F.max(day)).scalar())
