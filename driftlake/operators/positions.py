"""Sums along time over keys of any size.

A window over a key puts all its rows into one task.  Where one key may hold a large part
of the table these helpers do the same work over bounded pieces of time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlake.session import settle


def trailing_totals(
    per_second: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[str], seconds: int
) -> DataFrame:
    """Sums of ``measures`` over ``[ts - seconds, ts]`` for rows unique per key and second.

    Each row goes to its own time slice and to the next one, so a window never holds more
    than two slices of seconds, whatever the key holds.
    """
    own = F.floor(F.col(ts) / F.lit(seconds + 1))
    copies = F.explode(
        F.array(
            F.struct(own.alias("slice"), F.lit(False).alias("context")),
            F.struct((own + F.lit(1)).alias("slice"), F.lit(True).alias("context")),
        )
    )
    window = (
        Window.partitionBy(*keys, F.col("_copy.slice")).orderBy(ts).rangeBetween(-seconds, Window.currentRow)
    )
    made = per_second.withColumn("_copy", copies).select(
        "*", *[F.sum(name).over(window).alias(f"trailing_{name}") for name in measures]
    )
    return made.filter(~F.col("_copy.context")).drop("_copy")


def running_totals(per_step: DataFrame, ts: str, measures: Mapping[str, str]) -> DataFrame:
    """Running sums over a time axis with one row per point in time.

    ``measures`` maps a column to the name of its total.  Days are summed over their year,
    years over all years, and points over their own day, so no task holds the whole axis.
    The points are written out first: the levels then read those few rows instead of
    computing them again.
    """
    points = settle(per_step).withColumn("_day", F.date_trunc("day", ts))
    before = (Window.unboundedPreceding, -1)

    def earlier(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(*before)), F.lit(0))

    days = points.groupBy("_day").agg(*[F.sum(column).alias(column) for column in measures])
    days = days.withColumn("_year", F.date_trunc("year", "_day"))
    years = days.groupBy("_year").agg(*[F.sum(column).alias(column) for column in measures])
    year_bases = years.select(
        "_year", *[earlier(column, Window.orderBy("_year")).alias(f"_y_{column}") for column in measures]
    )
    in_year = Window.partitionBy("_year").orderBy("_day")
    day_bases = days.join(year_bases, "_year").select(
        "_day", *[(F.col(f"_y_{column}") + earlier(column, in_year)).alias(f"_d_{column}") for column in measures]
    )
    in_day = Window.partitionBy("_day").orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.join(day_bases, "_day").select(
        *per_step.columns,
        *[(F.col(f"_d_{column}") + F.sum(column).over(in_day)).alias(name) for column, name in measures.items()],
    )
