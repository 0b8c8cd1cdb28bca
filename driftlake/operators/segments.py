"""Ordered rules over keys of any size, as a scan over slices of time.

A rule that looks back over a key's rows (how long is the run up to this row, what came
before it) needs little of the rows before a slice: how many there were, how long the
run at their end is, and the last value.  Slices are evaluated each for itself, those few
facts are folded along each key's slices, and every slice gets the facts of all before it.

So a window holds the rows of one key and one slice, or one key's slices (one row each), never a
key's rows; no rows are copied and no job runs while a query is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How many seconds of one key a window holds.
SLICE_S = 3600


def with_slice(df: DataFrame, ts: str, slice_s: int = SLICE_S) -> DataFrame:
    return df.withColumn("_slice", F.floor(F.col(ts) / F.lit(slice_s)))


def _earlier(keys: Sequence[str]):
    """The slices of a key before this one."""
    return Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)


def _carried(rows: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the facts of their slice; null keys find theirs."""
    named = facts.select(*[F.col(key).alias(f"_k_{key}") for key in keys], F.col("_slice").alias("_s"),
                         *[name for name in facts.columns if name not in (*keys, "_slice")])
    same = F.col("_slice") == F.col("_s")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return rows.join(named, same).drop("_s", *[f"_k_{key}" for key in keys])


def with_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], inside: Column, slice_s: int = SLICE_S
) -> DataFrame:
    """Each row's ``position`` in its key's order, and the length of the ``run`` of rows up to it that are ``inside``.

    ``order`` begins with a time in seconds and has no ties.  A row outside has run 0.
    """
    window = Window.partitionBy(*keys, "_slice").orderBy(*order)
    placed = with_slice(df, order[0], slice_s).withColumn("_place", F.row_number().over(window))
    outside = F.when(~F.coalesce(inside, F.lit(False)), F.col("_place"))
    placed = placed.withColumn("_broken", F.max(outside).over(window.rowsBetween(Window.unboundedPreceding, 0)))
    # A slice in short: its rows, and those after the last one outside (all, where there is none).
    slices = placed.groupBy(*keys, "_slice").agg(F.max("_place").alias("_rows"), F.max("_broken").alias("_last"))
    trailing = F.col("_rows") - F.coalesce("_last", F.lit(0))
    # Slices since the last one with a row outside add up to the run at their end.
    breaks = F.count("_last").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0))
    since = Window.partitionBy(*keys, "_breaks").orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    ended = slices.withColumn("_breaks", breaks).withColumn("_end", F.sum(trailing).over(since))
    facts = ended.select(
        *keys,
        "_slice",
        F.coalesce(F.sum("_rows").over(_earlier(keys)), F.lit(0)).alias("_before"),
        F.coalesce(F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice")), F.lit(0)).alias("_carry"),
    )
    run = F.col("_place") - F.coalesce(F.col("_broken"), -F.col("_carry"))
    return _carried(placed, facts, keys).select(
        *df.columns, (F.col("_place") + F.col("_before")).alias("position"), run.alias("run")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str, slice_s: int = SLICE_S
) -> DataFrame:
    """Adds ``column`` of the row before in the key's order (null for the first row) as ``name``."""
    sliced = with_slice(df, order[0], slice_s)
    # As a struct, a null value of the row before differs from no row before in the slice.
    value = F.struct(F.col(column).alias("value"))
    slices = sliced.groupBy(*keys, "_slice").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    facts = slices.select(
        *keys, "_slice", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carry")
    )
    own = F.lag(value).over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    looked = _carried(sliced.withColumn("_own", own), facts, keys)
    return looked.select(*df.columns, F.coalesce("_own", "_carry")["value"].alias(name))
