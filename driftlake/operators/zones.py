"""Severities from a table of zones of any size, by a binned range join.

Zones are rows ``check_name, low, high, severity, place``; a value gets the severity of the
first zone, by ``place``, that holds it.  Zones are ``[low, high)``, and a check's last one
also holds its high end.  Zones may overlap and leave gaps; a value in none is grey, as is a null.

Zones are first cut into pieces that do not overlap, each with the severity that counts
there, then dealt to as many bins of equal width as a check has pieces.  A value is in one bin
and one piece, so it meets the pieces of its bin and nothing is folded afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlake.functions.severity import Zone

ZONE_SCHEMA = "check_name string, low double, high double, severity string, place int"


def zone_table(spark: SparkSession, zones: Mapping[str, Sequence[Zone]]) -> DataFrame:
    """The rows of zones given as constants."""
    rows = [
        (name, low, high, severity, place)
        for name, own in zones.items()
        for place, (low, high, severity) in enumerate(own)
    ]
    return spark.createDataFrame(rows, ZONE_SCHEMA)


def _first(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min_by("severity", "place").alias("severity"))


def zone_pieces(zones: DataFrame) -> DataFrame:
    """``check_name, low, high, severity, is_end``: disjoint ``[low, high)`` and, for each check, the closed end of its last zone."""
    cuts = zones.select("check_name", F.explode(F.array("low", "high")).alias("cut")).distinct()
    by_cut = Window.partitionBy("check_name").orderBy("cut")
    numbered = cuts.select(
        "check_name", "cut", F.row_number().over(by_cut).alias("n"), F.lead("cut").over(by_cut).alias("next")
    )
    ends = [
        numbered.select(F.col("check_name"), F.col("cut").alias(side), F.col("n").alias(f"n_{side}")) for side in ("low", "high")
    ]
    placed = zones.join(ends[0], ["check_name", "low"]).join(ends[1], ["check_name", "high"]).filter("low < high")
    covered = placed.withColumn("n", F.explode(F.sequence("n_low", F.col("n_high") - 1)))
    between = _first(covered, "check_name", "n").join(numbered, ["check_name", "n"]).select(
        "check_name", F.col("cut").alias("low"), F.col("next").alias("high"), "severity", F.lit(False).alias("is_end")
    )
    last = zones.groupBy("check_name").agg(F.max_by("high", "place").alias("end"), F.max("place").alias("last"))
    held = zones.join(last, "check_name").filter(
        ((F.col("low") <= F.col("end")) & (F.col("end") < F.col("high")))
        | ((F.col("place") == F.col("last")) & (F.col("low") <= F.col("end")))
    )
    at_end = _first(held, "check_name", "end").select(
        "check_name", F.col("end").alias("low"), F.col("end").alias("high"), "severity", F.lit(True).alias("is_end")
    )
    return between.unionByName(at_end)


def zone_severities(results: DataFrame, zones: DataFrame) -> DataFrame:
    """``results`` (``check_name, value_num`` and more) with their ``severity``."""
    pieces = zone_pieces(zones)
    frames = pieces.groupBy(F.col("check_name").alias("_check")).agg(
        F.min("low").alias("_from"),
        ((F.max("high") - F.min("low")) / F.count(F.lit(1))).alias("_width"),
        F.max(F.when(F.col("is_end"), F.col("low"))).alias("_end"),
    )

    def bin_of(value: str):
        return F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_from"), F.col("_width"))), F.lit(0))

    dealt = pieces.join(frames, F.col("check_name") == F.col("_check")).select(
        F.col("check_name").alias("_of"), "low", "high", "severity", "is_end",
        F.explode(F.sequence(bin_of("low"), bin_of("high"))).alias("_in"),
    )
    framed = results.join(frames, F.col("check_name") == F.col("_check"), "left").withColumn("_bin", bin_of("value_num"))
    value, at_end = F.col("value_num"), F.coalesce(F.col("value_num") == F.col("_end"), F.lit(False))
    inside = F.when(at_end, F.col("is_end")).otherwise((value >= F.col("low")) & (value < F.col("high")))
    joined = framed.join(
        dealt, (F.col("check_name") == F.col("_of")) & (F.col("_bin") == F.col("_in")) & inside, "left"
    )
    return joined.select(*results.columns, F.coalesce("severity", F.lit("grey")).alias("severity"))
