"""Small helpers the operators share."""

from __future__ import annotations

import os
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.session import scratch_path

#: The six characters that separate words, as a pattern.
SPACE = r"[\x20\x09-\x0D]"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(column: str | Column) -> Column:
    """A text with null as empty."""
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; no other letter changes."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def width(spark: SparkSession) -> int:
    """How many partitions the session shuffles into."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Scratch tables written so far, oldest first.
_WRITTEN: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as files in the shared folder, read back.

    Later reads do not compute it again, survive lost executors, and their size is known
    to the planner before it chooses a join.
    """
    path = scratch_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` (null included) is in ``ids``, columns unchanged."""
    chosen = ids.select(F.col("doc_id").alias("_chosen")).distinct().hint("merge")  # the same join at any size
    return docs.join(chosen, docs["doc_id"].eqNullSafe(chosen["_chosen"]), "left_semi")


def scratch_mark() -> int:
    """Where the scratch tables of what follows begin."""
    return len(_WRITTEN)


def release(spark: SparkSession, mark: int, keep: DataFrame) -> None:
    """Delete the scratch tables written since ``mark``, but the one that ``keep`` (of ``written``) reads."""
    kept = {os.path.basename(os.path.dirname(path)) for path in keep.inputFiles()}
    for path in _WRITTEN[mark:]:
        if os.path.basename(path) not in kept:
            forget(spark, path)
    del _WRITTEN[mark:]


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
