"""Exact dedup: a persistent digest index, bucketed and sorted by hash.

Texts are equal when their SHA-256 agrees after all white space is deleted.  A batch is
first folded to one row for each digest, so that a digest that a third of all rows share
costs one row for each task; the folded rows meet the index in a sort-merge anti-join in
which the index, bucketed by digest, is not shuffled.  New digests are appended with the
batch they came in; a batch that runs again under its name, also after its append, is decided as the first time.

Defined results: a null text counts as empty; empty texts are copies of each other.  Of
equal texts the one with the most code points stays, then the smallest ``doc_id`` (null
ids last).  If rows repeat both, one of them stays.  A digest the index already has
keeps the document that is there; all new rows of it go.  Columns other than ``doc_id``
and ``text`` are not read here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftlake.llm.common import SPACE, given, whole, width, written
from driftlake.session import scratch_path


class DigestIndex:
    """A bucketed table ``digest, keep_id, batch`` at ``path``.

    ``buckets`` is fixed for the life of the index; a later session passes the same path
    and number and finds the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, name: str | None = None):
        self.spark, self.buckets = spark, buckets
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """Add ``digest, keep_id, batch`` rows; one file for each bucket that gets rows."""
        fresh.select("digest", "keep_id", "batch").repartition(self.buckets, "digest").write.insertInto(self.name)


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, points, digest``: code points of the text and SHA-256 without white space."""
    bare = F.regexp_replace(whole("text"), SPACE, "")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(whole("text")).alias("points"),
        F.unhex(F.sha2(bare, 256)).alias("digest"),
    )


def dedup_batch(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Decide every row of ``docs`` against ``index`` and append what is new.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``; ``group_size`` counts the
    rows of this batch.  What an earlier run of the same ``batch`` has appended does not count as
    known and is not appended again; without a name a batch is taken for a new one.
    """
    batch = batch or uuid.uuid4().hex
    rows = written(
        digests(docs).groupBy("digest", "doc_id", "points").agg(F.count("*").alias("times")), "digests"
    )
    first = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id")))
    groups = written(
        rows.groupBy("digest").agg(first.alias("first"), F.sum("times").alias("group_size")), "digest-groups"
    )
    stored = index.rows().filter(F.col("batch") != batch).drop("batch").hint("merge")
    fresh = groups.join(stored, "digest", "left_anti").select(
        "digest", F.col("first.doc_id").alias("keep_id"), (-F.col("first.col1")).alias("most"), "group_size"
    )
    known = groups.join(stored, "digest").select("digest", "keep_id", F.lit(-1).alias("most"), "group_size")
    decided = written(fresh.unionByName(known), "digest-decisions")
    own = index.rows().filter(F.col("batch") == batch).select("digest").hint("merge")
    index.append(decided.filter("most >= 0").join(own, "digest", "left_anti").withColumn("batch", F.lit(batch)))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))
    return (
        rows.join(decided, "digest")
        .withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (stays & (F.col("time") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder, as wide as the session's shuffles."""
    return DigestIndex(spark, scratch_path(spark, "digest-index"), width(spark))


def drop_exact_copies(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged; one row for each kept ``doc_id``.

    Which row stays is decided on narrow rows (digest, id, length and a hash of the row); the texts meet the
    decision once, by digest and row hash.  Of rows that repeat id and text the one with the
    least hash stays.
    """
    keep = written(dedup_batch(docs, index, batch).filter("kept").select("doc_id", "text_sha256"), "kept")
    keep = keep.select(F.col("doc_id").alias("_keep"), F.unhex("text_sha256").alias("_digest"))
    plain = [field.name for field in docs.schema.fields if field.dataType.typeName() not in ("map", "variant")]
    own = F.unhex(F.sha2(F.regexp_replace(whole("text"), SPACE, ""), 256)).alias("_own")
    mark = F.xxhash64(*[F.col(name) for name in plain]).alias("_mark")
    narrow = docs.select(F.col("doc_id").cast("long").alias("_id"), F.length(whole("text")).alias("_points"), own, mark)
    chosen = narrow.join(keep, (F.col("_own") == F.col("_digest")) & F.col("_id").eqNullSafe(F.col("_keep")))
    chosen = written(
        chosen.groupBy(F.col("_own").alias("_of")).agg(
            F.min(F.struct(-F.col("_points"), F.col("_mark").alias("mark"))).alias("first")
        ).select("_of", F.col("first.mark").alias("_with")),
        "kept-rows",
    )
    rows = docs.select(F.struct("*").alias("row"), own, mark)
    met = rows.join(chosen.hint("merge"), (F.col("_own") == F.col("_of")) & (F.col("_mark") == F.col("_with")))
    # Rows equal in all columns; the window has the join's partitions.
    place = F.row_number().over(Window.partitionBy("_own", "_mark").orderBy(F.lit(1)))
    return met.withColumn("_place", place).filter("_place = 1").select("row.*")


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_batch(given(spark, folder, "documents"), new_index(spark))


ORACLE = r"""
WITH bare AS (SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id,
    first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) = 1 AS kept,
    text_sha256
FROM bare
"""
