"""Documents in blocks, and what blocks know of each other's keys.

``blocked`` writes documents once, in blocks that follow the order of ``doc_id``, as a
table bucketed by block; later passes over it, and joins of it with results for a block,
do not shuffle the texts again.

``ask`` sends the keys of each block to buckets and brings back one answer for each key.
A block sends a key once, whatever its rows, packed with the others of a bucket, so a
bucket gets a key from each block at most once: no key is hot, and a bucket holds the
same share of all keys however skewed they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import width, written
from driftlake.session import scratch_path

#: Null ids count as the largest.
LAST = 2**63 - 1


def blocked(docs: DataFrame) -> DataFrame:
    """``block, part, doc_id, text`` of every row; ``part`` grows with ``doc_id`` (nulls last)."""
    spark = docs.sparkSession
    n = width(spark)
    ids = spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("bucket")).agg(F.min("id").alias("id"))
    names = [row["id"] for row in ids.orderBy("bucket").collect()]  # one block for each bucket
    name, path = f"blocked_{uuid.uuid4().hex}", scratch_path(spark, "blocked")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    (
        rows.repartitionByRange(n, F.col("doc_id").isNull(), F.col("doc_id"))
        .withColumn("part", F.spark_partition_id())
        .withColumn("block", F.element_at(F.lit(names).cast("array<bigint>"), F.col("part") % F.lit(n) + 1))
        .select("block", "part", "doc_id", "text")
        .write.bucketBy(n, "block")
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    return spark.table(name)


class Block:
    """The documents of a block as one buffer of UTF-8 bytes."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.block, self.part = table["block"][0].as_py(), table["part"][0].as_py()
        self.doc_ids = table["doc_id"].to_pylist()
        order = np.array([LAST if x is None else x for x in self.doc_ids], np.int64)
        self.rank = np.unique(order, return_inverse=True)[1]
        self.texts = [(x or "").encode() for x in table["text"].to_pylist()]
        self.ends = np.cumsum([len(x) for x in self.texts], dtype=np.int64)
        self.begins = self.ends - np.array([len(x) for x in self.texts], np.int64)


SENT = "bucket int, block long, part int, data binary"
SUMMARY = "summary"
ANSWERED = "block long, bucket int, kind string, data binary"


def send(block: Block, keys: np.ndarray, fields: list[np.ndarray], buckets: int) -> pa.Table:
    """Rows for the buckets of ``keys``; ``fields`` are packed after one another."""
    bucket, order = spread(keys, buckets)
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = [piece for piece in np.split(order, cuts) if len(piece)]
    return pa.table(
        {
            "bucket": pa.array([int(bucket[piece[0]]) for piece in rows], pa.int32()),
            "block": pa.array([block.block] * len(rows), pa.int64()),
            "part": pa.array([block.part] * len(rows), pa.int32()),
            "data": pa.array([b"".join(f[piece].tobytes() for f in fields) for piece in rows], pa.binary()),
        }
    )


def spread(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each key, and the order in which a block sends its keys."""
    bucket = ((keys >> np.uint64(7)) % np.uint64(buckets)).astype(np.int32)
    return bucket, np.argsort(bucket, kind="stable")


def answers(table: pa.Table, kind: str, keys: np.ndarray, buckets: int, dtype) -> np.ndarray:
    """The answers of ``kind``, in the order of ``keys``."""
    own = [(b, d) for b, k, d in zip(*(table[c].to_pylist() for c in ("bucket", "kind", "data"))) if k == kind]
    order = spread(keys, buckets)[1]
    found = np.frombuffer(b"".join(data for _, data in sorted(own)), dtype)
    if len(found) != len(keys):
        raise ValueError("a block got another number of answers than it sent keys")
    out = np.empty(len(keys), dtype)
    out[order] = found
    return out


def ask(
    sent: DataFrame,
    kind: str,
    reply: Callable[[list[np.ndarray], np.ndarray], list[np.ndarray]],
    words: int,
    summary: Callable[[list[np.ndarray]], bytes] | None = None,
) -> DataFrame:
    """``block, bucket, kind, data`` rows: the answers to ``sent`` (rows of ``SENT``).

    ``reply`` gets, for a bucket, the packed 32-bit columns of each block that sent to it
    (``words`` of them, as one array a block of shape words x keys) and the blocks' parts.
    ``summary`` makes one more row for each bucket, of block -1 and kind ``SUMMARY``.
    """

    def answer(table: pa.Table) -> pa.Table:
        parts = table["part"].to_numpy()
        columns = [np.frombuffer(data, np.uint32).reshape(words, -1) for data in table["data"].to_pylist()]
        done = [x.tobytes() for x in reply(columns, parts)]
        blocks, kinds = table["block"].to_pylist(), [kind] * len(done)
        if summary:
            blocks, kinds, done = [*blocks, -1], [*kinds, SUMMARY], [*done, summary(columns)]
        return pa.table(
            {
                "block": pa.array(blocks, pa.int64()),
                "bucket": pa.array([table["bucket"][0].as_py()] * len(done), pa.int32()),
                "kind": pa.array(kinds, pa.string()),
                "data": pa.array(done, pa.binary()),
            }
        )

    return written(sent.groupBy("bucket").applyInArrow(answer, ANSWERED), "answers")
