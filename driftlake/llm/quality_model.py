"""Text quality: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are counts of hashed n-grams of two views of its words: the words in lower
case (single and pairs), and their shapes (runs of capitals, small letters and digits folded to one
character, other characters as they are; single, pairs, and whether a word repeats the one
before it).  Counts are damped by a logarithm and normalised.  A score is the logistic
function of the sparse dot product of that vector with the weights.

Training (FTRL-proximal, per-coordinate rates) runs in Spark tasks.  Labelled texts are dealt
into shards of about ``SHARD_ROWS`` by a hash, each shard's texts stream through one task in a
fixed order, ``EPOCHS`` times, and the shards' weights are averaged.  Fitting uses at most
about ``SAMPLE`` labels, chosen by a hash of ``doc_id``: the documented bound.  It bounds the
labels that are broadcast, the number of shards, and the weights (``2**BITS`` floats each)
that reach the driver; texts never do.  Scoring covers every whole text in one narrow pass.

Defined results.  A null text counts as empty; an empty text gets the bias's score.  Without
labels every score is 0.5.  Labels of an id that has several count as their mean; null labels
and ids are not learned from, and a null id is not held out.  Repeated rows each get a row, and
are learned from each time.  Columns other than ``doc_id`` and ``text`` of documents and ``doc_id`` and
``quality`` of labels are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given, whole

BITS = 18
#: Labels used for fitting, texts of a shard, passes over a shard.
SAMPLE, SHARD_ROWS, EPOCHS = 100_000, 4096, 2
#: Rates of the leader: step, its damping, and the penalty on large weights.
ALPHA, BETA, L2 = 4.0, 1.0, 1e-3
#: A text with at least this score counts as good.
LIMIT = 0.3
#: Words whose hashes a task remembers.
REMEMBERED = 200_000

_CAPITALS, _LETTERS, _DIGITS = re.compile(r"[A-Z]+"), re.compile(r"[^\W\d_A]+"), re.compile(r"\d+")
#: Multipliers that keep the views apart.
_MIX = [np.uint64(2 * i + 0x9E3779B97F4A7C15) for i in range(6)]


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shape(word: str) -> str:
    """``Aa!!`` for ``Word!!``: runs of letters and digits as one character."""
    if word.isupper():
        word = word.lower()
        return _DIGITS.sub("0", _LETTERS.sub("A", word.replace("A", "a")))
    return _DIGITS.sub("0", _LETTERS.sub("a", _CAPITALS.sub("A", word)))


class Features:
    """Sparse vectors of texts; remembers hashes of words."""

    def __init__(self, bits: int = BITS):
        self.bits, self.known = bits, {}

    def _hashes(self, word: str) -> tuple[int, int]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[word] = (
                xxhash.xxh64_intdigest(word.lower().encode("utf-8", "replace")),
                xxhash.xxh64_intdigest(shape(word).encode("utf-8", "replace"), 1),
            )
        return found

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Indexes, the bias's last, and their values."""
        bias = 1 << self.bits
        words = text.split()
        if not words:
            return np.array([bias]), np.ones(1)
        codes = np.array([self._hashes(word) for word in words], np.uint64)
        word, form = codes[:, 0], codes[:, 1]
        grams = [word * _MIX[0], form * _MIX[1]]
        if len(words) > 1:
            turned = np.uint64(17)
            grams.append((word[:-1] * _MIX[2]) ^ (word[1:] >> turned) * _MIX[3])
            grams.append((form[:-1] * _MIX[3]) ^ (form[1:] >> turned) * _MIX[4])
            grams.append(np.where(word[1:] == word[:-1], _MIX[5], _MIX[5] >> turned) * _MIX[0])
        places = (np.concatenate(grams) >> np.uint64(64 - self.bits)).astype(np.int64)
        index, counts = np.unique(places, return_counts=True)
        values = np.log1p(counts)
        return np.append(index, bias), np.append(values / np.linalg.norm(values), 1.0)


def logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


class Leader:
    """Follow the regularised leader: sums of gradients and of their squares per coordinate."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -z / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, index: np.ndarray, values: np.ndarray, label: float) -> None:
        z, n = self.z[index], self.n[index]
        weights = self._weights(z, n)
        gradient = (logistic(weights @ values) - label) * values
        squared = n + gradient**2
        self.z[index] = z + gradient - (np.sqrt(squared) - np.sqrt(n)) / ALPHA * weights
        self.n[index] = squared

    def weights(self) -> np.ndarray:
        return self._weights(self.z, self.n)


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """``doc_id, text, label`` of the texts to learn from, and how many labels they have."""
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = usable.groupBy("doc_id").agg(F.avg("quality").alias("label"))
    count = known.count()
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    chosen = known.filter(place < F.lit(int((1 << 30) * min(1.0, sample / max(count, 1)))))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), min(count, sample)


def _shard_weights(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, shard, leader = Features(bits), None, None

        def done():
            data = leader.weights().astype(np.float32).tobytes()
            return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "weights": pa.array([data], pa.binary())})

        for batch in batches:
            for row_shard, text, label in zip(*(batch.column(c) for c in ("shard", "text", "label"))):
                if row_shard.as_py() != shard:
                    if leader is not None:
                        yield done()
                    shard, leader = row_shard.as_py(), Leader(bits)
                leader.learn(*features.of(text.as_py() or ""), label.as_py())
        if leader is not None:
            yield done()

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> np.ndarray:
    """The averaged weights of all shards, the bias last."""
    rows, count = labelled(docs, labels, sample)
    shards = max(1, -(-count // SHARD_ROWS))
    identity = F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))
    dealt = rows.select(
        F.pmod(identity, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch"),
        "doc_id", "text", "label",
    )
    # A fixed order within an epoch: by a hash, equal ids by their texts' hashes.
    order = [F.xxhash64(F.col("doc_id").cast("string"), "epoch"), F.xxhash64(whole("text"))]
    streams = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "epoch", *order)
    found = streams.select("shard", "text", "label").mapInArrow(_shard_weights(bits), "shard int, weights binary")
    made = sorted(found.collect(), key=lambda row: row["shard"])  # at most SAMPLE / SHARD_ROWS rows
    total = np.zeros((1 << bits) + 1)
    for row in made:
        total += np.frombuffer(row["weights"], np.float32)
    return (total / max(len(made), 1)).astype(np.float32)


def scorer(weights: np.ndarray, bits: int = BITS):
    """``text`` column to its score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features(bits)
        for texts in batches:
            vectors = (features.of(text or "") for text in texts)
            yield pd.Series([logistic(weights[index] @ values) for index, values in vectors], dtype="float64")

    return score


def score_quality(docs: DataFrame, weights: np.ndarray, limit: float = LIMIT, bits: int = BITS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = docs.select("doc_id", held_out().alias("held_out"), scorer(weights, bits)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= F.lit(limit)).cast("int"))


def op12_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "text")
    return score_quality(docs, train(docs, given(spark, folder, "labels")))
