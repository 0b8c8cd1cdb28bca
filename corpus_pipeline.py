"""From documents to a mixed training corpus, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that ``run`` writes as
Parquet and reads back for the next; the scratch tables of a stage go once it is written.  All but the last return the columns of ``docs``.
The last adds ``mix_weight``, ``mix_repeats`` (how often the row is read) and ``mix_place``
(its place in the permutation).  Empty and null texts: language identification drops
texts without a letter; the other stages define theirs in their operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftlake.llm import decontaminate, digest_index, langid, mixing, simhash
from driftlake.llm.common import given, release, scratch_mark, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what is in no language the labelled documents have."""
    return langid.drop_rejected(docs, langid.train(docs.select("doc_id", "text", "lang")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each text, white space aside."""
    return digest_index.drop_exact_copies(docs, digest_index.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each group of texts with a shingle similarity of 0.8 or more."""
    return simhash.drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that have a benchmark item in them."""
    return decontaminate.drop_contaminated(docs, given(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Weigh sources by temperature; keep the rows that are read at least once."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", benchmark),
    ("mixing", mixture),
]

#: Centroids and near copies have no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given(spark, sf_dir, "documents")
    for name, stage in STAGES:
        mark = scratch_mark()
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        release(spark, mark, docs)
    return docs
