"""Benchmark decontamination: SimHash of item-sized windows, then exact shingle similarity.

Words are runs of letters and digits in lower case; a shingle is five of them (all words
of a shorter item).  A document is contaminated by an item if some window of as many words
as the item has (the whole document if it is shorter) has at least ``SIMILAR`` of its
shingles in common with it: the sum of the smaller counts over the sum of the larger.

1. Seeds.  Every pair of neighbouring words that a similar window lacks costs it one of the
   item's shingles, so it lacks at most a fifth as many pairs as the item has shingles.  The longest
   pairs of an item (a fifth of its shingles, and ``SEEDS`` more) are looked up in the documents;
   windows that have ``SEEDS`` of them are looked at further, no others can match.  (Items of
   one word: that word.)  Pairs are far rarer than words, so few rows leave the first pass.
2. SimHash.  Windows and items get 64-bit fingerprints, split into ``RADIUS + 1`` blocks.
   Any two within ``RADIUS`` bits share a block; a window is joined on blocks with the items it has
   seeds of, and their Hamming distance is taken.  At the least similarity ten bits differ on
   average, three more or less; the radius leaves out about one such pair in a million.
3. Candidates are verified by their exact similarity.

All of it is DataFrame functions.  The texts are read twice; the second time they are
shuffled once, to meet their windows.

Defined results: documents and items that are null or have no words match nothing; items
with the same id are all looked for.  Ties go to the first window.  A repeated row of the
documents is reported once.  Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftlake.llm.common import given, whole, written

#: Words of a shingle, least similarity, seeds a window must have, and bits that may differ.
WORDS, SIMILAR, SEEDS, RADIUS = 5, 0.8, 4, 23

_SEPARATORS = r"[^\p{L}\p{N}]+"
#: Bits that are set in over half of a window's hashes.
_FINGERPRINT = """aggregate(sequence(0, 63), 0L, (fp, bit) -> fp | shiftleft(
    IF(2 * size(filter(shingles, h -> (shiftright(h, bit) & 1L) = 1L)) > size(shingles), 1L, 0L), bit))"""
#: Hashes with repeats told apart, so that sets of them compare as counts.
_COUNTED = """transform(shingles, (h, i) ->
    xxhash64(h, size(filter(slice(shingles, 1, i), other -> other = h))))"""


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SEPARATORS), lambda word: word != "")


def shingles_of(words: str, size: int) -> Column:
    """Hashes of the runs of ``size`` words of the column ``words``."""
    # Zipped and not indexed: Spark may put the words' own expression where the column stands.
    runs = F.arrays_zip(*[F.slice(F.col(words), j + 1, F.size(words)) for j in range(size)])
    whole_runs = F.slice(runs, F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(0)))
    return F.transform(whole_runs, lambda run: F.xxhash64(*[run.getField(str(j)) for j in range(size)]))


def _runs(words: str, size: int, measure) -> Column:
    """The sum of ``measure`` over each run of ``size`` words."""
    parts = [F.transform(F.slice(F.col(words), j + 1, F.greatest(F.size(words) - size + 1, F.lit(0))), measure) for j in range(size)]
    total = parts[0]
    for part in parts[1:]:
        total = F.zip_with(total, part, lambda a, b: a + b)
    return total


def _sizes(items: DataFrame) -> list[int]:
    """The sizes of shingles in use: ``WORDS``, and the lengths of items shorter than it."""
    short = items.select(F.least(F.size("words"), F.lit(WORDS)).alias("size")).distinct().collect()
    return sorted(row["size"] for row in short)


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, length, size, shingles, item`` of the items that have words."""
    named = benchmark.select("item_id", words_of(whole("text")).alias("words")).filter(F.size("words") > 0)
    named = written(named, "benchmark-words")
    parts = [
        named.filter(F.least(F.size("words"), F.lit(WORDS)) == size).select(
            "item_id", "words", F.size("words").alias("length"), F.lit(size).alias("size"),
            shingles_of("words", size).alias("shingles"),
        )
        for size in _sizes(named)
    ]
    if not parts:
        parts = [
            named.select(
                "item_id", "words", F.lit(0).alias("length"), F.lit(0).alias("size"),
                F.array().cast("array<bigint>").alias("shingles"),
            )
        ]
    item = F.xxhash64("item_id", "shingles")
    return written(reduce(DataFrame.unionByName, parts).withColumn("item", item).dropDuplicates(["item"]), "benchmark-items")


def _fingerprints(windows: DataFrame) -> DataFrame:
    return windows.withColumn("print", F.expr(_FINGERPRINT))


def _blocks(prints: DataFrame) -> DataFrame:
    """A row for each block of each fingerprint."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    masks = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    choices = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(mask).alias("mask")) for i, mask in enumerate(masks)])
    return prints.withColumn("choice", F.explode(choices)).select(
        "item", "print", F.col("choice.n").alias("n"), F.col("print").bitwiseAND(F.col("choice.mask")).alias("bits")
    )


def _seeded_windows(docs: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """``doc_id, own, item, length, start, shingles`` of the windows with enough seeds of an item."""
    least_lost = F.floor(F.size("shingles") * (1 - SIMILAR) + 1e-9).cast("int")
    pair = min(size, 2)
    longest = F.array_sort(
        F.transform(
            F.array_distinct(F.arrays_zip(_runs("words", pair, F.length), shingles_of("words", pair))),
            lambda run: F.struct(-run["0"], run["1"].alias("seed")),
        )
    )
    seeds = (
        items.filter(F.col("size") == size)
        .withColumn("lost", least_lost)
        .select("item", "length", "lost", F.slice(longest, F.lit(1), F.col("lost") + SEEDS).alias("chosen"))
        .select(
            "item", "length",
            F.greatest(F.size("chosen") - F.col("lost"), F.lit(1)).alias("needed"),
            F.explode(F.transform("chosen", lambda x: x["seed"])).alias("seed"),
        )
    )
    seeds = written(seeds, "benchmark-seeds")
    named = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("own"))
    found = named.select("own", words_of(whole("text")).alias("words")).select(
        "own", F.size("words").alias("n_words"), F.posexplode(shingles_of("words", pair)).alias("at", "run")
    )
    hits = (
        found.join(seeds, F.col("run") == seeds["seed"])
        .groupBy("own", "item", "length", "needed", "n_words", "at")
        .agg(F.count("*").alias("rows"))
        .withColumn("place", F.row_number().over(Window.partitionBy("own", "item").orderBy("at")))
    )
    hits = written(hits, "seed-hits")
    # The last of as many hits as are needed, and the first of them, within an item's length.
    first = hits.select(
        F.col("own").alias("f_own"), F.col("item").alias("f_item"), F.col("at").alias("first_at"),
        (F.col("place") + F.col("needed") - 1).alias("f_place"),
    )
    spans = hits.join(
        first, (F.col("own") == F.col("f_own")) & (F.col("item") == F.col("f_item")) & (F.col("place") == F.col("f_place"))
    ).select(
        F.col("own").alias("seeded"), "item", "length",
        F.greatest(F.col("at") - F.col("length") + 1, F.lit(0)).alias("low"),
        F.least(F.col("first_at"), F.greatest(F.col("n_words") - F.col("length"), F.lit(0))).alias("high"),
    )
    starts = (
        spans.filter("low <= high")
        .select("seeded", "item", "length", F.explode(F.sequence("low", "high")).alias("start"))
        .groupBy("seeded", "item", "length")
        .agg(F.collect_set("start").alias("starts"))
    )
    starts = written(starts, "seeded-windows").hint("merge")
    return (
        named.join(starts, F.col("own") == F.col("seeded"))
        .select("doc_id", "own", "item", "length", "starts", words_of(whole("text")).alias("words"))
        .select("doc_id", "own", "item", "length", "starts", shingles_of("words", size).alias("hashes"))
        .select("doc_id", "own", "item", "length", "hashes", F.explode("starts").alias("start"))
        .select(
            "doc_id", "own", "item", "length", "start",
            F.slice("hashes", F.col("start") + 1, F.col("length") - size + 1).alias("shingles"),
        )
        .filter(F.size("shingles") > 0)
    )


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, start`` of each document and item that match, with the best window."""
    items = _items(benchmark)
    sizes = [row["size"] for row in items.select("size").distinct().collect() if row["size"]]
    empty = docs.select(
        F.col("doc_id"), *[F.lit(0).cast("long").alias(name) for name in ("own", "item")],
        F.lit(0).alias("length"), F.lit(0).alias("start"),
        F.array().cast("array<bigint>").alias("shingles"),
    ).filter(F.lit(False))
    windows = [_seeded_windows(docs, items, size) for size in sizes] or [empty]
    windows = written(_fingerprints(reduce(DataFrame.unionByName, windows)), "window-prints")
    prints = written(_fingerprints(items).withColumnRenamed("print", "item_print"), "item-prints")

    # A window meets the items it has seeds of, on the blocks they share.
    left = _blocks(windows.select("item", "print").distinct())
    right = _blocks(prints.select("item", F.col("item_print").alias("print"))).select(
        F.col("item").alias("r_item"), F.col("print").alias("item_print"), F.col("n").alias("r_n"), F.col("bits").alias("r_bits")
    )
    near = (
        left.join(right, (F.col("item") == F.col("r_item")) & (F.col("n") == F.col("r_n")) & (F.col("bits") == F.col("r_bits")))
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select(F.col("item").alias("n_item"), F.col("print").alias("n_print"))
        .distinct()
    )
    near = written(near, "near-prints")
    counted = F.expr(_COUNTED)
    theirs = prints.select("item_id", F.col("item").alias("i_item"), counted.alias("theirs"))
    candidates = (
        windows.select("doc_id", "item", "start", "print", counted.alias("ours"))
        .join(near, (F.col("item") == F.col("n_item")) & (F.col("print") == F.col("n_print")))
        .drop("print")
        .join(theirs, F.col("item") == F.col("i_item"))
    )
    common = F.size(F.array_intersect("ours", "theirs"))
    similarity = common / (F.size("ours") + F.size("theirs") - common)
    return (
        candidates.select("doc_id", "item_id", "start", similarity.alias("similarity"))
        .filter(F.col("similarity") >= SIMILAR)
        .groupBy("doc_id", "item_id")
        .agg(F.max("similarity").alias("similarity"), F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, columns unchanged."""
    found = contaminations(docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    found = written(found, "contaminated")
    return docs.join(found.hint("merge"), docs["doc_id"].eqNullSafe(found["_leaked"]), "left_anti")


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(given(spark, folder, "documents"), given(spark, folder, "benchmark"))
