"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised.  The
exponent is bisected: the largest in 0..1 that reaches the target entropy, raised if that
is needed to read no source more often than the repetition limit (the limit wins).
Weights become token budgets.  A budget is whole passes over the source plus the start of
one more pass through a seeded permutation.  The permutation is cut into blocks of about
``BLOCK`` documents; sums over blocks of blocks find the block where the budget ends and
only that block is ordered, so no source is gathered in one task.

Defined results: a null source is a source of its own.  A null or empty text has no
tokens; it is taken whenever its place in the permutation is.  Sources without tokens get
weight 0 and no repeats.  Rows with the same ``doc_id`` share a place and a decision.
Empty tables give empty results.  Other columns are not read by the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftlake.llm.common import given, whole, written

#: Documents in a block of the permutation, and blocks in a superblock.
BLOCK, SUPER = 1000, 1000
#: The plan for the sources passes through the driver; more of them are refused.
MOST_SOURCES = 100_000
#: Bits of a place in the permutation.
PLACE_BITS = 52


def place(seed: int) -> Column:
    """A document's place in the seeded permutation: 52 bits of an MD5 digest."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, PLACE_BITS // 4), 16, 10).cast("long")


def token_count() -> Column:
    return F.regexp_count(whole("text"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Weights of the sources; 0 where there are no tokens."""
    total = sum(tokens)
    raw = [math.pow(n / total, exponent) if n else 0.0 for n in tokens]
    return [x / sum(raw) for x in raw] if total else raw


def find_exponent(tokens: list[int], entropy: float, most_repeats: float, budget: int) -> float:
    """The largest exponent that reaches ``entropy`` (a share of the highest possible), or
    the smallest that keeps every source within ``most_repeats`` passes if that is larger."""
    alive = [n for n in tokens if n]
    if len(alive) < 2:
        return 1.0

    def spread(exponent: float) -> float:
        return -sum(w * math.log(w) for w in tempered(alive, exponent) if w) / math.log(len(alive))

    def repeats(exponent: float) -> float:
        return max(w * budget / n for w, n in zip(tempered(alive, exponent), alive))

    def bisect(low_side) -> tuple[float, float]:
        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if low_side(middle) else (low, middle)
        return low, high

    exponent = 1.0 if spread(1.0) >= entropy else bisect(lambda x: spread(x) >= entropy)[0]
    if repeats(exponent) > most_repeats:
        exponent = bisect(lambda x: repeats(x) > most_repeats)[1]
    return exponent


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``source, cut``: the last place whose prefix of the permutation fits the rest of the budget."""
    scale = float(1 << PLACE_BITS)
    blocks = F.greatest(F.ceil(F.col("documents") / BLOCK), F.lit(1))
    placed = written(
        rows.join(F.broadcast(plan), rows["source"].eqNullSafe(plan["plan_source"]))
        .withColumn("block", F.floor(F.col("place") / scale * blocks))
        .groupBy("source", "block", "place", "rest")
        .agg(F.sum("tokens").alias("tokens")),
        "mix-places",
    )
    by_block = placed.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("tokens"))
    by_block = written(by_block.withColumn("super", F.floor(F.col("block") / SUPER)), "mix-blocks")

    def before(keys: list[str], order: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("tokens").over(window), F.lit(0))

    def ends(start: Column) -> Column:
        return (start <= F.col("rest")) & (F.col("rest") < start + F.col("tokens"))

    supers = (
        by_block.groupBy("source", "super", "rest")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("start", before(["source"], "super"))
        .filter(ends(F.col("start")))
        .select(F.col("source").alias("_source"), F.col("super").alias("_super"), "start")
    )
    last = (
        by_block.join(supers, by_block["source"].eqNullSafe(supers["_source"]) & (F.col("super") == F.col("_super")))
        .withColumn("start", F.col("start") + before(["source", "super"], "block"))
        .filter(ends(F.col("start")))
        .select(F.col("source").alias("_source"), F.col("block").alias("_block"), "start")
    )
    order = Window.partitionBy("source").orderBy("place")
    return (
        placed.join(last, placed["source"].eqNullSafe(last["_source"]) & (F.col("block") == F.col("_block")))
        .withColumn("end", F.col("start") + F.sum("tokens").over(order))
        .withColumn("previous", F.coalesce(F.lag("place").over(order), F.col("place") - 1))
        .filter(F.col("end") > F.col("rest"))
        .groupBy("source")
        .agg(F.min("previous").alias("cut"))
    )


def mixing_plan(
    docs: DataFrame, entropy: float = 0.95, most_repeats: float = 4.0, budget: int | None = None, seed: int = 7
) -> DataFrame:
    """One row for each source: ``plan_source, weight, exponent, passes, cut``.

    ``budget`` is in tokens (words); by default what there is.
    """
    spark = docs.sparkSession
    rows = written(
        docs.select(F.col("source").cast("string"), place(seed).alias("place"), token_count().alias("tokens")),
        "mix-rows",
    )
    totals = (
        rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")).limit(MOST_SOURCES + 1)
    ).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
    totals.sort(key=lambda row: (row["source"] is None, row["source"]))
    tokens = [row["tokens"] for row in totals]
    budget = sum(tokens) if budget is None else budget
    exponent = find_exponent(tokens, entropy, most_repeats, budget)
    planned = []
    for row, weight in zip(totals, tempered(tokens, exponent)):
        wanted = round(weight * budget)
        passes, rest = divmod(wanted, row["tokens"]) if row["tokens"] else (0, 0)
        planned.append((row["source"], weight, exponent, passes, rest, row["documents"] if row["tokens"] else 0))
    plan = spark.createDataFrame(
        planned, "plan_source string, weight double, exponent double, passes long, rest long, documents long"
    )
    cuts = _cuts(rows, plan.filter("documents > 0").select("plan_source", "rest", "documents"))
    return written(
        plan.join(F.broadcast(cuts), plan["plan_source"].eqNullSafe(cuts["source"]), "left").select(
            "plan_source", "weight", "exponent", "passes", F.coalesce("cut", F.lit(-1)).alias("cut")
        ),
        "mix-plan",
    )


def with_repeats(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs`` (as the struct ``row``) with their weight and how often they are read."""
    packed = docs.select(
        F.struct("*").alias("row"), F.col("source").cast("string").alias("_source"), place(seed).alias("place")
    )
    once = F.when(F.col("place") <= F.col("cut"), 1).otherwise(0)
    return packed.join(F.broadcast(plan), packed["_source"].eqNullSafe(plan["plan_source"])).select(
        "row", "weight", "place", (F.col("passes") + once).alias("repeats")
    )


def realise(docs: DataFrame, plan: DataFrame, seed: int = 7) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan says, as ``row``, with
    ``epoch`` and ``turn``; reading by ``epoch, turn`` goes through a new permutation each epoch."""
    turn = F.md5(F.concat_ws(":", F.lit(seed), F.col("epoch"), F.col("place")))
    return (
        with_repeats(docs, plan, seed)
        .filter("repeats > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
        .select("row", "epoch", turn.alias("turn"))
    )


def mix(docs: DataFrame, seed: int = 7, **targets) -> DataFrame:
    """The rows of ``docs`` that are read at least once, with ``mix_weight``, ``mix_repeats``
    and ``mix_place`` (names that ``docs`` must not have; they replace such columns)."""
    own = [F.col(f"row.`{name}`") for name in docs.columns if name not in ("mix_weight", "mix_repeats", "mix_place")]
    return (
        with_repeats(docs, mixing_plan(docs, seed=seed, **targets), seed)
        .filter("repeats > 0")
        .select(
            *own,
            F.col("weight").alias("mix_weight"),
            F.col("repeats").alias("mix_repeats"),
            F.col("place").alias("mix_place"),
        )
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents").select("doc_id", "source", "text")
    return with_repeats(docs, mixing_plan(docs)).select(
        "row.doc_id",
        "row.source",
        F.round("weight", 6).alias("weight"),
        F.col("place").alias("place"),
        "repeats",
    )


ORACLE = r"""
WITH RECURSIVE rows_ AS MATERIALIZED (SELECT doc_id, source,
    ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS place,
    length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents),
totals AS MATERIALIZED (SELECT source, sum(tokens)::BIGINT AS tokens FROM rows_ GROUP BY source),
alive AS MATERIALIZED (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM totals)::DOUBLE AS share
    FROM totals WHERE tokens > 0),
entropy_ AS (
    SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
    UNION ALL
    SELECT e.step + 1, CASE WHEN s.spread >= 0.95 THEN (low + high) / 2 ELSE low END,
        CASE WHEN s.spread >= 0.95 THEN high ELSE (low + high) / 2 END
    FROM entropy_ e, LATERAL (SELECT -sum(w * ln(w)) / ln(count(*)) AS spread FROM (
        SELECT pow(share, (e.low + e.high) / 2) / sum(pow(share, (e.low + e.high) / 2)) OVER () AS w FROM alive)) s
    WHERE e.step < 60),
natural_ AS (SELECT -sum(share * ln(share)) / ln(count(*)) AS spread FROM alive),
first_ AS (SELECT CASE WHEN (SELECT spread FROM natural_) >= 0.95 THEN 1.0
    ELSE (SELECT low FROM entropy_ WHERE step = 60) END AS exponent),
repeats_ AS (
    SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
    UNION ALL
    SELECT e.step + 1, CASE WHEN s.most > 4 THEN (low + high) / 2 ELSE low END,
        CASE WHEN s.most > 4 THEN high ELSE (low + high) / 2 END
    FROM repeats_ e, LATERAL (SELECT max(w / share) AS most FROM (
        SELECT share, pow(share, (e.low + e.high) / 2) / sum(pow(share, (e.low + e.high) / 2)) OVER () AS w
        FROM alive)) s
    WHERE e.step < 60),
within AS (SELECT max(w / share) AS most FROM (
    SELECT share, pow(share, (SELECT exponent FROM first_)) / sum(pow(share, (SELECT exponent FROM first_))) OVER () AS w
    FROM alive)),
chosen AS (SELECT CASE WHEN (SELECT most FROM within) > 4 THEN (SELECT high FROM repeats_ WHERE step = 60)
    ELSE (SELECT exponent FROM first_) END AS exponent),
weights AS MATERIALIZED (SELECT source, tokens,
    pow(share, (SELECT exponent FROM chosen)) / sum(pow(share, (SELECT exponent FROM chosen))) OVER () AS weight FROM alive),
budgets AS MATERIALIZED (SELECT *, round(weight * (SELECT sum(tokens) FROM totals))::BIGINT AS wanted FROM weights),
running AS MATERIALIZED (SELECT source, place, tokens, sum(tokens) OVER (PARTITION BY source ORDER BY place
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto FROM rows_)
SELECT r.doc_id, r.source, round(coalesce(b.weight, 0), 6) AS weight, r.place,
    coalesce(b.wanted // b.tokens, 0) + CASE WHEN u.upto <= b.wanted % b.tokens THEN 1 ELSE 0 END AS repeats
FROM rows_ r LEFT JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
JOIN (SELECT DISTINCT source, place, upto FROM running) u
    ON r.source IS NOT DISTINCT FROM u.source AND r.place = u.place
"""
