"""Data-quality rules over the lake tables.

Every rule gives rows, not exceptions: what was measured, its limit, and a verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions.clock import Clock, ago, clock, newest_day, seconds_between, time_range
from driftlake.schemas import BLOCK, FOLLOW, KINDS, LIKE, POST, PROFILE, REPOST, ROUTES, TABLES

# Limits of the freshness and completeness rules.
RAW_FRESHNESS_S = 15.0
MART_FRESHNESS_S = 120.0
NULL_DID_RATE = 0.001
SCORE_SUM_TOLERANCE = 0.01
CONFIDENCE_RANGE = (0.33, 1.0)
EVENTS_NOT_BEFORE = "2023-01-01 00:00:00"

# The record keys each record type is known to carry.
DECLARED_KEYS: dict[str, tuple[str, ...]] = {
    POST: (
        "$type", "text", "createdAt", "langs", "reply", "embed", "facets", "labels", "tags",
    ),
    LIKE: ("$type", "subject", "createdAt", "via"),
    REPOST: ("$type", "subject", "createdAt", "via"),
    FOLLOW: ("$type", "subject", "createdAt"),
    BLOCK: ("$type", "subject", "createdAt"),
    PROFILE: (
        "$type", "displayName", "description", "avatar", "banner", "labels", "createdAt",
    ),
}


# -- timeliness and completeness -----------------------------------------------------
def freshness(newest: DataFrame, name: str, limit_s: float, as_of: Clock = None) -> DataFrame:
    """Age of the newest row; an empty table is a breach.

    ``newest`` has one row and one column: the table's newest timestamp.
    """
    age = seconds_between(clock(as_of), F.col(newest.columns[0]))
    return newest.select(
        F.lit(name).alias("check_name"),
        age.alias("value_num"),
        F.lit(limit_s).alias("limit_num"),
        F.when(age <= limit_s, "ok").otherwise("breach").alias("status"),
    )


def lake_freshness(tables: Mapping[str, DataFrame], as_of: Clock = None) -> DataFrame:
    """Freshness of the raw table and of the hashtag mart's newest minute."""
    raw = newest_day(tables["raw_events"], "ingested_at").agg(F.max("ingested_at"))
    # The newest minute of the mart is the minute of the newest row: no need to build it.
    tags = newest_day(tables["core_hashtags"], "event_time")
    mart = tags.agg(F.date_trunc("minute", F.max("event_time")).alias("newest"))
    return freshness(raw, "quality.raw_events.freshness_s", RAW_FRESHNESS_S, as_of).unionByName(
        freshness(mart, "quality.mart_trending_hashtags.freshness_s", MART_FRESHNESS_S, as_of)
    )


def null_rate(df: DataFrame, column: str, limit: float = NULL_DID_RATE) -> DataFrame:
    """Share of NULLs over the whole table."""
    rate = F.coalesce(F.avg(F.col(column).isNull().cast("double")), F.lit(0.0))
    return df.agg(F.count(F.lit(1)).alias("rows_checked"), rate.alias("null_ratio")).select(
        "rows_checked",
        "null_ratio",
        F.when(F.col("null_ratio") > limit, "breach").otherwise("ok").alias("status"),
    )


# -- validity ------------------------------------------------------------------------
def _rule(df: DataFrame, name: str, valid: Column) -> DataFrame:
    """A NULL verdict counts as a violation."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("violations"),
    ).select(F.lit(name).alias("rule"), "rows_checked", "violations")


def validity(tables: Mapping[str, DataFrame], as_of: Clock = None) -> DataFrame:
    """Value-set and range rules, one row each."""
    scores = [F.col(f"sentiment_{label}").between(-1.0, 1.0) for label in ("positive", "negative", "neutral")]
    language = F.col("primary_lang").rlike("^[a-z]{2,3}(-[A-Za-z0-9]+)*$") | (
        F.col("primary_lang") == "unknown"
    )
    event_time = F.col("event_time").between(
        F.lit(EVENTS_NOT_BEFORE).cast("timestamp"), clock(as_of) + F.expr("INTERVAL 1 HOUR")
    )
    rules = [
        _rule(tables["raw_events"], "raw_events.kind_whitelist", F.col("kind").isin(*KINDS)),
        _rule(tables["core_posts"], "core_posts.lang_code_valid", language),
        _rule(tables["core_post_sentiment"], "core_post_sentiment.score_range", scores[0] & scores[1] & scores[2]),
        _rule(tables["stg_posts"], "stg_posts.event_time_sanity", event_time),
    ]
    report = rules[0]
    for rule in rules[1:]:
        report = report.unionByName(rule)
    return report


def score_validity(sentiment: DataFrame) -> DataFrame:
    """Broken sums, missing labels, label variety and confidences out of range; one row."""
    total = F.col("sentiment_positive") + F.col("sentiment_negative") + F.col("sentiment_neutral")
    confidence = F.col("sentiment_confidence")
    return sentiment.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.abs(total - 1.0) > SCORE_SUM_TOLERANCE).alias("bad_sums"),
        F.count_if(F.col("sentiment_label").isNull()).alias("null_labels"),
        F.count_distinct("sentiment_label").alias("labels_seen"),
        F.count_if((confidence < CONFIDENCE_RANGE[0]) | (confidence > CONFIDENCE_RANGE[1])).alias(
            "bad_confidence"
        ),
    )


# -- shape ---------------------------------------------------------------------------
def record_keys(raw_events: DataFrame) -> DataFrame:
    """Observed record keys and JSON value types per record type."""
    members = raw_events.select(
        "collection",
        F.explode(
            F.try_variant_get(F.try_parse_json("raw_json"), "$.commit.record", "map<string,variant>")
        ).alias("key", "value"),
    )
    kind = F.lower(F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0))
    return members.groupBy("collection", "key", kind.alias("value_type")).agg(
        F.count(F.lit(1)).alias("records")
    )


def schema_drift(raw_events: DataFrame, declared: Mapping[str, Sequence[str]] = DECLARED_KEYS) -> DataFrame:
    """Keys seen in the data that the record type does not declare."""
    rows = [(collection, key) for collection, keys in declared.items() for key in keys]
    known = raw_events.sparkSession.createDataFrame(rows, "collection string, key string")
    return record_keys(raw_events).join(known, ["collection", "key"], "left_anti")


# -- uniqueness ----------------------------------------------------------------------
def duplicate_ratio(df: DataFrame, keys: Sequence[str] = ("did", "time_us", "kind")) -> DataFrame:
    """Rows beyond the first of each key; copies fold before the shuffle."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    totals = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_checked"), F.count(F.lit(1)).alias("distinct_keys")
    )
    extra = F.col("rows_checked") - F.col("distinct_keys")
    return totals.select(
        "rows_checked",
        "distinct_keys",
        extra.alias("duplicate_rows"),
        F.coalesce(F.try_divide(extra.cast("double"), F.col("rows_checked").cast("double")), F.lit(0.0)).alias(
            "duplicate_ratio"
        ),
    )


def deduplicate(
    df: DataFrame, keys: Sequence[str] = ("did", "rkey", "time_us"), order: str = "ingested_at"
) -> DataFrame:
    """The earliest row of each key, as an aggregate with a map-side half.

    Of rows with equal ``order`` the one whose other columns hash least stays, so the same rows
    give the same result however they are dealt.
    """
    whole = F.struct(*df.columns)
    others = [name for name in df.columns if name not in (*keys, order)]
    place = F.struct(F.col(order), F.xxhash64(*others, F.lit(0)))
    return df.groupBy(*keys).agg(F.min_by(whole, place).alias("_row")).select("_row.*")


# -- integrity -----------------------------------------------------------------------
def join_coverage(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("did", "time_us")) -> DataFrame:
    """How many left rows find their key on the right; the left side is read once."""
    present = right.select(*keys).distinct().withColumn("_present", F.lit(1))
    joined = left.select(*keys).join(present, list(keys), "left")
    totals = joined.agg(F.count(F.lit(1)).alias("rows_checked"), F.count("_present").alias("matched"))
    return totals.select(
        "rows_checked",
        "matched",
        (F.col("rows_checked") - F.col("matched")).alias("unmatched"),
        F.try_divide(F.col("matched").cast("double"), F.col("rows_checked").cast("double")).alias("coverage"),
    )


def missing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("did", "time_us")) -> DataFrame:
    """Left rows without their key on the right."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def row_delta(
    mart: DataFrame, core: DataFrame, measure: str = "count", since: Column | None = None, column: str = "event_time"
) -> DataFrame:
    """Difference between a mart's summed counts and the rows of its core table.

    ``since`` is where the mart's window begins; without it the mart is over all rows.
    """
    core = time_range(core, column, since)
    summed = mart.agg(F.coalesce(F.sum(measure), F.lit(0)).alias("n"), F.lit(0).cast("bigint").alias("m"))
    counted = core.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("m"))
    both = summed.unionByName(counted).agg(F.sum("n").alias("mart_rows"), F.sum("m").alias("core_rows"))
    return both.select("mart_rows", "core_rows", (F.col("mart_rows") - F.col("core_rows")).alias("delta"))


def routing_completeness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Commit rows of each record type in the raw table against its staging table."""
    raw = tables["raw_events"].filter(F.col("kind") == "commit").select(
        "collection", F.lit(1).alias("r"), F.lit(0).alias("s")
    )
    both = raw
    for collection, name in ROUTES.items():
        both = both.unionByName(
            tables[name].select(F.lit(collection).alias("collection"), F.lit(0).alias("r"), F.lit(1).alias("s"))
        )
    counted = both.groupBy("collection").agg(F.sum("r").alias("raw_rows"), F.sum("s").alias("staged_rows"))
    return counted.select(
        "collection",
        "raw_rows",
        "staged_rows",
        (F.col("raw_rows") - F.col("staged_rows")).alias("missing"),
        F.col("collection").isin(*ROUTES).alias("is_routed"),
    )


def sentiment_coverage(core_posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Posts with a score, and their whole percentage."""
    covered = join_coverage(core_posts, sentiment)
    return covered.select(
        F.col("rows_checked").alias("posts"),
        F.col("matched").alias("scored"),
        F.col("unmatched").alias("unscored"),
        F.expr("CASE WHEN rows_checked > 0 THEN matched * 100 div rows_checked END").alias("coverage_pct"),
    )


def multilingual_coverage(core_posts: DataFrame, sentiment: DataFrame) -> DataFrame:
    """Scored posts per language other than English."""
    foreign = core_posts.filter(F.col("primary_lang") != "en").select("did", "time_us", "primary_lang")
    scored = foreign.join(sentiment.select("did", "time_us"), ["did", "time_us"], "left_semi")
    return scored.groupBy("primary_lang").agg(F.count(F.lit(1)).alias("scored_posts"))


# -- the acceptance report -----------------------------------------------------------
# Tables whose newest rows are looked at, and what makes a row of a table complete.
RECENT_BY = {"raw_events": "ingested_at", "stg_posts": "event_time", "core_posts": "event_time"}
COMPLETE = {"raw_events": ("raw_json", "collection", "did"), "core_posts": ("content_type",)}


def layer_report(tables: Mapping[str, DataFrame], as_of: Clock = None) -> DataFrame:
    """Rows of every table, recent ones, and complete ones, each PASS when above zero.

    A check is named by its table and measure.  A table's counts come from one pass over it.
    """
    parts = []
    for table in TABLES:
        counts = {"rows": F.count(F.lit(1))}
        if table in RECENT_BY:
            counts["recent"] = F.count_if(F.col(RECENT_BY[table]) > ago(as_of, minutes=5))
        if table in COMPLETE:
            counts["complete"] = F.count_if(reduce(and_, [F.col(name).isNotNull() for name in COMPLETE[table]]))
        row = tables[table].agg(*[count.alias(measure) for measure, count in counts.items()])
        pairs = [
            F.struct(F.lit(f"{table}.{measure}").alias("check_name"), F.col(measure).alias("value")) for measure in counts
        ]
        parts.append(row.select(F.inline(F.array(*pairs))))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        "check_name", "value", F.when(F.col("value") > 0, "PASS").otherwise("FAIL").alias("status")
    )
