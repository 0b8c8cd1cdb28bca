
from conftest import at, event
from pyspark.sql import functions as F

from driftlake.operators import quality
from driftlake.schemas import LIKE, POST, PROFILE, TABLES
from driftlake.sources import events


def empty_tables(rows, **given):
    return {name: rows(name, *given.get(name, ())) for name in TABLES}


def test_freshness(rows):
    tables = empty_tables(
        rows,
        raw_events=[{"ingested_at": at("11:59:50.5")}],
        core_hashtags=[{"tag": "t", "author_did": "a", "event_time": at("11:58:30")}],
    )
    got = {r.check_name: (r.value_num, r.status) for r in quality.lake_freshness(tables, at("12:00:00")).collect()}
    assert got == {
        "quality.raw_events.freshness_s": (9.5, "ok"),
        "quality.mart_trending_hashtags.freshness_s": (120.0, "ok"),
    }
    late = quality.lake_freshness(tables, at("12:00:06")).collect()
    assert {r.status for r in late} == {"breach"}
    assert {r.status for r in quality.lake_freshness(empty_tables(rows), at("12:00:00")).collect()} == {"breach"}


def test_null_rate(spark):
    df = spark.createDataFrame([(None,)] + [("x",)] * 999, "did string")
    assert quality.null_rate(df, "did").first().asDict() == {
        "rows_checked": 1000, "null_ratio": 0.001, "status": "ok",
    }
    assert quality.null_rate(df, "did", 0.0).first().status == "breach"
    assert quality.null_rate(df.limit(0), "did").first().null_ratio == 0.0


def test_validity(rows):
    tables = empty_tables(
        rows,
        raw_events=[{"kind": "commit"}, {"kind": "nonsense"}],
        core_posts=[{"primary_lang": "en"}, {"primary_lang": "pt-BR"}, {"primary_lang": "unknown"}, {"primary_lang": "EN!"}],
        core_post_sentiment=[
            {"sentiment_positive": 0.5, "sentiment_negative": 0.5, "sentiment_neutral": 0.0},
            {"sentiment_positive": 1.5, "sentiment_negative": 0.5, "sentiment_neutral": 0.0},
            {},
        ],
        stg_posts=[{"event_time": at("12:59:59")}, {"event_time": at("13:00:01")}],
    )
    got = {r.rule: (r.rows_checked, r.violations) for r in quality.validity(tables, at("12:00:00")).collect()}
    assert got == {
        "raw_events.kind_whitelist": (2, 1),
        "core_posts.lang_code_valid": (4, 1),
        "core_post_sentiment.score_range": (3, 2),
        "stg_posts.event_time_sanity": (2, 1),
    }


def test_score_validity(rows):
    good = {"sentiment_positive": 0.5, "sentiment_negative": 0.3, "sentiment_neutral": 0.2, "sentiment_label": "positive",
            "sentiment_confidence": 0.5}
    scores = rows(
        "core_post_sentiment", good, {**good, "sentiment_neutral": 0.3}, {**good, "sentiment_label": None},
        {**good, "sentiment_confidence": 0.2}, {**good, "sentiment_label": "neutral"},
    )
    assert quality.score_validity(scores).first().asDict() == {
        "rows_checked": 5, "bad_sums": 1, "null_labels": 1, "labels_seen": 2, "bad_confidence": 1,
    }


def test_schema_drift(spark):
    lines = [
        event(collection=POST, operation="create", record={"text": "x", "langs": ["a"], "mystery": {"a": 1}}),
        event(collection=POST, operation="create", record={"text": 5, "mystery": None, "flag": True}),
        event(collection=PROFILE, operation="create", record={"displayName": "n", "pinnedPost": "p"}),
        event(collection=LIKE, operation="delete"),
        event(kind="identity"),
        "broken",
    ]
    raw = spark.createDataFrame([(line,) for line in lines], "raw_json string").withColumn(
        "collection", F.get_json_object("raw_json", "$.commit.collection")
    )
    drift = {(r.collection, r.key, r.value_type): r.records for r in quality.schema_drift(raw).collect()}
    assert drift == {
        (POST, "mystery", "object"): 1,
        (POST, "mystery", "void"): 1,
        (POST, "flag", "boolean"): 1,
        (PROFILE, "pinnedPost", "string"): 1,
    }
    kinds = {r.value_type for r in quality.record_keys(raw).filter("key = 'text'").collect()}
    assert kinds == {"string", "bigint"}


def test_duplicates(rows):
    raw = rows("raw_events", {"time_us": 1}, {"time_us": 1}, {"time_us": 1}, {"time_us": 2})
    assert quality.duplicate_ratio(raw).first().asDict() == {
        "rows_checked": 4, "distinct_keys": 2, "duplicate_rows": 2, "duplicate_ratio": 0.5,
    }
    assert quality.duplicate_ratio(raw.limit(0)).first().duplicate_ratio == 0.0
    assert events.drop_replayed(raw).count() == 2


def test_deduplicate_keeps_the_earliest(rows):
    follows = rows(
        "stg_follows",
        {"time_us": 1, "rkey": "r", "subject_did": "late", "ingested_at": at("10:00:01")},
        {"time_us": 1, "rkey": "r", "subject_did": "early", "ingested_at": at("10:00:00")},
        {"time_us": 1, "rkey": "s", "subject_did": "other"},
    )
    kept = quality.deduplicate(follows)
    assert kept.columns == follows.columns
    assert sorted(r.subject_did for r in kept.collect()) == ["early", "other"]


def test_copies_fold_before_the_shuffle(rows):
    plan = quality.deduplicate(rows("stg_follows", {}))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_coverage(rows):
    posts = rows("core_posts", *[{"time_us": n, "primary_lang": lang} for n, lang in enumerate(["en", "ja", "de"])])
    scores = rows("core_post_sentiment", {"time_us": 0}, {"time_us": 1}, {"time_us": 1})
    assert quality.sentiment_coverage(posts, scores).first().asDict() == {
        "posts": 3, "scored": 2, "unscored": 1, "coverage_pct": 66,
    }
    assert [r.time_us for r in quality.missing_rows(posts, scores).collect()] == [2]
    assert [(r.primary_lang, r.scored_posts) for r in quality.multilingual_coverage(posts, scores).collect()] == [("ja", 1)]
    assert quality.sentiment_coverage(posts.limit(0), scores).first().coverage_pct is None


def test_routing(rows):
    tables = empty_tables(
        rows,
        raw_events=[{"collection": POST}, {"collection": POST}, {"collection": "else"}, {"kind": "identity"}],
        stg_posts=[{}],
        stg_likes=[{}],
    )
    got = {r.collection: (r.raw_rows, r.staged_rows, r.missing, r.is_routed) for r in quality.routing_completeness(tables).collect()}
    assert got == {POST: (2, 1, 1, True), "else": (1, 0, 1, False), LIKE: (0, 1, -1, True)}


def test_layer_report(rows):
    tables = empty_tables(rows, raw_events=[{"collection": POST, "ingested_at": at("11:56:00")}, {}])
    got = {r.check_name: (r.value, r.status) for r in quality.layer_report(tables, at("12:00:00")).collect()}
    assert got["raw_events.rows"] == (2, "PASS")
    assert got["raw_events.recent"] == (1, "PASS")
    assert got["raw_events.complete"] == (1, "PASS")
    assert got["core_posts.rows"] == (0, "FAIL")
    assert len(got) == 17


def test_mart_delta(spark, rows):
    mart = spark.createDataFrame([(3,), (4,)], "count long")
    core = rows("core_posts", {}, {}, {})
    assert quality.row_delta(mart, core).first().asDict() == {"mart_rows": 7, "core_rows": 3, "delta": 4}


def test_row_delta_takes_the_span_of_the_mart(spark):
    core = spark.createDataFrame([(at("10:00:00"),), (at("12:00:00"),)], "event_time timestamp")
    mart = spark.createDataFrame([(1,)], "count bigint")
    got = quality.row_delta(mart, core, since=F.lit(at("11:00:00"))).first()
    assert (got.mart_rows, got.core_rows, got.delta) == (1, 1, 0)
