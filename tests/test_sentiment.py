import re

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftlake.functions import sentiment as text
from driftlake.operators import sentiment
from driftlake.schemas import TABLES
from driftlake.streaming import layers


def prepared(spark, *values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, text string")
    return [row.p for row in df.select("n", text.prepare_text(F.col("text")).alias("p")).orderBy("n").collect()]


def test_handles_and_links(spark):
    got = prepared(
        spark, None, "", "hi @bob.example, see https://e.org/x?y and http://z", "mail a@b c", "http:/ no", "@a b @",
        "@é　x"
    )
    assert got == ["", "", "hi @user see http and http", "mail a@user c", "http:/ no", "@user b @", "@user　x"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("a@:/ht ps\t\n\x1c\x85  　é."), max_size=30), min_size=20, max_size=20))
def test_prepared_text_matches_python_patterns(spark, values):
    def reference(value):
        return re.sub(r"https?://\S+", "http", re.sub(r"@\S+", "@user", value))

    assert prepared(spark, *values) == [reference(value) for value in values]


def scored(spark, rows, value):
    posts = rows("core_posts", {"text": value})
    return sentiment.score_posts(posts, positive=("good",), negative=("bad", "sad")).first()


def test_lexicon_scores(spark, rows):
    neutral = scored(spark, rows, "good bad")
    assert (neutral.sentiment_label, neutral.sentiment_confidence) == ("neutral", 0.5)
    happy = scored(spark, rows, "Good, GOOD; goodness")
    assert (happy.sentiment_label, happy.sentiment_positive) == ("positive", 2.5 / 4)
    gloomy = scored(spark, rows, "sad1bad_bad")
    assert (gloomy.sentiment_label, gloomy.sentiment_negative) == ("negative", 3.5 / 5)
    for row in (neutral, happy, gloomy, scored(spark, rows, None)):
        assert abs(row.sentiment_positive + row.sentiment_negative + row.sentiment_neutral - 1) < 1e-12


def test_words_late_in_a_long_text_count(spark, rows):
    assert scored(spark, rows, "x " * 50_000 + "bad").sentiment_label == "negative"


def test_score_schema(spark, rows):
    got = sentiment.score_posts(rows("core_posts", {"text": "x"})).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in TABLES["core_post_sentiment"].schema]


def test_model_hook_maps_labels_of_either_case():
    loads = []

    def loader():
        loads.append(1)
        return lambda texts: [{"Positive": 0.2, "negative": 0.7, "Neutral": 0.1} for _ in texts]

    score = sentiment.make_scorer(loader, "test-hook")
    batch = pd.DataFrame(
        {"did": ["a"], "time_us": [1], "event_time": [pd.Timestamp(0)], "rkey": ["r"], "text": ["t"],
         "prepared": ["t"], "ingested_at": [pd.Timestamp(0)]}
    )
    results = list(score([batch, batch.iloc[:0], batch]))
    assert len(results) == 2 and loads == [1]
    row = results[0].iloc[0]
    assert (row.sentiment_label, row.sentiment_confidence, row.sentiment_positive) == ("negative", 0.7, 0.2)
    assert list(results[0].columns) == TABLES["core_post_sentiment"].schema.names


def test_models_get_small_batches_and_are_told_apart():
    sizes = []

    def loader(lead):
        def load():
            return lambda texts: sizes.append(len(texts)) or [{"positive": lead, "negative": 1 - lead, "neutral": 0} for _ in texts]

        return load

    frame = pd.DataFrame({name: ["x"] * 10 for name in ("did", "time_us", "event_time", "rkey", "text", "prepared", "ingested_at")})
    labels = [
        next(sentiment.make_scorer(loader(lead), "same key", 4)(iter([frame]))).sentiment_label[0] for lead in (0.9, 0.1, 0.9)
    ]
    assert labels == ["positive", "negative", "positive"]
    assert sizes[:3] == [4, 4, 2] and max(sizes) == 4


def test_model_hook_on_spark(spark, rows):
    from driftlake_checks.queries import lexicon_model, ship_package

    ship_package(spark)
    posts = rows("core_posts", {"time_us": 1, "text": "good @x"}, {"time_us": 2, "text": None})
    got = sentiment.score_with_model(posts, lexicon_model(("good",), ("bad",)), "t", partitions=1)
    assert got.rdd.getNumPartitions() == 1
    assert {row.time_us: row.sentiment_label for row in got.collect()} == {1: "positive", 2: "neutral"}
    assert sentiment.score_with_model(posts.limit(0), lexicon_model((), ()), "t").count() == 0


def test_few_devices_shuffle_no_text(spark, rows):
    posts = rows("core_posts", *[{"time_us": n, "text": "x"} for n in range(20)]).repartition(8).localCheckpoint()
    got = sentiment.score_with_model(posts, lambda: lambda texts: [{"Neutral": 1.0} for _ in texts], "t", partitions=2)
    assert got.rdd.getNumPartitions() == 2 and got.count() == 20
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 30, 90])
def test_rounds_stay_as_large_while_the_table_grows(spark, rows, tmp_path, n):
    def scorer(posts):
        scored = sentiment.score_with_model(
            posts, lambda: lambda texts: [{"Neutral": 1.0} for _ in texts], "t", partitions=2
        )
        return scored.withColumn("task", F.spark_partition_id())

    posts = rows("core_posts", {"time_us": -1}, *[{"time_us": k, "text": "x"} for k in range(n)])
    posts = posts.filter("time_us >= 0").repartition(3)
    running = layers.start_rounds(posts, scorer, 2, str(tmp_path), rows=4, files=2)
    running.awaitTermination()
    assert max((progress.numInputRows for progress in running.recentProgress), default=0) <= 2 * 2 * 4
    scored = spark.read.parquet(str(tmp_path / "scored")).collect()
    assert sorted(row.time_us for row in scored) == list(range(n)) and {row.task for row in scored} <= {0, 1}


def test_devices_score_in_rounds(spark, monkeypatch):
    from driftlake_checks.queries import REGISTRY

    start, started, folder = layers.start_rounds, [], "/root/testdata/sf0.001"

    def small(*given):
        started.append(start(*given, rows=10, files=1))
        return started[-1]

    monkeypatch.setattr(layers, "start_rounds", small)
    got = REGISTRY["score_with_model_on_devices"](spark, folder).collect()
    whole = REGISTRY["score_with_model"](spark, folder).groupBy("sentiment_label").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    sizes = [progress.numInputRows for progress in started[0].recentProgress]
    assert max(sizes) <= 40 < sum(sizes) == sum(row["count"] for row in whole)
