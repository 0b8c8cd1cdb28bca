"""Scoring posts: a native lexicon scorer and a hook for any batch model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlake.functions import sentiment
from driftlake.schemas import TABLES

PASSED_THROUGH = ("did", "time_us", "event_time", "rkey", "text")

# A model maps a list of texts to one ``{label: score}`` mapping per text.
Model = Callable[[list[str]], Sequence[dict[str, float]]]


def score_posts(
    core_posts: DataFrame,
    stamp: Column | None = None,
    positive: Sequence[str] = sentiment.POSITIVE_WORDS,
    negative: Sequence[str] = sentiment.NEGATIVE_WORDS,
) -> DataFrame:
    """Lexicon scores for whole texts, as plain column expressions."""
    posts = core_posts.select(
        *PASSED_THROUGH, (F.current_timestamp() if stamp is None else stamp).alias("ingested_at")
    )
    return shape_scores(sentiment.with_lexicon_scores(posts, "text", positive, negative))


def shape_scores(scored: DataFrame) -> DataFrame:
    """Spread a ``_scores`` struct into the table's score, label and confidence columns."""
    scores = F.col("_scores")
    return scored.select(
        *PASSED_THROUGH,
        scores["positive"].alias("sentiment_positive"),
        scores["negative"].alias("sentiment_negative"),
        scores["neutral"].alias("sentiment_neutral"),
        sentiment.top_label(scores).alias("sentiment_label"),
        sentiment.top_score(scores).alias("sentiment_confidence"),
        "ingested_at",
    )


# How many texts a model is given at once.
MODEL_BATCH = 64

# Models loaded by this Python worker, by name and loader; workers are reused across batches.
_LOADED: dict[tuple[str, str], Model] = {}


def _loaded(key: tuple[str, str], loader: Callable[[], Model]) -> Model:
    if key not in _LOADED:
        _LOADED[key] = loader()
    return _LOADED[key]


def make_scorer(loader: Callable[[], Model], key: str, batch_size: int = MODEL_BATCH):
    """A ``mapInPandas`` function that loads its model once per worker.

    The model gets at most ``batch_size`` texts at once.  Two loaders share a model only if
    both their keys and what they are made of are equal.
    """
    identity = (key, hashlib.sha256(cloudpickle.dumps(loader)).hexdigest())

    def score(batches):
        import pandas as pd

        names = [*PASSED_THROUGH, "prepared", "ingested_at"]
        for batch in batches:
            if batch.empty:
                continue
            model, texts = _loaded(identity, loader), batch["prepared"].tolist()
            rows = [
                {label.lower(): float(value) for label, value in result.items()}
                for start in range(0, len(texts), batch_size)
                for result in model(texts[start : start + batch_size])
            ]
            best = [max(row, key=row.get) for row in rows]
            output = {name: batch[name] for name in names if name != "prepared"}
            for label in sentiment.LABELS:
                output[f"sentiment_{label}"] = [row.get(label, 0.0) for row in rows]
            output["sentiment_label"] = best
            output["sentiment_confidence"] = [row[label] for row, label in zip(rows, best)]
            yield pd.DataFrame(output, index=batch.index)[TABLES["core_post_sentiment"].schema.names]

    return score


def score_with_model(
    core_posts: DataFrame,
    loader: Callable[[], Model],
    key: str,
    stamp: Column | None = None,
    partitions: int | None = None,
    batch_size: int = MODEL_BATCH,
) -> DataFrame:
    """Score posts with the model ``loader`` returns, at most ``batch_size`` texts at once.

    Only the needed columns cross to Python, and the text is prepared before it does.
    ``partitions`` narrows the stage where a scarce device holds the model: so many tasks stream
    through the input's partitions, and no text is shuffled.  What makes the input is narrowed with
    it and a task's share grows with the table, so it is for micro-batches; a whole table goes
    through them by ``start_rounds``.  Without it the scoring is as wide as its input.
    """
    narrow = core_posts.select(
        *PASSED_THROUGH,
        sentiment.prepare_text(F.col("text")).alias("prepared"),
        (F.current_timestamp() if stamp is None else stamp).alias("ingested_at"),
    )
    if partitions:
        narrow = narrow.coalesce(partitions)
    return narrow.mapInPandas(make_scorer(loader, key, batch_size), TABLES["core_post_sentiment"].schema)
