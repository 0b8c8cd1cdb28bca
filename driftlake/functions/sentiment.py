"""Text preparation and sentiment scores as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the scored text shows in place of handles and links.  White space
# is the Unicode kind, plus the four information separators.
MENTION_TEXT = r"(?U)@[^\s\x1c-\x1f]+"
URL_TEXT = r"(?U)https?://[^\s\x1c-\x1f]+"
MENTION_MARK = "@user"
URL_MARK = "http"

LABELS = ("positive", "negative", "neutral")

# A small default lexicon; any other pair of word lists can be passed instead.
POSITIVE_WORDS = ("good", "great", "love", "happy", "best", "nice", "thanks", "win", "beautiful", "fun")
NEGATIVE_WORDS = ("bad", "hate", "sad", "worst", "awful", "angry", "fail", "wrong", "broken", "ugly")


def prepare_text(text: Column) -> Column:
    """The text a scorer sees: no handles, no links, never NULL.

    A plain search comes before each pattern, as few texts hold either.
    """
    whole = F.coalesce(text, F.lit(""))
    handles = F.when(whole.contains("@"), F.regexp_replace(whole, MENTION_TEXT, MENTION_MARK)).otherwise(whole)
    linked = handles.contains("http://") | handles.contains("https://")
    return F.when(linked, F.regexp_replace(handles, URL_TEXT, URL_MARK)).otherwise(handles)


def lexicon_words(text: Column, positive: Sequence[str], negative: Sequence[str]) -> Column:
    """The lexicon's words in the whole text, in one pass over it."""
    words = "|".join(re.escape(word.lower()) for word in [*positive, *negative])
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(?<![a-z])({words})(?![a-z])"), F.lit(1))


def words_lead(found: Column, positive: Sequence[str]) -> Column:
    """Positive minus negative words."""
    hits = F.filter(found, lambda word: word.isin([known.lower() for known in positive]))
    return F.size(hits) * F.lit(2) - F.size(found)


def lead_scores(lead: Column) -> Column:
    """Three scores that sum to one, as ``struct<positive, negative, neutral>``.

    The larger count pulls its score towards one; equal counts leave neutral on top.
    """
    whole = F.abs(lead) + F.lit(2.0)
    return F.struct(
        ((F.greatest(lead, F.lit(0)) + F.lit(0.5)) / whole).alias("positive"),
        ((F.greatest(-lead, F.lit(0)) + F.lit(0.5)) / whole).alias("negative"),
        (F.lit(1.0) / whole).alias("neutral"),
    )


def with_lexicon_scores(
    df: DataFrame,
    text: str = "text",
    positive: Sequence[str] = POSITIVE_WORDS,
    negative: Sequence[str] = NEGATIVE_WORDS,
    name: str = "_scores",
) -> DataFrame:
    """Add the scores of a text column, step by step so that each step is computed once."""
    prepared = df.withColumn("_prepared", prepare_text(F.col(text)))
    found = prepared.withColumn("_found", lexicon_words(F.col("_prepared"), positive, negative))
    led = found.withColumn("_lead", words_lead(F.col("_found"), positive))
    return led.withColumn(name, lead_scores(F.col("_lead"))).drop("_prepared", "_found", "_lead")


def top_label(scores: Column) -> Column:
    """Name of the highest score; on a tie the first of positive, negative, neutral."""
    best = F.greatest(*[scores[name] for name in LABELS])
    chain = F.when(scores[LABELS[0]] == best, LABELS[0]).when(scores[LABELS[1]] == best, LABELS[1])
    return F.when(best.isNotNull(), chain.otherwise(LABELS[2]))


def top_score(scores: Column) -> Column:
    return F.greatest(*[scores[name] for name in LABELS])
