"""Language identification by nearest centroid.

A text is the TF-IDF vector of its byte trigrams (letters in lower case, all else as
separators), hashed to ``DIMENSIONS`` and normalised.  Each language has a few centroids,
found by spherical k-means over labelled texts.  The language of the centroid with the
largest cosine is the answer, the cosine is the score.  A text is rejected if it is
farther from every centroid than labelled texts of that language, cut to about its length,
are from centroids they were not fitted with; or if it has no trigram of theirs.

Fitting uses at most about ``SAMPLE`` texts of a language, chosen by a hash of ``doc_id``
among those whose CRC-32 of ``doc_id`` modulo 4 is not 2.  That is the documented bound on
what goes to the driver; prediction covers every whole text in one narrow pass.

Defined results: a text that is null or has no letter is ``und``, score 0, and rejected.
Ties go to the first language in alphabetical order.  Without labelled texts every answer
is ``und`` and nothing with a letter is rejected.  Repeated rows each get a row.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.common import given

DIMENSIONS = 1 << 13
#: Labelled texts of a language used for fitting, centroids of a language, rounds of k-means.
SAMPLE, CENTROIDS, ROUNDS = 300, 4, 12
#: More languages are refused: fitting is on the driver.
MOST_LANGUAGES = 300
#: A text is rejected if its cosine is under this share of the cosine that all but a hundredth
#: of the labelled texts reach; at least so many texts make a limit.
QUANTILE, SHARE, ENOUGH = 0.99, 0.6, 20
UNKNOWN = "und"

#: Bytes that separate words: all ASCII but letters.
_SEPARATE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_SPACES = re.compile(rb" +")


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text: str) -> bool:
    """Whether a character is of a letter category, as the pattern ``\\p{L}`` has it."""
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed counts of the trigrams of a whole text."""
    data = _SPACES.sub(b" ", b" " + text.lower().encode("utf-8", "ignore").translate(_SEPARATE) + b" ")
    raw = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(DIMENSIONS, dtype=np.float32)
    mixed = (raw[:-2] * np.uint32(0x9E3779B1)) ^ (raw[1:-1] * np.uint32(0x85EBCA6B)) ^ (raw[2:] * np.uint32(0xC2B2AE35))
    mixed *= np.uint32(0x27D4EB2F)
    return np.bincount(mixed >> np.uint32(32 - 13), minlength=DIMENSIONS).astype(np.float32)


def length_class(sizes: np.ndarray) -> np.ndarray:
    """Texts in classes by the power of two of their trigrams."""
    return np.minimum(np.log2(np.maximum(sizes, 1)).astype(int), 15)


class CentroidModel:
    """Inverse document frequencies, centroids with their languages, and each centroid's radius by length class."""

    def __init__(self, idf: np.ndarray, centroids: np.ndarray, languages: list[str], radius: np.ndarray):
        self.idf, self.centroids, self.languages, self.radius = idf, centroids, languages, radius

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        weighted = np.log1p(rows) * self.idf
        norms = np.linalg.norm(weighted, axis=1, keepdims=True)
        return weighted / np.where(norms > 0, norms, 1)

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """Language, score and whether the text is rejected."""
        done = []
        for start in range(0, len(texts), 64):
            part = texts[start : start + 64]
            rows = np.stack([counts(text) for text in part])
            if self.languages:
                cosine = self.vectors(rows) @ self.centroids.T
                best, near = cosine.argmax(axis=1), cosine.max(axis=1)
            else:
                best, near = np.zeros(len(part), int), np.zeros(len(part))
            classes = length_class(rows.sum(axis=1))
            far = 1 - near > self.radius[best, classes] if self.languages else np.zeros(len(part), bool)
            for text, b, score, away in zip(part, best, near, far):
                if not has_letter(text):
                    done.append((UNKNOWN, 0.0, True))
                else:
                    language = self.languages[b] if self.languages else UNKNOWN
                    done.append((language, float(min(max(score, 0.0), 1.0)), bool(away)))
        return done


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, seeded by texts spread over the sample."""
    k = min(k, len(vectors))
    centres = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        nearest = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == j].sum(axis=0) if (nearest == j).any() else centres[j] for j in range(k)])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres.astype(np.float32)


def _centroids(vectors: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, list[str]]:
    found = {str(name): _clusters(vectors[names == name], CENTROIDS) for name in sorted(set(names))}
    return np.concatenate(list(found.values())), [name for name, rows in found.items() for _ in rows]


def _limit(distances: np.ndarray) -> float:
    """Where a text is too far; single labelled texts that are far off do not move it."""
    return float(1 - SHARE * (1 - np.quantile(distances, QUANTILE)))


def _radii(model: CentroidModel, texts: list[str], vectors: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The radius of each centroid for each length class.

    Each half of the texts is measured by centroids of the other half, and cut to each class
    up to its own length.  Longer texts lie nearer: a class counts for all longer ones with
    too few texts.  A language with too few in all gets the limit of all languages.
    """
    half = np.zeros(len(texts), int)
    for name in set(names):
        half[names == name] = np.arange((names == name).sum()) % 2
    other = [_centroids(vectors[half != h], names[half != h])[0] if (half != h).any() else model.centroids for h in (0, 1)]
    radius = np.full((len(model.languages), 16), np.inf)
    of = np.array(model.languages)
    last = dict.fromkeys(["", *set(names)], np.inf)
    for c in range(16):
        distance = np.full(len(texts), np.nan)
        for start in range(0, len(texts), 256):
            part = range(start, min(start + 256, len(texts)))
            cut = None if c == 15 else 3 * (1 << c) // 2
            rows = np.stack([counts(texts[i].encode("utf-8", "ignore")[:cut].decode("utf-8", "ignore")) for i in part])
            at = np.flatnonzero(length_class(rows.sum(axis=1)) == c)
            if not len(at):
                continue
            own = model.vectors(rows[at])
            cosine = np.stack([(own @ centres.T).max(axis=1) for centres in other])
            distance[start + at] = 1 - cosine[half[start + at], np.arange(len(at))]
        known = ~np.isnan(distance)
        for name in last:
            chosen = known if name == "" else known & (names == name)
            if chosen.sum() >= ENOUGH:
                last[name] = _limit(distance[chosen])
        for name in set(names):
            found = last[name] if last[name] < np.inf else last[""]
            radius[of == name, c] = min(found, 1 - 1e-6)  # no labelled trigram at all is always too far
    return radius


def fit(labelled: list[tuple[str, str]]) -> CentroidModel:
    """A model from ``(language, text)`` pairs."""
    labelled = sorted(pair for pair in labelled if has_letter(pair[1]))
    if not labelled:
        return CentroidModel(np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS)), [], np.zeros((0, 16)))
    rows = np.stack([counts(text) for _, text in labelled])
    idf = (np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.1).astype(np.float32)
    model = CentroidModel(idf, np.zeros((0, DIMENSIONS)), [], np.zeros((0, 16)))
    vectors = model.vectors(rows).astype(np.float32)
    names = np.array([language for language, _ in labelled])
    model.centroids, model.languages = _centroids(vectors, names)
    model.radius = _radii(model, [text for _, text in labelled], vectors, names)
    return model


def train(docs: DataFrame, sample: int = SAMPLE) -> CentroidModel:
    """Fit on about ``sample`` labelled texts of each language, chosen by hash."""
    usable = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = usable.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return fit([])
    share = F.lit(0.0)
    for row in sizes:
        share = F.when(F.col("lang") == row["lang"], min(1.0, sample / row["count"])).otherwise(share)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "text"), F.lit(1_000_000)) / 1e6
    most = 2 * sample * len(sizes)  # the hash gives about half of it
    chosen = usable.filter(place < share).select("lang", "text", place.alias("place")).orderBy("place").limit(most)
    return fit([(row["lang"], row["text"]) for row in chosen.toLocalIterator()])


def predictor(model: CentroidModel):
    """``text`` column to ``lang_pred, score, rejected``."""

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            model.predict([text or "" for text in texts]), columns=["lang_pred", "score", "rejected"]
        )

    return predict


def identify(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every row of ``docs``."""
    return docs.select(
        "doc_id", held_out().alias("held_out"), predictor(model)(F.col("text")).alias("found")
    ).select("doc_id", "held_out", "found.lang_pred", "found.score", "found.rejected")


def drop_rejected(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns unchanged."""
    rows = docs.select(F.struct("*").alias("row"), predictor(model)(F.col("text")).alias("found"))
    return rows.filter(~F.col("found.rejected")).select("row.*")


def op1_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = given(spark, folder, "documents")
    return identify(docs, train(docs.select("doc_id", "text", "lang")))
