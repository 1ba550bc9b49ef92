"""Language identification by nearest centroid over TF-IDF vectors of letter trigrams.

Document frequencies are counted over all labelled texts, in Spark. Centroids are fitted on ``PER_LANGUAGE`` labelled
texts of each language at most: their mean and the ``CLUSTERS`` that k-means splits them into. A text gets the language of the
centroid with the largest cosine. It is rejected when that cosine, over the root of its number of different trigrams, is
below ``FAR`` times the first percentile of fitted texts of like size: a short text is far from any centroid.

Defined results. Null texts and texts without a letter are ``und`` with score 0, and rejected. Where nothing can be
learned, every text is. Ties go to the language that sorts first. Rows keep all their columns; the results replace
columns of their names. Repeated rows each count.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import over_texts, spare
from uttera.session import materialize

DIMENSIONS = 4096
PER_LANGUAGE = 600
CLUSTERS = 4
ROUNDS = 12
FAR = 0.3
#: Fitted texts that a size class, a power of two of different trigrams, needs for a limit of its own.
CLASS_TEXTS = 20
UNKNOWN = "und"
#: ASCII letters as lower case; other ASCII as a space; bytes of other letters as they are.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def gram_counts(text: bytes | None) -> np.ndarray:
    """How often the whole text has the byte trigrams of each of the hashed dimensions."""
    codes = np.frombuffer(b" " + (text or b"").translate(_FOLD) + b" ", np.uint8).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(DIMENSIONS)
    grams = codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]
    grams = grams[grams != 0x202020]
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS).astype(float)


def has_letter(text: bytes | None) -> bool:
    return text is not None and any(map(str.isalpha, text.decode("utf-8", "ignore")))


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(counts) * idf
    return weighted / max(np.sqrt((weighted * weighted).sum()), 1e-12)


def inverse_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Over all texts: each task sums up its own, the sums meet in one row per dimension."""

    def count(batches):
        total, rows = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for value in batch["text"]:
                total += gram_counts(value) > 0
                rows += 1
        if rows:
            yield pd.DataFrame({"at": np.arange(-1, DIMENSIONS), "n": np.append(rows, total)})

    binary = docs.select(F.col(text).cast("binary").alias("text"))
    sums = binary.mapInPandas(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(sums["at"], sums["n"], strict=True))
    rows = found.pop(-1, 0)
    present = np.array([found.get(i, 0) for i in range(DIMENSIONS)])
    return np.log((1 + rows) / (1 + present)) + 0.1


def cluster(points: np.ndarray, count: int) -> np.ndarray:
    """Unit centroids by k-means on the sphere; starts are chosen far from each other."""
    centres = [points.mean(axis=0)]
    for _ in range(min(count, len(points)) - 1):
        near = np.max(points @ np.array([c / max(np.linalg.norm(c), 1e-12) for c in centres]).T, axis=1)
        centres.append(points[int(np.argmin(near))])
    centres = np.array(centres)
    for _ in range(ROUNDS):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        own = np.argmax(points @ centres.T, axis=1)
        centres = np.array([points[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def limits(nearness: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least nearness by size class; classes of too few texts take the next larger one's, the largest a falling one."""
    classes = [int(size).bit_length() for size in sizes]
    found = np.full(DIMENSIONS.bit_length() + 1, np.nan)
    for k in range(len(found)):
        own = nearness[np.array(classes) == k]
        if len(own) >= CLASS_TEXTS:
            found[k] = FAR * np.percentile(own, 1)
    if np.isnan(found).all():
        found[-1] = FAR * nearness.min()
    for k in range(len(found) - 2, -1, -1):
        found[k] = found[k + 1] if np.isnan(found[k]) else found[k]
    for k in range(1, len(found)):
        found[k] = found[k - 1] / np.sqrt(2) if np.isnan(found[k]) else found[k]
    return found


class Centroids:
    """Several unit vectors per language, and how near to them a text of some size must be."""

    def __init__(self, samples: Iterable[tuple[str, np.ndarray]], idf: np.ndarray):
        """``samples``: a language and its texts' vectors at a time, of which only the centroids are kept."""
        self.idf, self.languages = idf.astype(np.float32), []
        centres, nearness, sizes = [], [], []
        for language, points in samples:
            own = np.vstack([cluster(points, 1), cluster(points, CLUSTERS)])
            cosines = np.max(points @ own.T, axis=1)
            centres.append(own)
            self.languages += [language] * len(own)
            size = (points > 0).sum(axis=1)
            nearness.append(cosines / np.sqrt(np.maximum(size, 1)))
            sizes.append(size)
        self.centres = np.concatenate(centres).astype(np.float32) if centres else np.zeros((0, len(idf)), np.float32)
        self.limits = limits(np.concatenate(nearness), np.concatenate(sizes)) if centres else np.zeros(1)

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        own = vector(gram_counts(text), self.idf).astype(np.float32)
        cosines = self.centres @ own
        best = int(np.argmax(cosines))
        score = float(min(max(cosines[best], 0.0), 1.0))
        size = max(1, int((own > 0).sum()))
        return self.languages[best], score, bool(score / np.sqrt(size) < self.limits[min(size.bit_length(), len(self.limits) - 1)])


def fit(docs: DataFrame, text: str = "text", language: str = "lang") -> Centroids:
    """From the rows of ``docs`` with a text and a language."""
    spark = docs.sparkSession
    known = docs.select(F.col(text).alias("text"), F.col(language).alias("lang")).filter("text is not null and lang is not null")
    idf = inverse_frequencies(known)
    # Copies count once: the share is of different texts, as is what it draws.
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)
    texts = materialize(known.select("lang", F.xxhash64("text").alias("h"), place.alias("draw")).distinct().drop("h"), "texts")
    sizes = dict(texts.groupBy("lang").count().collect())
    if not sizes:
        return Centroids([], idf)

    def share(sizes: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, 2.0 * PER_LANGUAGE / n)])[F.col("lang")]

    # Twice as many as needed by hash, then exactly as many: no language is ever gathered whole.
    got = dict(texts.filter(F.col("draw") < share(sizes)).groupBy("lang").count().collect())
    # Where the hash draws too few, all are taken.
    sizes = {lang: n if got.get(lang, 0) >= PER_LANGUAGE else min(n, PER_LANGUAGE) for lang, n in sizes.items()}
    drawn = known.withColumn("draw", place)
    drawn = drawn.filter((F.col("draw") < share(sizes)) | (share(sizes) >= 1))

    def batch(texts):
        return ((vector(gram_counts(t), idf).astype(np.float32).tobytes(),) for t in texts)

    vectors = drawn.select("lang", "draw", over_texts(spark, batch, "v binary")(F.col("text")).alias("s")).select("lang", "draw", "s.v").distinct()
    vectors = materialize(vectors, "vectors")

    def samples() -> Iterator[tuple[str, np.ndarray]]:
        for lang in sorted(sizes):
            rows = vectors.filter(F.col("lang") == lang).orderBy("draw", "v").limit(PER_LANGUAGE).select("v").toPandas()
            if len(rows):
                yield lang, np.array([np.frombuffer(v, np.float32) for v in rows["v"]], float)

    return Centroids(samples(), idf)


def identify(docs: DataFrame, model: Centroids, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``rejected``."""

    def batch(texts):
        return map(model.predict, texts)

    found = over_texts(docs.sparkSession, batch, "lang_pred string, score double, rejected boolean")(F.col(text))
    held = spare(docs, "_found")
    named = {name: F.col(f"{held}.{name}") for name in ("lang_pred", "score", "rejected")}
    return docs.withColumn(held, found).withColumns(named).drop(held)
