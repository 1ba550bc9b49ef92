"""A quality classifier: a byte-level convolutional network in NumPy.

Bytes are embedded, learned filters slide over them with a stride, each filter's maximum is taken per overlapping chunk,
and the chunks' mean and greatest maxima give one probability. The chunks cover the whole text. It is fitted on
``PER_CLASS`` labelled texts of each class at most; of one longer than ``FIT_BYTES`` bytes it sees ``SEGMENTS`` equal
segments that are spread evenly from its beginning to its end, ``FIT_BYTES`` in all. Scoring reads whole texts of any length,
``PIECE`` bytes at a time.

Defined results. Null and empty texts score as a text of no bytes. Labels of rows that are not in the table, and labels
other than 0 and 1, count for nothing. Of several texts with one id the smallest is fitted. If either class has no labelled
text, every score is the share of good labels, or one half without any. Rows keep their columns; results replace columns of
their names.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import over_texts
from uttera.session import materialize

EMBEDDING, WIDTH, STRIDE, FILTERS = 4, 8, 2, 16
#: Windows per block; a chunk is two neighbouring blocks, so chunks overlap by half.
BLOCK = 128
PER_CLASS, FIT_BYTES, SEGMENTS = 1000, 1 << 16, 16
PIECE = 1 << 18
EPOCHS, MINIBATCH, RATE = 10, 32, 0.01
_SPAN = BLOCK * STRIDE


def padded(text: bytes) -> bytes:
    """Whole blocks that end in zeros, so that no window reads another text, and room for the last window."""
    return text + bytes(-(len(text) + WIDTH) % _SPAN + 2 * WIDTH)


class Network:
    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        self.p = {
            "embedding": random.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            "filters": random.normal(0, 0.2, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "head": random.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "shift": np.zeros(1, np.float32),
        }
        self.prior = 0.5
        self.fitted = False

    def blocks(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest response and its window per block; in the last ``WIDTH`` bytes no window starts."""
        count = (len(codes) - WIDTH) // _SPAN
        flat = self.p["embedding"][codes].reshape(-1)
        step = STRIDE * EMBEDDING * 4
        windows = np.lib.stride_tricks.as_strided(flat, (count * BLOCK, WIDTH * EMBEDDING), (step, 4))
        responses = (windows @ self.p["filters"]).reshape(count, BLOCK, FILTERS)
        best = responses.argmax(axis=1)
        return np.take_along_axis(responses, best[:, None], 1)[:, 0], best

    def scan(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per block, however long the text: a piece at a time is spread out."""
        found = [self.blocks(codes[a : a + PIECE + WIDTH]) for a in range(0, len(codes) - WIDTH, PIECE)]
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def maxima(self, text: bytes) -> np.ndarray:
        return self.scan(np.frombuffer(padded(text), np.uint8))[0]

    def pooled(self, maxima: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks and the two pooled vectors, joined."""
        chunks = np.maximum(maxima[:-1], maxima[1:]) if len(maxima) > 1 else maxima
        chunks = np.maximum(chunks + self.p["bias"], 0)
        return chunks, np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])

    def probability(self, text: bytes | None) -> float:
        if not self.fitted:
            return self.prior
        _, features = self.pooled(self.maxima(text or b""))
        logit = float(features @ self.p["head"] + self.p["shift"][0])
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))

    def gradients(self, text: bytes, label: float) -> tuple[dict[str, np.ndarray], float]:
        codes = np.frombuffer(padded(text), np.uint8)
        maxima, windows = self.scan(codes)
        chunks, features = self.pooled(maxima)
        probability = 1 / (1 + np.exp(-np.clip(features @ self.p["head"] + self.p["shift"][0], -30, 30)))
        slope = np.float32(probability - label)
        towards = slope * self.p["head"]
        by_chunk = np.repeat(towards[None, :FILTERS] / len(chunks), len(chunks), axis=0)
        by_chunk[chunks.argmax(axis=0), np.arange(FILTERS)] += towards[FILTERS:]
        by_chunk *= chunks > 0
        by_block = np.zeros_like(maxima)
        if len(maxima) > 1:
            first = maxima[:-1] >= maxima[1:]
            by_block[:-1] += by_chunk * first
            by_block[1:] += by_chunk * ~first
        else:
            by_block += by_chunk
        block, filters = np.nonzero(by_block)
        at = (block * BLOCK + windows[block, filters]) * STRIDE
        seen = codes[at[:, None] + np.arange(WIDTH)]
        inputs = self.p["embedding"][seen].reshape(len(at), WIDTH * EMBEDDING)
        weights = by_block[block, filters][:, None]
        gradient = {
            "head": slope * features,
            "shift": np.array([slope]),
            "bias": by_chunk.sum(axis=0),
            "filters": np.zeros_like(self.p["filters"]),
            "embedding": np.zeros_like(self.p["embedding"]),
        }
        np.add.at(gradient["filters"].T, filters, weights * inputs)
        back = (weights * self.p["filters"].T[filters]).reshape(-1, EMBEDDING)
        np.add.at(gradient["embedding"], seen.reshape(-1), back)
        return gradient, float(probability)

    def fit(self, texts: list[bytes], labels: np.ndarray, seed: int = 5) -> "Network":
        """Adam over minibatches in a fixed random order; the classes count alike."""
        self.fitted = True
        random = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
        step = 0
        for epoch in range(EPOCHS):
            order = random.permutation(len(texts))
            for at in range(0, len(order), MINIBATCH):
                step += 1
                total = {k: np.zeros_like(v) for k, v in self.p.items()}
                rows = order[at : at + MINIBATCH]
                for i in rows:
                    gradient, _ = self.gradients(texts[i], labels[i])
                    for k, v in gradient.items():
                        total[k] += np.float32(weight[i]) * v
                rate = RATE * (1 - epoch / EPOCHS) + 1e-4
                for k in self.p:
                    mean = total[k] / len(rows)
                    first[k] = 0.9 * first[k] + 0.1 * mean
                    second[k] = 0.99 * second[k] + 0.01 * mean * mean
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        return self


def excerpt(text: Column, most: int = FIT_BYTES, segments: int = SEGMENTS) -> Column:
    """The bytes of a text, or of a longer one evenly spaced segments over its whole length."""
    size = most // segments
    step = (F.length(text) - size) / (segments - 1)
    parts = [text.substr((F.floor(i * step) + 1).cast("int"), F.lit(size)) for i in range(segments)]
    return F.when(F.length(text) <= most, text).otherwise(F.concat(*parts))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """From up to ``PER_CLASS`` texts of each label, 0 and 1, with the smallest hashes of their keys.

    The texts are drawn by key from those that have a label, so that no more are moved than are fitted.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).filter("key is not null and label in (0, 1)").distinct()
    present = materialize(known.join(docs.select(F.col(key).alias("key")), "key", "left_semi"), "labelled")
    sizes = dict(present.groupBy("label").count().collect())
    network = Network()
    network.prior = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    if len(sizes) < 2:
        return network
    place = F.pmod(F.xxhash64("key"), F.lit(1 << 20))
    shares = F.create_map(*[F.lit(x) for value, n in sizes.items() for x in (value, int(min(1.0, 2 * PER_CLASS / n) * (1 << 20)))])
    # About twice as many as needed, and no more at any size of the labels.
    drawn = present.filter(place < shares[F.col("label")])
    read = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    found = read.join(F.broadcast(drawn), "key").withColumn("text", excerpt(F.col("text")))
    found = materialize(found.groupBy("key", "label").agg(F.min("text").alias("text")), "fitted")
    texts, marks = [], []
    for value in sorted(sizes):
        rows = found.filter(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(PER_CLASS).select("text").collect()
        texts += [bytes(row[0]) for row in rows]
        marks += [float(value)] * len(rows)
    return network.fit(texts, np.array(marks)) if len(set(marks)) == 2 else network


def score(docs: DataFrame, network: Network, text: str = "text", into: str = "score") -> DataFrame:
    def batch(texts):
        return ((network.probability(t),) for t in texts)

    return docs.withColumn(into, over_texts(docs.sparkSession, batch, f"{into} double")(F.col(text))[into])
