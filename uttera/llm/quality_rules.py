"""Quality rules: an isolation forest over rule statistics, its threshold calibrated from labelled rows.

One pass over the texts counts the statistics; everything after it works on the narrow table of counts. The trees are
grown from ``TREES * DEPTH_ROWS`` labelled rows at most; the threshold comes from all labelled rows, as counts per
score bin, and takes the bin with the best F1 for the rows labelled bad.

Defined results. A null or empty text has zero counts and fails the base rule. Labels of rows that are not in the table,
null labels and repeated labels: the first are not used, the last count once each. With no row labelled good or none
labelled bad, nothing but the base rule drops rows. Columns of the input are kept; counts replace columns of their names.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import over_texts
from uttera.session import materialize

COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_upper long, n_digits long, n_marks long, n_distinct long, n_letters long"
)
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
TREES, DEPTH_ROWS = 128, 256
BINS = 1000


def _mask(members: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(members)] = True
    return mask


_SPACES, _SYMBOL = _mask(b" \t\n\v\f\r"), _mask(SYMBOLS)
_UPPER, _DIGIT = _mask(bytes(range(65, 91))), _mask(bytes(range(48, 58)))
_LETTER = _UPPER | _mask(bytes(range(97, 123))) | _mask(bytes(range(0xC0, 256)))
_MARK = _mask(b"!?;:_=~^\\/{}[]+@")


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows found twice or more, the first place included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    ids: dict[tuple, int] = {}
    index = [ids.setdefault(w, len(ids)) for w in windows]
    if len(ids) == len(windows):
        return 0
    index = np.array(index)
    again = np.bincount(index)[index] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(windows)] |= again
    return int(covered.sum())


def statistics(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    words = text.split()
    codes = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    points = len(text) - int(codes[0x80:0xC0].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        points - int(codes[_SPACES].sum()),
        int(codes[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(codes[_UPPER].sum()),
        int(codes[_DIGIT].sum()),
        int(codes[_MARK].sum()),
        len(set(words)),
        int(codes[_LETTER].sum()),
    )


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    def batch(texts):
        return map(statistics, texts)

    counted = docs.withColumn("_counts", over_texts(docs.sparkSession, batch, COUNTS)(F.col(text)))
    names = [field.split()[0] for field in COUNTS.split(", ")]
    return counted.withColumns({name: F.col(f"_counts.{name}") for name in names}).drop("_counts")


def base_failed():
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features(rows: pd.DataFrame) -> np.ndarray:
    """Ratios that do not depend on a text's length. Repeated lines and digits also stand in good texts, and are left out."""
    per_word = np.maximum(rows.n_words.to_numpy(float), 1)
    per_char = np.maximum(rows.word_chars.to_numpy(float), 1)
    return np.column_stack([
        rows.n_symbols / per_char,
        rows.n_repeat_words / per_word,
        rows.n_upper / np.maximum(rows.n_letters, 1),
        rows.n_marks / per_char,
        rows.n_distinct / per_word**0.9,
    ])


def _tree(sample: np.ndarray, random: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, cut, left, right, path); a leaf has feature -1 and the path length of those that end in it."""
    nodes: list[tuple] = []

    def grow(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append(())
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_ = np.flatnonzero(high > low)
        if depth == limit or len(rows) < 2 or not len(open_):
            nodes[at] = (-1, 0.0, at, at, depth + mean_path(len(rows)))
            return at
        feature = int(random.choice(open_))
        cut = float(random.uniform(low[feature], high[feature]))
        below = rows[:, feature] < cut
        if not below.any():
            below = rows[:, feature] <= low[feature]
            cut = float(np.nextafter(low[feature], np.inf))
        left, right = grow(rows[below], depth + 1), grow(rows[~below], depth + 1)
        nodes[at] = (feature, cut, left, right, 0.0)
        return at

    grow(sample, 0)
    return nodes


def mean_path(rows: int) -> float:
    """Mean depth of an unsuccessful search among so many rows."""
    return 0.0 if rows < 2 else 2 * (np.log(rows - 1) + np.euler_gamma) - 2 * (rows - 1) / rows


class Forest:
    """Random split trees; ``score`` is 2 to the power of minus the mean path, over what is usual: near 1 is odd."""

    def __init__(self, sample: np.ndarray, seed: int = 7):
        random = np.random.default_rng(seed)
        size = min(DEPTH_ROWS, len(sample))
        limit = int(np.ceil(np.log2(max(size, 2))))
        self.usual = max(mean_path(size), 1e-9)
        self.limit = limit
        self.trees = []
        for _ in range(TREES):
            nodes = _tree(sample[random.choice(len(sample), size, replace=False)], random, limit)
            self.trees.append(tuple(np.array(column) for column in zip(*nodes, strict=True)))

    def score(self, rows: np.ndarray) -> np.ndarray:
        paths = np.zeros(len(rows))
        line = np.arange(len(rows))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), int)
            for _ in range(self.limit):
                below = rows[line, np.maximum(feature[at], 0)] < cut[at]
                at = np.where(below, left[at], right[at])
            paths += path[at]
        return 2.0 ** (-paths / len(self.trees) / self.usual)


def fit_forest(labelled: DataFrame, key: str) -> Forest | None:
    """Grown from at most ``TREES * DEPTH_ROWS`` labelled rows, those with the smallest hashes of their keys.

    Rows are drawn as such, whatever their counts: copies are in the sample in proportion, and never stand for all of it.
    """
    counts = [field.split()[0] for field in COUNTS.split(", ")]
    most, place = TREES * DEPTH_ROWS, F.xxhash64(key)
    # By hash about twice as many as needed, then exactly as many: what reaches the driver does not grow with the labels.
    share = min(1.0, 2 * most / max(1, labelled.count()))
    drawn = labelled.filter(F.pmod(place, F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = drawn.orderBy(place, *counts).limit(most).select(*counts).toPandas()
    return Forest(features(rows)) if len(rows) > 1 else None


def with_score(counted: DataFrame, forest: Forest, into: str = "anomaly") -> DataFrame:
    names = [field.split()[0] for field in COUNTS.split(", ")]

    def run(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(features(rows)))

    run.__annotations__ = {"rows": pd.DataFrame, "return": pd.Series}
    udf = F.pandas_udf(run, "double").asNondeterministic()
    return counted.withColumn(into, udf(F.struct(*names)))


def best_cut(scored: DataFrame) -> float:
    """The score bin from which on ``bad`` rows are told apart with the best F1, over all rows of ``scored``."""
    at = F.floor(F.col("anomaly") * BINS).alias("at")
    counts = scored.groupBy(at).agg(F.sum(F.col("bad").cast("long")).alias("bad"), F.count("*").alias("n")).toPandas()
    counts = counts.sort_values("at", ascending=False)
    caught, flagged = counts.bad.cumsum(), counts.n.cumsum()
    if not len(counts) or caught.iloc[-1] in (0, flagged.iloc[-1]):
        return float("inf")
    return float(counts["at"].iloc[int(np.argmax(2 * caught / (flagged + caught.iloc[-1])))]) / BINS


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``anomaly`` and ``kept`` per row. ``labels``: key and ``quality`` (0 is bad)."""
    counted = materialize(with_statistics(docs.select(key, text), text).drop(text), "statistics")
    known = labels.filter("quality is not null").select(key, (F.col("quality") == 0).alias("bad"))
    labelled = materialize(counted.join(known, key), "labelled")
    forest = fit_forest(labelled, key)
    if forest is None:
        judged = counted.withColumn("anomaly", F.lit(0.0))
        cut = float("inf")
    else:
        cut = best_cut(with_score(labelled, forest))
        judged = with_score(counted, forest)
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < cut))
