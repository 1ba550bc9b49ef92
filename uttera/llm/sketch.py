"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch is the set of all shingle hashes below a fixed fraction of the hash range, so its size follows the document's, and
the share of one sketch found in another estimates the share of the one document found in the other, however unequal
they are. Documents with fewer than ``FLOOR`` such hashes keep their ``FLOOR`` smallest, so short ones are compared
exactly. The sketch of a union is the sketch of the union of sketches (``merge``); two sketches are compared on the part of
the hash range that both cover.

Edits need a document's neighbour in the order of ids. The table is range-partitioned and sorted once; within a partition a
row meets the one after it as rows stream by, and the first and last rows of partitions are joined by the partitions' order.

Defined results. Words are lower-cased in ASCII and split at ASCII white space; a text of fewer words than a shingle is one
shingle, one without a word has the empty sketch. A null text is an empty one. Two empty sketches are alike (1), an
empty one and another are not (0). Null ids come last, rows of one id in the order of their texts' hashes; every row is
edited with the next row, the last with the first, so the row of a table of one is its own neighbour. An empty table gives
an empty one. Only id and text are read.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from uttera.llm.common import BATCH_BYTES, BATCH_ROWS, over_texts
from uttera.session import materialize

SHINGLE = 5
#: Share of the hash range that is retained, as one part in so many, and the hashes a short document retains at least.
SCALED, FLOOR = 16, 32
SEED = 42
#: Odd multiplier that joins word hashes to a shingle's, and those of the SplitMix64 mix: fixed values.
JOIN = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Different hashes of all runs of ``size`` words, ascending, from one hash per word."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    known = {word: digest(word, SEED) for word in set(words)}
    single = np.array([known[word] for word in words], np.uint64)
    count = max(1, len(words) - size + 1)
    joined = np.zeros(count, np.uint64)
    for k in range(min(size, len(words))):
        joined = joined * np.uint64(JOIN) + single[k : k + count]
    joined = (joined ^ joined >> np.uint64(30)) * np.uint64(MIX[0])
    joined = (joined ^ joined >> np.uint64(27)) * np.uint64(MIX[1])
    return np.unique(joined ^ joined >> np.uint64(31))


def retained(hashes: np.ndarray, scaled: int = SCALED, floor: int = FLOOR) -> np.ndarray:
    """Of ascending hashes those below the threshold, or the ``floor`` smallest if these are more."""
    below = int(np.searchsorted(hashes, np.uint64((1 << 64) // scaled)))
    return hashes[: max(below, floor)]


def sketch(text: bytes, size: int = SHINGLE, scaled: int = SCALED, floor: int = FLOOR) -> np.ndarray:
    return retained(shingle_hashes(text, size), scaled, floor)


def merge(one: np.ndarray, other: np.ndarray, scaled: int = SCALED, floor: int = FLOOR) -> np.ndarray:
    """The sketch of both documents' shingles together."""
    return retained(np.union1d(one, other), scaled, floor)


def covered(found: np.ndarray, scaled: int = SCALED, floor: int = FLOOR) -> int:
    """Below what hash a sketch holds everything: the whole range if it holds fewer than ``floor``."""
    return 1 << 64 if len(found) < floor else max((1 << 64) // scaled, int(found[-1]) + 1)


def _common(one: np.ndarray, other: np.ndarray, scaled: int, floor: int) -> tuple[int, int, int]:
    """How many hashes each has, and both, where both hold everything."""
    end = min(covered(one, scaled, floor), covered(other, scaled, floor))
    if end < 1 << 64:
        one, other = (x[: np.searchsorted(x, np.uint64(end))] for x in (one, other))
    return len(one), len(other), len(np.intersect1d(one, other, assume_unique=True))


def containment(one: np.ndarray, other: np.ndarray, scaled: int = SCALED, floor: int = FLOOR) -> float:
    """Estimated share of the first document's shingles that the other has."""
    mine, others, both = _common(one, other, scaled, floor)
    return both / mine if mine else float(not len(one) and not others)


def resemblance(one: np.ndarray, other: np.ndarray, scaled: int = SCALED, floor: int = FLOOR) -> float:
    """Estimated share of both documents' shingles that they have in common."""
    mine, others, both = _common(one, other, scaled, floor)
    return both / (mine + others - both) if mine + others else 1.0


def packed(found: np.ndarray) -> bytes:
    """Eight bytes a hash, ascending."""
    return found.astype(">u8").tobytes()


def written(found: np.ndarray) -> str:
    """Sixteen hex digits a hash, ascending."""
    return packed(found).hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def with_sketches(docs: DataFrame, text: str = "text", into: str = "fingerprint", size: int = SHINGLE, scaled: int = SCALED, floor: int = FLOOR) -> DataFrame:
    """Adds the written sketch of every text."""

    def batch(texts):
        return ((written(sketch(t or b"", size, scaled, floor)),) for t in texts)

    return docs.withColumn(into, over_texts(docs.sparkSession, batch, f"{into} string")(F.col(text))[into])


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many first characters of the following one, or all it has."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


#: Result columns in Spark and in Arrow.
RESULT = {
    "n_chars": ("bigint", pa.int64()),
    "edited_sha256": ("string", pa.string()),
    "fingerprint": ("binary", pa.binary()),
    "edited_fingerprint": ("binary", pa.binary()),
    "near_edited": ("double", pa.float64()),
    "near_next": ("double", pa.float64()),
}


class Row:
    """A row and the sketch of its text."""

    def __init__(self, key, text: bytes | None):
        self.key, self.text = key, (text or b"").decode("utf-8", "replace")
        self.sketch = sketch(self.text.encode())

    def beside(self, following: "Row") -> dict:
        changed = edited(self.text, following.text).encode()
        other = sketch(changed)
        return {
            "n_chars": len(self.text),
            "edited_sha256": hashlib.sha256(changed).hexdigest(),
            "fingerprint": packed(self.sketch),
            "edited_fingerprint": packed(other),
            "near_edited": containment(self.sketch, other),
            "near_next": containment(self.sketch, following.sketch),
        }


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, part): descending ids, nulls last, the rows of a partition in order. Equal keys spread by stored number."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_stored", F.monotonically_increasing_id())
    order = [F.desc_nulls_last("key"), F.asc("_hash"), F.asc("_stored")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text", F.spark_partition_id().alias("part"))


def edit_check(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the sketches of its text and of the text edited with the next row's, and how near it is to both texts."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = in_order(docs, key, text)
    kind = dict(rows.dtypes)["key"]
    names = list(RESULT)
    shape = ", ".join(f"{name} {kind}" for name, (kind, _) in RESULT.items())

    def results(rows: list[tuple], key_type: pa.DataType, more: tuple = ()) -> pa.RecordBatch:
        schema = pa.schema([("key", key_type), *[(name, kind) for name, (_, kind) in RESULT.items()], *more])
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)

    edge = (("part", pa.int32()), ("edge", pa.string()), ("text", pa.binary()))
    nothing = [None] * len(names)

    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row beside the one after it; the texts of a partition's first and last rows go along, for their neighbours."""
        before, part, key_type = None, None, None
        for batch in batches:
            out, key_type = [], batch.schema.field(0).type
            for k, t, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                row = Row(k, t)
                if before is None:
                    out.append((None, *nothing, part, "first", row.text.encode()))
                else:
                    out.append((before.key, *before.beside(row).values(), part, None, None))
                before = row
            yield results(out, key_type, edge)
        if before is not None:
            yield results([(before.key, *nothing, part, "last", before.text.encode())], key_type, edge)

    found = materialize(rows.mapInArrow(neighbours, f"key {kind}, {shape}, part int, edge string, text binary"), "neighbours", "zstd")
    inner = found.filter("edge is null").select("key", *names)

    # One row per partition: which partition comes next; the last is followed by the first.
    firsts = found.filter("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    parts = firsts.select(F.col("next").alias("part"))
    order = Window.orderBy("part")
    after = parts.withColumn("next", F.lead("part").over(order)).withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    lasts = found.filter("edge = 'last'").select("key", "part", "text").join(after, "part").join(firsts, "next").select("key", "text", "following")

    def across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(k, *Row(k, t).beside(Row(None, f)).values()) for k, t, f in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            yield results(out, batch.schema.field(0).type)

    edges = lasts.mapInArrow(across, f"key {kind}, {shape}")
    shown = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return inner.unionByName(edges).withColumns(shown).withColumnRenamed("key", key)

