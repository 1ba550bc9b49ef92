"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every fingerprint emits itself and all variants at one differing bit. Two fingerprints within two bits of each other
share such a variant, and all that share one are within two bits. The shuffle is on variants, of which each is shared
by at most 65 different fingerprints however many copies a document has: copies are folded into their fingerprint before.

Defined results. Null and empty texts, and texts without a word, have fingerprint zero and link like any other. A text
with fewer words than a shingle is one shingle. Rows with equal ids are kept as they are; a component's id is the
smallest non-null id in it, null if there is none. An empty table gives an empty one. Columns other than id and text
are not touched; the results take names of their own, replacing columns that had them.
"""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from uttera.llm.common import over_texts
from uttera.llm.components import components
from uttera.session import materialize

SEED = 42
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def shingle_hashes(text: bytes | None, size: int) -> list[int]:
    """XXH64 of every run of ``size`` words, repeats included; ``bytes`` lower-cases and splits on ASCII only."""
    words = (text or b"").lower().split()
    if not words:
        return []
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - size + 1].tolist()
    return [digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)]


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed 64-bit number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[at : at + CHUNK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: bytes | None, size: int) -> int:
    return majority(np.array(shingle_hashes(text, size), "<u8"))


def with_fingerprints(docs: DataFrame, size: int = 3, text: str = "text", into: str = "simhash") -> DataFrame:
    def batch(texts):
        return ((fingerprint(t, size),) for t in texts)

    return docs.withColumn(into, over_texts(docs.sparkSession, batch, f"{into} bigint")(F.col(text))[into])


def ball(value: Column) -> Column:
    """The value and its 64 variants at one differing bit."""
    flips = F.array(*[F.lit(1 << bit if bit < 63 else -(1 << 63)) for bit in range(64)])
    return F.concat(F.array(value), F.transform(flips, lambda flip: value.bitwiseXOR(flip)))


def close_fingerprints(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct ``simhash`` values within two bits; each bucket's members link to its smallest."""
    variants = prints.select("simhash", F.explode(ball(F.col("simhash"))).alias("variant"))
    smallest = F.min("simhash").over(Window.partitionBy("variant"))
    return (
        variants.select(F.col("simhash").alias("a"), smallest.alias("b"))
        .filter("a != b")
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """A row (key, simhash, component_id) per row of ``docs``: components of fingerprints within two bits."""
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    narrow = materialize(with_fingerprints(read, size).select("key", "simhash"), "simhash")
    prints = narrow.groupBy("simhash").agg(F.min("key").alias("first"))
    roots = components(close_fingerprints(prints))
    linked = prints.join(roots.withColumnRenamed("node", "simhash"), "simhash", "left")
    linked = materialize(linked.withColumn("root", F.coalesce("root", "simhash")), "linked")
    # Only components of several fingerprints need another look for their smallest id.
    joined = linked.filter("root != simhash").select("root").distinct()
    least = linked.join(joined, "root").groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root", "left").select("simhash", F.coalesce("least", "first").alias("component_id"))
    return narrow.join(named, "simhash").select(F.col("key").alias(key), "simhash", "component_id")
