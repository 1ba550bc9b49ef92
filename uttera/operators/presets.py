"""Per-speaker voice presets and their lookup."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions.sums import exact_mean
from uttera.operators.lookup import lookup_join


def usable_vectors(df: DataFrame, speaker: str = "speakerID", vector: str = "global_embedding") -> DataFrame:
    """(speaker, vector) of the rows that name a speaker and have a vector."""
    return df.select(F.col(speaker).cast("string").alias(speaker), vector).where(
        (F.col(speaker) != "") & F.col(vector).isNotNull()
    )


def vector_means(df: DataFrame, speaker: str = "speakerID", vector: str = "global_embedding") -> DataFrame:
    """(speaker, mean, n), over a table or a stream.

    Each task keeps one partial mean per speaker, so a speaker with a third of the rows sends no more than any other, and
    no vector is exploded. Over a stream that partial mean is the speaker's state, into which every micro-batch is merged.
    Vectors of different lengths are an error.
    """
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return usable_vectors(df, speaker, vector).groupBy(speaker).agg(
        Summarizer.mean(dense).alias("mean"), F.count(F.lit(1)).alias("n")
    ).withColumn("mean", vector_to_array("mean"))


def presets_from_means(means: DataFrame, speaker: str = "speakerID") -> DataFrame:
    return means.select(
        F.col(speaker).alias("speakerID"), A.l2_normalize(F.col("mean")).cast("array<float>").alias("embedding"), "n"
    )


def exact_means(df: DataFrame, speaker: str = "speakerID", vector: str = "global_embedding") -> DataFrame:
    """``vector_means`` of a table, whose bits do not depend on how its rows are partitioned.

    One pass finds the vectors' length, which must be the same for all; then each task keeps two whole numbers per speaker
    and component, and no vector is exploded.
    """
    used = usable_vectors(df, speaker, vector)
    shortest, width = used.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if shortest != width:
        raise ValueError("vectors of different lengths have no mean")
    means = [exact_mean(F.col(vector)[i]) for i in range(width or 0)]
    return used.groupBy(speaker).agg(F.array(*means).cast("array<double>").alias("mean"), F.count(F.lit(1)).alias("n"))


def speaker_presets(df: DataFrame, speaker: str = "speakerID", vector: str = "global_embedding") -> DataFrame:
    """L2-normalised mean vector per speaker and how many vectors went into it."""
    return presets_from_means(exact_means(df, speaker, vector), speaker)


def speaker_counts(df: DataFrame, speaker: str = "speakerID", vector: str = "global_embedding") -> DataFrame:
    """Utterances used per speaker."""
    used = usable_vectors(df, speaker, vector)
    return used.groupBy(F.col(speaker).alias("speakerID")).agg(F.count(F.lit(1)).alias("n"))


def top_speakers(counts: DataFrame, k: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("n"), "speakerID").limit(k)


def attach_preset(
    requests: DataFrame,
    presets: DataFrame,
    max_broadcast_bytes: int = S.BROADCAST_BYTES,
) -> DataFrame:
    """Give each request its voice: the preset of the speaker it names, else its reference vector.

    A named speaker without a preset gets no fallback. ``error`` says why a request has no voice.
    """
    table = presets.select(F.col("speakerID").alias("speaker"), F.col("embedding").alias("_preset"))
    joined = lookup_join(requests, table, "speaker", max_broadcast_bytes)
    named = F.coalesce(F.col("speaker") != "", F.lit(False))
    voice = F.when(named, F.col("_preset")).otherwise(F.col("ref_embedding"))
    error = F.when(named & F.col("_preset").isNull(), F.lit("unknown speaker")).when(
        ~named & F.col("ref_embedding").isNull(), F.lit("no speaker or reference")
    )
    return joined.withColumn("embedding", voice).withColumn("error", error).drop("_preset")


def unresolved_speakers(requests: DataFrame, presets: DataFrame) -> DataFrame:
    """Requests by named speaker that has no preset."""
    named = requests.where(F.col("speaker") != "").groupBy("speaker").agg(F.count(F.lit(1)).alias("requests"))
    known = presets.select(F.col("speakerID").alias("speaker"))
    return named.join(known, "speaker", "left_anti")
