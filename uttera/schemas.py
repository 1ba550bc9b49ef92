"""Explicit schemas of the tables the library reads and writes."""

from dataclasses import dataclass

from pyspark.sql import types as T

INTS = T.ArrayType(T.IntegerType())
LONGS = T.ArrayType(T.LongType())
FLOATS = T.ArrayType(T.FloatType())

AUDIO = T.StructType([
    T.StructField("array", FLOATS),
    T.StructField("sampling_rate", T.IntegerType()),
])

RAW_UTTERANCE = T.StructType([
    T.StructField("UtteranceSequenceID", T.StringType()),
    T.StructField("speakerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("audio", AUDIO),
])

PROCESSED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("speakerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("transcript", T.StringType()),
    T.StructField("transcript_source", T.StringType()),
    T.StructField("speech_tokens", INTS),
    T.StructField("num_speech_tokens", T.IntegerType()),
    T.StructField("global_embedding", FLOATS),
])

PROGRESS = T.StructType([
    T.StructField("config", T.StringType()),
    T.StructField("worker", T.IntegerType()),
    T.StructField("completed_shards", T.IntegerType()),
    T.StructField("streamed_consumed", T.LongType()),
    T.StructField("num_workers", T.IntegerType()),
])

PRESETS = T.StructType([
    T.StructField("speakerID", T.StringType()),
    T.StructField("embedding", FLOATS),
    T.StructField("n", T.LongType()),
])

EXAMPLES = T.StructType([
    T.StructField("input_ids", LONGS),
    T.StructField("attention_mask", INTS),
    T.StructField("labels", LONGS),
])


@dataclass(frozen=True)
class Columns:
    """Names of the source columns; the defaults are those of RAW_UTTERANCE."""

    sequence: str = "UtteranceSequenceID"
    speaker: str = "speakerID"
    gender: str = "gender"
    district: str = "district"
    state: str = "state"
    language: str = "language"
    duration: str = "duration"
    audio: str = "audio"
