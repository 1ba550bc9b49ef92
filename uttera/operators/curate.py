"""Projection to processed rows and the count of what each filter drops."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import text as T
from uttera.operators import filters
from uttera.schemas import Columns


def build_rows(
    df: DataFrame,
    columns: Columns = Columns(),
    text: str = "text",
    tokens: str = "speech_tokens",
    vector: str = "global_embedding",
    keep: tuple[str, ...] = (),
    audio: str | None = None,
    transcript_source: str = S.TRANSCRIPT_SOURCE,
) -> DataFrame:
    """The twelve columns of a processed row, then ``keep``, then the audio if it is wanted."""
    c = columns
    selected = [
        T.utterance_id(F.col(c.sequence), F.col(c.speaker)).alias("id"),
        F.col(c.speaker).alias("speakerID"),
        F.col(c.gender).alias("gender"),
        F.col(c.district).alias("district"),
        F.col(c.language).alias("language"),
        F.col(c.duration).cast("double").alias("duration"),
        F.col(text).alias("text"),
        F.col(text).alias("transcript"),
        F.lit(transcript_source).alias("transcript_source"),
        F.col(tokens).cast("array<int>").alias("speech_tokens"),
        F.size(tokens).alias("num_speech_tokens"),
        F.col(vector).cast("array<float>").alias("global_embedding"),
        *[F.col(k) for k in keep],
    ]
    if audio:
        selected.append(F.col(audio).alias("audio"))
    return df.select(*selected)


def funnel(df: DataFrame, stages: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows seen, rows dropped at each stage in order, and rows accepted, from one pass.

    A row counts as dropped by the first stage whose condition it does not meet.
    """
    stage: Column = F.lit(len(stages))
    for at, condition in reversed(list(enumerate(stages.values()))):
        stage = F.when(F.coalesce(condition, F.lit(False)), stage).otherwise(F.lit(at))
    staged = df.select(*by, stage.alias("_stage"))
    dropped = [F.count_if(F.col("_stage") == at).alias(f"dropped_{name}") for at, name in enumerate(stages)]
    accepted = F.count_if(F.col("_stage") == len(stages)).alias("accepted")
    return staged.groupBy(*by).agg(F.count(F.lit(1)).alias("seen"), *dropped, accepted)


def curation_stages(
    columns: Columns = Columns(),
    language: str = S.LANGUAGE,
    state: str | None = S.STATE,
    min_duration: float = S.MIN_DURATION_S,
    max_duration: float = S.MAX_DURATION_S,
) -> dict[str, Column]:
    """The cheap conditions, in the order they are applied."""
    stages = {"language": F.col(columns.language) == language}
    if state:
        stages["state"] = F.col(columns.state) == state
    stages["duration"] = filters.duration_ok(columns.duration, min_duration, max_duration)
    return stages
