"""Row filters of the curation and training flows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import text as T


def language_is(df: DataFrame, column: str = "language", value: str = S.LANGUAGE) -> DataFrame:
    """Exact, case-sensitive match; null is dropped."""
    return df.where(F.col(column) == value)


def state_is(df: DataFrame, column: str = "state", value: str | None = S.STATE) -> DataFrame:
    """As ``language_is``, skipped when no value is set."""
    return df.where(F.col(column) == value) if value else df


def duration_ok(column: str = "duration", lo: float = S.MIN_DURATION_S, hi: float = S.MAX_DURATION_S) -> Column:
    return F.col(column).isNull() | F.col(column).between(lo, hi)


def duration_between(
    df: DataFrame, column: str = "duration", lo: float = S.MIN_DURATION_S, hi: float = S.MAX_DURATION_S
) -> DataFrame:
    """Inclusive bounds; an unknown duration passes, NaN does not."""
    return df.where(duration_ok(column, lo, hi))


def audio_ok(column: str = "audio") -> Column:
    return F.col(column)["array"].isNotNull() & (F.col(column)["sampling_rate"] > 0)


def audio_present(df: DataFrame, column: str = "audio") -> DataFrame:
    return df.where(audio_ok(column))


def transcript_valid(
    df: DataFrame,
    column: str = "text",
    min_chars: int = S.MIN_CHARS,
    max_chars: int = S.MAX_CHARS,
    script: str = S.SCRIPT_CLASS,
    drop_empty: bool = True,
) -> DataFrame:
    """``drop_empty=False`` turns the whole check off, not only the one for emptiness."""
    return df.where(T.valid_transcript(F.col(column), min_chars, max_chars, script)) if drop_empty else df


def tokens_present(df: DataFrame, column: str = "speech_tokens") -> DataFrame:
    return df.where(F.size(column) > 0)


def worker_split(
    df: DataFrame, num_workers: int, worker_id: int | None = None, index: str = "source_index"
) -> DataFrame:
    """Tag each row with ``source_index mod num_workers``; with a worker id keep that worker's rows only.

    The index counts all source rows, so split before filtering or carry the column along.
    """
    worker = F.pmod(F.col(index), F.lit(num_workers)).cast("int")
    tagged = df.withColumn("worker", worker)
    return tagged if worker_id is None else tagged.where(F.col("worker") == worker_id)


def examples_present(df: DataFrame, text: str = "text", tokens: str = "speech_tokens") -> DataFrame:
    """Rows with text and tokens to train on."""
    return df.where((F.col(text) != "") & (F.size(tokens) > 0))


def fits_context(
    df: DataFrame, ids: str = "input_ids", prompt: str = "prompt_len", max_seq_len: int = S.MAX_SEQ_LEN
) -> DataFrame:
    """Drop, never truncate, what is too long or has nothing left after the prompt; empty ids go too."""
    size = F.size(ids)
    return df.where((size > 0) & (size <= max_seq_len) & (F.col(prompt) < size))
