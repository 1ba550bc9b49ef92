"""Vectors, token arrays and audio arrays."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions.binding import let


def l2_normalize(vector: Column) -> Column:
    """Divide by the Euclidean norm; a vector whose norm is zero or NaN is left as it is."""
    doubles = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda total, x: total + x * x))
    return let(
        norm,
        lambda n: F.when((n > 0) & ~F.isnan(n), F.transform(doubles, lambda x: x / n)).otherwise(doubles),
    )


def argmax(scores: Column) -> Column:
    """Zero-based position of the largest score; ties go to the lowest."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def argmax_each(logits: Column) -> Column:
    """``argmax`` at every position of an ``array<array<..>>``."""
    return F.transform(logits, argmax)


def prompt_len(prompt_ids: Column, full_ids: Column) -> Column:
    """Length of the longest common prefix, which is the prompt's own length when the full text extends it."""
    differs = F.zip_with(prompt_ids, full_ids, lambda a, b: ~a.eqNullSafe(b))
    return let(
        F.array_position(differs, True),
        lambda first: F.when(first > 0, first - 1).otherwise(F.size(prompt_ids)).cast("int"),
    )


def label_mask(ids: Column, prompt: Column, ignored: int = S.IGNORED_LABEL) -> Column:
    """The ids with the prompt's positions replaced by the label that is not scored."""
    cut = F.least(prompt, F.size(ids))
    return F.concat(F.array_repeat(F.lit(ignored), cut), F.slice(ids, cut + 1, F.size(ids) - cut))


def attention_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def pad_right(values: Column, length: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), F.greatest(length - F.size(values), F.lit(0))))


def token_duration(ids: Column, rate_hz: float = S.TOKEN_RATE_HZ) -> Column:
    """Seconds of audio a token array stands for."""
    return F.size(ids) / F.lit(rate_hz)


def out_of_range(ids: Column, size: int = S.TOKEN_RANGE) -> Column:
    """How many ids lie outside ``[0, size)``."""
    return F.size(F.filter(ids, lambda x: (x < 0) | (x >= size)))


def downmix(channels: Column, layout: str = "last") -> Column:
    """Mean over channels. ``last``: samples of channels, as tables hold them; ``first``: channels of samples."""

    def mean(values: Column) -> Column:
        return F.try_divide(F.aggregate(values, F.lit(0.0), lambda total, x: total + x), F.size(values))

    if layout == "last":
        mono = F.transform(channels, mean)
    elif layout == "first":
        frames = F.sequence(F.lit(0), F.size(channels[0]) - 1)
        per_frame = F.transform(frames, lambda i: mean(F.transform(channels, lambda c: c[i])))
        mono = F.when(F.size(channels[0]) > 0, per_frame).otherwise(F.array().cast("array<double>"))
    else:
        raise ValueError(f"layout is 'last' or 'first', not {layout!r}")
    return mono.cast("array<float>")


def normalize_audio(audio: Column) -> Column:
    """``{array float32, sampling_rate int}``; null when the array is absent or the rate is not positive."""
    usable = audio["array"].isNotNull() & (audio["sampling_rate"] > 0)
    return F.when(
        usable,
        F.struct(
            audio["array"].cast("array<float>").alias("array"),
            audio["sampling_rate"].cast("int").alias("sampling_rate"),
        ),
    )
