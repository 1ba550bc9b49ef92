"""Transcripts, pause tags, speech-token strings and chat text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions.binding import let


def strip(text: Column) -> Column:
    """Drop leading and trailing Unicode whitespace."""
    return F.btrim(text, F.lit(S.SPACES))


def words(text: Column) -> Column:
    """Whitespace-separated words; blank text gives one empty word."""
    return F.split(strip(text), f"[{S.SPACE_CLASS}]+")


def clean_transcript(text: Column, keep: str = S.KEPT_CLASS) -> Column:
    """Every run of characters outside ``keep`` becomes one space, and the ends are trimmed.

    ``keep`` holds no whitespace, so collapsing is part of the same pass.
    """
    return F.trim(F.regexp_replace(text, f"[^{keep}]+", " "))


def valid_transcript(
    text: Column, min_chars: int = S.MIN_CHARS, max_chars: int = S.MAX_CHARS, script: str = S.SCRIPT_CLASS
) -> Column:
    """Stripped length within bounds and at least one character of the script; null is not valid."""

    def valid(t: Column) -> Column:
        return (t != "") & F.length(strip(t)).between(min_chars, max_chars) & t.rlike(f"[{script}]")

    return F.coalesce(let(text, valid), F.lit(False))


def insert_pause_tags(text: Column, gaps: Column, tag: str = S.PAUSE_TAG) -> Column:
    """Put ``gaps`` tags at evenly spaced word boundaries.

    The text is cut into ``n + 1`` runs of words whose edges are ``i * words / (n + 1)``, rounded half to even,
    and joined with the tag. Text that gets no tag is returned as it is.
    """

    def tagged(listed: Column, wanted: Column) -> Column:
        total = F.size(listed)
        n = F.least(wanted, total - 1)

        def edge(i: Column) -> Column:
            return F.rint(i * total / (n + 1)).cast("int")

        runs = F.transform(
            F.sequence(F.lit(0), n),
            lambda i: F.array_join(F.slice(listed, edge(i) + 1, edge(i + 1) - edge(i)), " "),
        )
        return F.when((wanted > 0) & (total >= 2), F.array_join(runs, f" {tag} ")).otherwise(text)

    wanted = F.coalesce(gaps.cast("int"), F.lit(0))
    return let(words(text), lambda listed: let(wanted, lambda n: tagged(listed, n)))


def tokens_to_str(ids: Column, template: str = S.TOKEN_TEMPLATE) -> Column:
    """``[12, 5]`` to ``<|s_12|><|s_5|>``."""
    before, after = template.split("{}")

    def joined(t: Column) -> Column:
        listed = F.concat(F.lit(before), F.array_join(t.cast("array<string>"), after + before), F.lit(after))
        return F.when(F.size(t) > 0, listed).when(t.isNotNull(), F.lit(""))

    return let(ids, joined)


def parse_speech_tokens(text: Column, pattern: str = S.TOKEN_PATTERN) -> Column:
    """All token ids of a generated text, in order; other text is ignored and no range is checked."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda d: d.try_cast("bigint"))


def build_messages(text: Column, speech: Column) -> Column:
    """A user turn with the text and an assistant turn with the token string."""
    return F.array(
        F.struct(F.lit("user").alias("role"), text.alias("content")),
        F.struct(F.lit("assistant").alias("role"), speech.alias("content")),
    )


def user_message(text: Column) -> Column:
    """The prompt alone: one user turn, trimmed as for generation."""
    return F.array(F.struct(F.lit("user").alias("role"), strip(text).alias("content")))


def chatml(messages: Column, generation_prompt: bool = False) -> Column:
    """Render ordered messages as ChatML; no turn is left out, and the prompt form ends with an opened assistant turn."""
    turns = F.transform(
        messages,
        lambda m: F.concat(F.lit(S.TURN_START), m["role"], F.lit("\n"), F.coalesce(m["content"], F.lit("")), F.lit(S.TURN_END + "\n")),
    )
    rendered = F.array_join(turns, "")
    return F.concat(rendered, F.lit(f"{S.TURN_START}assistant\n")) if generation_prompt else rendered


def code_points(text: Column) -> Column:
    """The text's code points, as ``array<int>``."""
    return F.when(text == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(text, ""), F.ascii))


def utterance_id(sequence: Column, speaker: Column) -> Column:
    """``<sequence>_<speaker>``; a null part reads ``None``."""
    return F.concat_ws(
        "_",
        F.coalesce(sequence.cast("string"), F.lit("None")),
        F.coalesce(speaker.cast("string"), F.lit("None")),
    )
