"""Requests to prompts and voices, and generated text back to tokens."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T
from uttera.operators import presets as P


def prepare_requests(requests: DataFrame, presets: DataFrame) -> DataFrame:
    """Add the rendered ``prompt``, the ``embedding`` to speak with, and ``error`` where there is none."""
    voiced = P.attach_preset(requests, presets)
    prompt = T.chatml(T.user_message(F.col("text")), generation_prompt=True)
    return voiced.withColumns({
        "prompt": F.when(F.col("text").isNotNull(), prompt),
        "error": F.when(F.col("text").isNull(), F.lit("no text")).otherwise(F.col("error")),
    })


def parse_generated(df: DataFrame, text: str = "generated", rate_hz: float = S.TOKEN_RATE_HZ) -> DataFrame:
    """Add ``tokens``, their ``seconds``, and ``error`` for output that holds no token."""
    parsed = df.withColumn("tokens", T.parse_speech_tokens(F.col(text), S.TOKEN_PATTERN))
    # A search stops at the first token; a filter on the error need not collect them all.
    found = F.coalesce(F.col(text).rlike(S.TOKEN_PATTERN), F.lit(False))
    return parsed.withColumns({
        "seconds": A.token_duration(F.col("tokens"), rate_hz),
        "error": F.when(~found, F.lit("no speech tokens")),
    })
