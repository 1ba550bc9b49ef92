"""Pause tags, token strings, chat text and arrays of tokens or samples."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as R
from registry.base import collector
from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T
from uttera.operators import filters
from uttera.plans.synthesis import parse_generated

query, QUERIES, ORACLES = collector()

# A document's line breaks stand in for the silences of its reading.
LINE_BREAKS = "(length(text) - length(replace(text, chr(10), '')))"


@query("pause_tags", f"""SELECT doc_id, tagged FROM (
  {R.sql_paused('text', 'gaps', f'(SELECT doc_id, text, {LINE_BREAKS} AS gaps FROM documents)')})""")
def pause_tags(spark: SparkSession, sf: str) -> DataFrame:
    gaps = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return R.documents(spark, sf).select("doc_id", T.insert_pause_tags(F.col("text"), gaps).alias("tagged"))


def token_strings(spark: SparkSession, sf: str) -> DataFrame:
    return R.documents(spark, sf).select("doc_id", "text", T.tokens_to_str(R.tokens()).alias("speech"))


SPEECH = f"""speech AS (SELECT doc_id, text,
  array_to_string(list_transform({R.sql_tokens('text')}, lambda t: '<|s_' || t || '|>'), '') AS speech
  FROM documents)"""


@query("tokens_to_str", f"WITH {SPEECH} SELECT doc_id, speech FROM speech")
def tokens_to_str(spark: SparkSession, sf: str) -> DataFrame:
    return token_strings(spark, sf).select("doc_id", "speech")


# A model's output mixes tokens with other text and broken tokens.
@query("parse_tokens", f"""WITH {SPEECH} SELECT doc_id, {R.sql_joined('ids')} AS tokens, len(ids) AS n FROM (
  SELECT doc_id, regexp_extract_all(text || speech || '<|s_x|> <|s_7|>', '<\\|s_(\\d+)\\|>', 1) AS ids FROM speech)""")
def parse_tokens(spark: SparkSession, sf: str) -> DataFrame:
    output = F.concat("text", "speech", F.lit("<|s_x|> <|s_7|>"))
    parsed = token_strings(spark, sf).withColumn("tokens", T.parse_speech_tokens(output))
    return parsed.select("doc_id", R.joined("tokens").alias("tokens"), F.size("tokens").cast("bigint").alias("n"))


@query("parse_rejects", f"""WITH {SPEECH} SELECT doc_id, 'no speech tokens' AS error FROM speech
  WHERE NOT regexp_matches(CASE WHEN contains(text, '|') THEN text ELSE speech END, '<\\|s_\\d+\\|>')""")
def parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    output = F.when(F.contains("text", F.lit("|")), F.col("text")).otherwise(F.col("speech"))
    parsed = parse_generated(token_strings(spark, sf).withColumn("generated", output))
    return parsed.where(F.col("error").isNotNull()).select("doc_id", "error")


@query("token_duration", f"""SELECT doc_id, round(length(text) / CAST({S.TOKEN_RATE_HZ} AS DOUBLE), 6) AS seconds
  FROM documents""")
def token_duration(spark: SparkSession, sf: str) -> DataFrame:
    seconds = A.token_duration(R.tokens())
    return R.documents(spark, sf).select("doc_id", F.round(seconds, 6).alias("seconds"))


@query("token_range", f"""SELECT doc_id, len(list_filter({R.sql_points('text')},
  lambda p: p * 97 < 0 OR p * 97 >= {S.TOKEN_RANGE})) AS outside FROM documents""")
def token_range(spark: SparkSession, sf: str) -> DataFrame:
    ids = F.transform(T.code_points(F.col("text")), lambda c: c * 97)
    return R.documents(spark, sf).select("doc_id", A.out_of_range(ids).cast("bigint").alias("outside"))


@query("chat_messages", f"""WITH {R.PAIRS}
  SELECT id, 'user,assistant' AS roles, text || chr(10) || answer AS contents FROM pairs WHERE answer IS NOT NULL""")
def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    answered = R.pairs(spark, sf).where(F.col("answer").isNotNull())
    messages = answered.select("id", T.build_messages(F.col("text"), F.col("answer")).alias("m"))
    return messages.select(
        "id", F.array_join("m.role", ",").alias("roles"), F.array_join("m.content", "\n").alias("contents")
    )


@query("chatml_render", rf"""WITH {R.PAIRS}
  SELECT id, '{S.TURN_START}user' || chr(10) || {R.sql_strip('text')} || '{S.TURN_END}' || chr(10)
           || '{S.TURN_START}assistant' || chr(10) AS prompt,
         CASE WHEN answer IS NOT NULL THEN '{S.TURN_START}user' || chr(10) || text || '{S.TURN_END}' || chr(10)
           || '{S.TURN_START}assistant' || chr(10) || answer || '{S.TURN_END}' || chr(10) END AS conversation
  FROM pairs""")
def chatml_render(spark: SparkSession, sf: str) -> DataFrame:
    prompt = T.chatml(T.user_message(F.col("text")), generation_prompt=True)
    both = T.chatml(T.build_messages(F.col("text"), F.col("answer")))
    return R.pairs(spark, sf).select(
        "id", prompt.alias("prompt"), F.when(F.col("answer").isNotNull(), both).alias("conversation")
    )


# Two-channel audio of 32 samples from the vectors; one speaker's array is missing and two have no usable rate.
AUDIO = """audio AS (SELECT vec_id, embedding, CASE WHEN label <> 3 THEN embedding END AS samples,
  (label - 1) * 8000 AS rate FROM embeddings)"""


def with_audio(spark: SparkSession, sf: str) -> DataFrame:
    samples = F.when(F.col("label") != 3, F.col("embedding"))
    rate = (F.col("label") - 1) * 8000
    return R.table(spark, sf, "embeddings").select(
        "vec_id", F.struct(samples.alias("array"), rate.alias("sampling_rate")).alias("audio")
    )


@query("filter_payload", f"""WITH {AUDIO} SELECT vec_id, CAST(rate AS BIGINT) AS rate FROM audio
  WHERE samples IS NOT NULL AND rate > 0""")
def filter_payload(spark: SparkSession, sf: str) -> DataFrame:
    kept = filters.audio_present(with_audio(spark, sf))
    return kept.select("vec_id", F.col("audio.sampling_rate").cast("bigint").alias("rate"))


@query("normalize_audio", f"""WITH {AUDIO}, ok AS (SELECT *, samples IS NOT NULL AND rate > 0 AS usable FROM audio)
  SELECT vec_id, CASE WHEN usable THEN CAST(rate AS BIGINT) END AS rate,
         CASE WHEN usable THEN len(samples) END AS samples,
         CASE WHEN usable THEN round(CAST(samples[1] AS DOUBLE), 6) END AS first FROM ok""")
def normalize_audio(spark: SparkSession, sf: str) -> DataFrame:
    normal = with_audio(spark, sf).withColumn("audio", A.normalize_audio(F.col("audio")))
    array = F.col("audio.array")
    return normal.select(
        "vec_id",
        F.col("audio.sampling_rate").cast("bigint").alias("rate"),
        F.when(array.isNotNull(), F.size(array)).cast("bigint").alias("samples"),
        F.round(array[0].cast("double"), 6).alias("first"),
    )


@query("downmix", """SELECT vec_id, CAST(i AS BIGINT) AS pos,
    round(CAST(CAST((CAST(embedding[2 * i + 1] AS DOUBLE) + embedding[2 * i + 2]) / 2 AS FLOAT) AS DOUBLE), 5) AS last,
    round(CAST(CAST((CAST(embedding[i + 1] AS DOUBLE) + embedding[i + 33]) / 2 AS FLOAT) AS DOUBLE), 5) AS first
  FROM embeddings, unnest(range(32)) AS r(i)""")
def downmix(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("embedding")
    last = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.array(e[2 * i], e[2 * i + 1]))
    first = F.array(F.slice(e, 1, 32), F.slice(e, 33, 32))
    mixed = R.table(spark, sf, "embeddings").select(
        "vec_id", A.downmix(last, "last").alias("last"), A.downmix(first, "first").alias("first")
    )
    rows = mixed.select("vec_id", F.posexplode(F.arrays_zip("last", "first")).alias("pos", "s"))
    return rows.select(
        "vec_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.round(F.col("s.last").cast("double"), 5).alias("last"),
        F.round(F.col("s.first").cast("double"), 5).alias("first"),
    )


# Character-level ids of a prompt and of the conversation it opens.
CHAT_IDS = f"""{R.PAIRS}, chat AS (
  SELECT id, '{S.TURN_START}user' || chr(10) || text || '{S.TURN_END}' || chr(10) || '{S.TURN_START}assistant'
         || chr(10) AS prompt, answer FROM pairs WHERE answer IS NOT NULL),
  ids AS (SELECT id, length(prompt) AS prompt_len,
         {R.sql_points(f"(prompt || answer || '{S.TURN_END}' || chr(10))")} AS full_ids FROM chat)"""


def chat_ids(spark: SparkSession, sf: str) -> DataFrame:
    answered = R.pairs(spark, sf).where(F.col("answer").isNotNull())
    asked = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return answered.select(
        "id",
        T.code_points(T.chatml(asked, generation_prompt=True)).alias("prompt_ids"),
        T.code_points(T.chatml(T.build_messages(F.col("text"), F.col("answer")))).alias("full_ids"),
    )


@query("prompt_len", f"WITH {CHAT_IDS} SELECT id, prompt_len FROM ids")
def prompt_len(spark: SparkSession, sf: str) -> DataFrame:
    length = A.prompt_len(F.col("prompt_ids"), F.col("full_ids"))
    return chat_ids(spark, sf).select("id", length.cast("bigint").alias("prompt_len"))


@query("label_mask", f"""WITH {CHAT_IDS} SELECT id, {R.sql_joined(
  f'list_transform(full_ids, lambda p, i: CASE WHEN i <= prompt_len THEN {S.IGNORED_LABEL} ELSE p END)')} AS labels,
  len(full_ids) AS attended FROM ids""")
def label_mask(spark: SparkSession, sf: str) -> DataFrame:
    measured = chat_ids(spark, sf).withColumn("p", A.prompt_len(F.col("prompt_ids"), F.col("full_ids")))
    masked = measured.select(
        "id",
        A.label_mask(F.col("full_ids"), F.col("p")).alias("labels"),
        A.attention_mask(F.col("full_ids")).alias("mask"),
    )
    attended = F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return masked.select("id", R.joined("labels").alias("labels"), attended.alias("attended"))


@query("fits_context", f"""WITH {CHAT_IDS} SELECT id, len(full_ids) AS n FROM ids
  WHERE len(full_ids) <= {S.MAX_SEQ_LEN} AND prompt_len < len(full_ids)""")
def fits_context(spark: SparkSession, sf: str) -> DataFrame:
    measured = chat_ids(spark, sf).withColumn("prompt_len", A.prompt_len(F.col("prompt_ids"), F.col("full_ids")))
    return filters.fits_context(measured, ids="full_ids").select("id", F.size("full_ids").cast("bigint").alias("n"))


@query("drop_empty_examples", f"""WITH {R.PAIRS} SELECT id, length(answer) AS n FROM pairs
  WHERE text <> '' AND length(answer) > 0""")
def drop_empty_examples(spark: SparkSession, sf: str) -> DataFrame:
    encoded = R.pairs(spark, sf).withColumn("speech_tokens", R.tokens("answer"))
    kept = filters.examples_present(encoded)
    return kept.select("id", F.size("speech_tokens").cast("bigint").alias("n"))
