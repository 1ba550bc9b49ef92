"""The driver's tables in the roles the operators expect, in Spark and in SQL."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.functions import text as T
from uttera.session import spread

# The test corpus is in Latin script, so Latin-1 letters stand in for the script the defaults name.
LATIN = r"\x{C0}-\x{FF}"
KEPT = S.ASCII_KEPT + LATIN
LANGUAGE = "fr"
STATE = "1"
MAX_CHARS = 3000
CHARS_PER_SECOND = 150.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def utterances(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as utterances; labels give state and gender, and most rows have neither."""
    labels = table(spark, sf, "labels")
    return documents(spark, sf).join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("source_index"),
        F.col("source").alias("config"),
        F.col("doc_id").alias("UtteranceSequenceID"),
        F.concat(F.lit("SPK_"), "lang").alias("speakerID"),
        F.col("toxic").cast("string").alias("gender"),
        F.col("source").alias("district"),
        F.col("quality").cast("string").alias("state"),
        F.col("lang").alias("language"),
        (F.col("n_chars") / CHARS_PER_SECOND).alias("duration"),
        "text",
    )


def tokens(text: str = "text") -> Column:
    """Code points as speech tokens."""
    return F.transform(T.code_points(F.col(text)), lambda c: c % S.TOKEN_RANGE)


def joined(ids: Column | str) -> Column:
    column = F.col(ids) if isinstance(ids, str) else ids
    return F.array_join(column.cast("array<string>"), ",")


def digits(ids: str) -> Column:
    """``joined`` of an array of integers without nulls, which JSON writes in one pass and without a string for each."""
    return F.btrim(F.to_json(ids), F.lit("[]"))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the assistant turn that follows, if one does: (id, conv_id, turn, text, answer)."""
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", "text")
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    keyed = asked.join(answers, ["conv_id", "turn"], "left")
    return keyed.withColumn("id", F.concat_ws("_", "conv_id", "turn"))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("speakerID"), F.col("embedding").alias("global_embedding")
    )


# The same roles for the SQL checks.
UTTERANCES = f"""utterances AS (
  SELECT d.doc_id AS source_index, d.source AS config, d.doc_id AS seq, 'SPK_' || d.lang AS "speakerID",
         CAST(l.toxic AS VARCHAR) AS gender, d.source AS district, CAST(l.quality AS VARCHAR) AS state,
         d.lang AS language, d.n_chars / CAST({CHARS_PER_SECOND} AS DOUBLE) AS duration, d.text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

PAIRS = """pairs AS (
  SELECT u.conv_id || '_' || u.turn AS id, u.text, a.text AS answer
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def sql_points(text: str) -> str:
    return f"(CASE WHEN {text} = '' THEN [] ELSE list_transform(string_split({text}, ''), lambda c: unicode(c)) END)"


def sql_tokens(text: str) -> str:
    return f"list_transform({sql_points(text)}, lambda p: p % {S.TOKEN_RANGE})"


def sql_joined(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{S.SPACE_CLASS}]+|[{S.SPACE_CLASS}]+\z', '', 'g')"


def sql_words(text: str) -> str:
    return f"regexp_split_to_array({sql_strip(text)}, '[{S.SPACE_CLASS}]+')"


def sql_clean(text: str, keep: str = KEPT) -> str:
    replaced = rf"regexp_replace({text}, '[^{keep}\s]', ' ', 'g')"
    return rf"trim(regexp_replace({replaced}, '\s+', ' ', 'g'))"


def sql_valid(text: str, max_chars: int = MAX_CHARS) -> str:
    return (
        f"({text} <> '' AND length({sql_strip(text)}) BETWEEN {S.MIN_CHARS} AND {max_chars} "
        f"AND regexp_matches({text}, '[{LATIN}]'))"
    )


def sql_paused(text: str, gaps: str, source: str) -> str:
    """A query giving every row of ``source`` with ``tagged``, its text with pause tags."""
    return f"""SELECT * EXCLUDE (_w, _n, _p), CASE WHEN _n > 0 THEN array_to_string(list_transform(_w,
        lambda x, i: CASE WHEN list_contains(_p, i - 1) THEN '{S.PAUSE_TAG} ' || x ELSE x END), ' ')
      ELSE {text} END AS tagged
    FROM (SELECT *, list_transform(range(1, _n + 1),
            lambda k: CAST(round_even(k * len(_w) / (_n + 1), 0) AS BIGINT)) AS _p
      FROM (SELECT *, CASE WHEN {gaps} > 0 AND len(_w) >= 2 THEN least({gaps}, len(_w) - 1) ELSE 0 END AS _n
        FROM (SELECT *, {sql_words(text)} AS _w FROM {source})))"""
