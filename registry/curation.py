"""Reading, filtering, cleaning and projecting utterances."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import tables as R
from registry.base import collector
from uttera import settings as S
from uttera.functions import text as X
from uttera.operators import curate, filters
from uttera.operators.ranking import with_source_index
from uttera.session import work_path
from uttera.sources.corpus import read_corpus

query, QUERIES, ORACLES = collector()

SELECTED = f"""language = '{R.LANGUAGE}' AND state = '{R.STATE}'
  AND (duration IS NULL OR duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S})"""


@query("read_corpus", "SELECT doc_id, source AS config, n_chars, doc_id AS source_index FROM documents")
def whole_corpus(spark: SparkSession, sf: str) -> DataFrame:
    schema = R.documents(spark, sf).schema
    corpus = read_corpus(spark, f"{sf}/documents.parquet", schema=schema, config_column="source")
    return with_source_index(corpus).select("doc_id", F.col("source").alias("config"), "n_chars", "source_index")


CHOSEN = ("src1", "src3")


@query("chosen_configs", f"""SELECT doc_id, source AS config, lang AS split FROM documents
  WHERE source IN {CHOSEN} AND lang = 'en'""")
def chosen_configs(spark: SparkSession, sf: str) -> DataFrame:
    """Some configs and one split of a corpus in partition folders."""
    path = work_path(spark, "corpus")
    rows = R.documents(spark, sf).select("doc_id", F.col("source").alias("config"), F.col("lang").alias("split"))
    rows.write.partitionBy("config", "split").parquet(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType())])
    return read_corpus(spark, path, list(CHOSEN), "en", schema=schema, indexed=True).drop("source_index")


@query("filter_language", f"SELECT doc_id, lang FROM documents WHERE lang = '{R.LANGUAGE}'")
def filter_language(spark: SparkSession, sf: str) -> DataFrame:
    return filters.language_is(R.documents(spark, sf), "lang", R.LANGUAGE).select("doc_id", "lang")


@query("filter_state", f"WITH {R.UTTERANCES} SELECT source_index, state FROM utterances WHERE state = '{R.STATE}'")
def filter_state(spark: SparkSession, sf: str) -> DataFrame:
    return filters.state_is(R.utterances(spark, sf), "state", R.STATE).select("source_index", "state")


@query("filter_duration", f"""WITH {R.UTTERANCES} SELECT source_index, round(duration, 6) AS duration FROM utterances
  WHERE duration IS NULL OR duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}""")
def filter_duration(spark: SparkSession, sf: str) -> DataFrame:
    kept = filters.duration_between(R.utterances(spark, sf))
    return kept.select("source_index", F.round("duration", 6).alias("duration"))


@query("worker_split", "SELECT doc_id, CAST(doc_id % 3 AS INTEGER) AS worker FROM documents")
def worker_split(spark: SparkSession, sf: str) -> DataFrame:
    return filters.worker_split(R.documents(spark, sf), 3, index="doc_id").select("doc_id", "worker")


@query("clean_transcript", f"SELECT doc_id, {R.sql_clean('text')} AS text FROM documents")
def clean_transcript(spark: SparkSession, sf: str) -> DataFrame:
    return R.documents(spark, sf).select("doc_id", X.clean_transcript(F.col("text"), R.KEPT).alias("text"))


@query("valid_transcript", f"SELECT doc_id, length(text) AS chars FROM documents WHERE {R.sql_valid('text')}")
def valid_transcript(spark: SparkSession, sf: str) -> DataFrame:
    kept = filters.transcript_valid(R.documents(spark, sf), "text", max_chars=R.MAX_CHARS, script=R.LATIN)
    return kept.select("doc_id", F.length("text").cast("bigint").alias("chars"))


# Tokens from the letters outside ASCII: text without such letters encodes to none.
@query("filter_tokens", f"""SELECT doc_id, len(tokens) AS n FROM (
  SELECT doc_id, {R.sql_tokens("regexp_replace(text, '[^{}]', '', 'g')".format(R.LATIN))} AS tokens FROM documents)
  WHERE len(tokens) > 0""")
def filter_tokens(spark: SparkSession, sf: str) -> DataFrame:
    letters = R.documents(spark, sf).withColumn("letters", F.regexp_replace("text", f"[^{R.LATIN}]", ""))
    encoded = letters.withColumn("speech_tokens", R.tokens("letters"))
    return filters.tokens_present(encoded).select("doc_id", F.size("speech_tokens").cast("bigint").alias("n"))


def curated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents through the plain-column filters, cleaning and validation to processed rows, with their index."""
    df = filters.language_is(R.utterances(spark, sf), "language", R.LANGUAGE)
    df = filters.state_is(df, "state", R.STATE)
    df = filters.duration_between(df)
    df = df.withColumn("text", X.clean_transcript(F.col("text"), R.KEPT))
    df = filters.transcript_valid(df, "text", max_chars=R.MAX_CHARS, script=R.LATIN)
    df = filters.tokens_present(df.withColumn("speech_tokens", R.tokens("text")))
    vectors = R.vectors(spark, sf).select(F.col("vec_id").alias("source_index"), "global_embedding")
    return curate.build_rows(df.join(vectors, "source_index", "left"), keep=("config", "source_index"))


CURATED = f"""{R.UTTERANCES}, cleaned AS (
  SELECT * REPLACE ({R.sql_clean('text')} AS text) FROM utterances WHERE {SELECTED}),
  curated AS (
  SELECT c.seq || '_' || c."speakerID" AS id, c."speakerID", c.gender, c.district, c.language, c.duration, c.text,
         c.text AS transcript, '{S.TRANSCRIPT_SOURCE}' AS transcript_source,
         {R.sql_tokens('c.text')} AS speech_tokens, e.embedding AS global_embedding, c.config, c.source_index
  FROM cleaned c LEFT JOIN embeddings e ON e.vec_id = c.source_index WHERE {R.sql_valid('c.text')})"""


@query("curate_rows", f"""WITH {CURATED}
  SELECT id, "speakerID", gender, district, language, round(duration, 6) AS duration, text, transcript,
         transcript_source, {R.sql_joined('speech_tokens')} AS speech_tokens, len(speech_tokens) AS num_speech_tokens,
         len(global_embedding) AS emb_dim, round(CAST(global_embedding[1] AS DOUBLE), 6) AS emb_first
  FROM curated""")
def curate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return curated(spark, sf).select(
        "id", "speakerID", "gender", "district", "language", F.round("duration", 6).alias("duration"), "text",
        "transcript", "transcript_source", R.joined("speech_tokens").alias("speech_tokens"),
        F.col("num_speech_tokens").cast("bigint").alias("num_speech_tokens"),
        F.size("global_embedding").cast("bigint").alias("emb_dim"),
        F.round(F.col("global_embedding")[0].cast("double"), 6).alias("emb_first"),
    )


@query("curation_funnel", f"""WITH {R.UTTERANCES}, checked AS (
  SELECT config, coalesce(language = '{R.LANGUAGE}', false) AS a, coalesce(state = '{R.STATE}', false) AS b,
         duration IS NULL OR duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S} AS c,
         {R.sql_valid(R.sql_clean('text'))} AS d FROM utterances)
  SELECT config, count(*) AS seen, count(*) FILTER (NOT a) AS dropped_language,
         count(*) FILTER (a AND NOT b) AS dropped_state, count(*) FILTER (a AND b AND NOT c) AS dropped_duration,
         count(*) FILTER (a AND b AND c AND NOT d) AS dropped_transcript,
         count(*) FILTER (a AND b AND c AND d) AS accepted
  FROM checked GROUP BY config""")
def curation_funnel(spark: SparkSession, sf: str) -> DataFrame:
    stages = curate.curation_stages(language=R.LANGUAGE, state=R.STATE)
    cleaned = X.clean_transcript(F.col("text"), R.KEPT)
    stages["transcript"] = X.valid_transcript(cleaned, max_chars=R.MAX_CHARS, script=R.LATIN)
    return curate.funnel(R.utterances(spark, sf), stages, by=("config",))

