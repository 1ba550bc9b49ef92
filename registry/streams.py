"""The streaming forms; each must give what the batch form gives."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as R
from registry.base import collector
from registry.models import CURATE_FLOW, SPEC, audio_of, encode_audio, load, shown, transcribe
from registry.speakers import PRESET_ROWS, long_form
from uttera import settings as S
from uttera.functions import text as T
from uttera.operators import filters
from uttera.plans.curation import Model, accepted_rows, process_rows, select_rows
from uttera.session import work_path
from uttera.sources.corpus import stream_corpus
from uttera.streaming import flows as W

query, QUERIES, ORACLES = collector()


def select_and_clean(df: DataFrame) -> DataFrame:
    df = filters.language_is(df, "lang", R.LANGUAGE)
    df = filters.duration_between(df.withColumn("duration", F.col("n_chars") / R.CHARS_PER_SECOND))
    df = df.withColumn("text", T.clean_transcript(F.col("text"), R.KEPT))
    df = filters.transcript_valid(df, "text", max_chars=R.MAX_CHARS, script=R.LATIN)
    return df.select("doc_id", F.col("source").alias("config"), "text")


CLEANED = f"""cleaned AS (SELECT doc_id, source AS config, {R.sql_clean('text')} AS text FROM documents
    WHERE lang = '{R.LANGUAGE}'
      AND n_chars / CAST({R.CHARS_PER_SECOND} AS DOUBLE) BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}),
  kept AS (SELECT * FROM cleaned WHERE {R.sql_valid('text')})"""


BATCHES = 4


def document_stream(spark: SparkSession, sf: str) -> DataFrame:
    return stream_corpus(spark, f"{sf}/documents.parquet*", R.documents(spark, sf).schema)


@query("stream_curate", f"WITH {CLEANED} SELECT doc_id, config, text FROM kept")
def stream_curate(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    W.run_available(W.stream_curate(document_stream(spark, sf), select_and_clean, out, checkpoint))
    return spark.read.parquet(out)


@query("stream_models", f"""SELECT config, id, text, speech_tokens, dim_one FROM ({CURATE_FLOW})""")
def stream_models(spark: SparkSession, sf: str) -> DataFrame:
    """The curation with its models over a stream of files."""
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")

    def curate(docs: DataFrame) -> DataFrame:
        rows = docs.select(
            F.col("doc_id").alias("UtteranceSequenceID"), F.concat(F.lit("SPK_"), "lang").alias("speakerID"),
            F.lit(None).cast("string").alias("gender"), F.col("source").alias("district"), F.col("lang").alias("language"),
            (F.col("n_chars") / R.CHARS_PER_SECOND).alias("duration"), F.col("source").alias("config"), audio_of("text"),
        )
        models = Model(load, transcribe), Model(load, encode_audio)
        done = process_rows(select_rows(rows, SPEC), *models, SPEC, carry=("config",))
        return accepted_rows(done.where(F.col("error").isNull()), SPEC, carry=("config",))

    W.run_available(W.stream_curate(document_stream(spark, sf), curate, out, checkpoint))
    stored = spark.read.parquet(out).withColumn("shard", F.lit(0))
    return shown(stored).drop("shard")


@query("stream_shards", f"""WITH {CLEANED}, sharded AS (SELECT *, doc_id % 2 AS worker, (row_number() OVER (
    PARTITION BY config, doc_id % 2 ORDER BY doc_id) - 1) // 7 AS shard FROM kept)
  SELECT doc_id, config || '_w' || worker || '_b0_s' || shard AS shard_name, text FROM sharded""")
def stream_shards(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    rows = filters.worker_split(select_and_clean(document_stream(spark, sf)), 2, index="doc_id")
    rows = rows.withColumnRenamed("doc_id", "source_index")
    W.run_available(W.stream_shards(rows, out, checkpoint, rows_per_shard=7))
    stored = spark.read.parquet(out)
    return stored.select(F.col("source_index").alias("doc_id"), W.batch_shard_name().alias("shard_name"), "text")


@query("stream_shards_filled", f"""WITH {CLEANED}, sharded AS (SELECT *, doc_id % 2 AS worker, (row_number() OVER (
    PARTITION BY config, doc_id % 2 ORDER BY doc_id) - 1) // 7 AS shard FROM kept)
  SELECT doc_id, config, CAST(worker AS INTEGER) AS worker, CAST(shard AS INTEGER) AS shard, text FROM sharded""")
def stream_shards_filled(spark: SparkSession, sf: str) -> DataFrame:
    """Several micro-batches give the shards of one run over all rows."""
    root, out, checkpoint = (work_path(spark, n) for n in ("files", "stream", "offsets"))
    docs = R.documents(spark, sf)
    most = docs.agg(F.max("doc_id")).first()[0]
    for part in range(BATCHES):
        # Files are taken in the order in which they were written.
        docs.where(F.floor(F.col("doc_id") * BATCHES / F.lit(most + 1)) == part).write.mode("append").parquet(f"{root}/{part}")
        rows = select_and_clean(stream_corpus(spark, f"{root}/*", docs.schema))
        rows = filters.worker_split(rows, 2, index="doc_id").withColumnRenamed("doc_id", "source_index")
        W.run_available(W.stream_shards(rows, out, checkpoint, rows_per_shard=7))
    stored = spark.read.parquet(out)
    return stored.select(F.col("source_index").alias("doc_id"), "config", F.col("worker").cast("int"), F.col("shard").cast("int"), "text")


@query("stream_presets", PRESET_ROWS)
def stream_presets(spark: SparkSession, sf: str) -> DataFrame:
    out, checkpoint = work_path(spark, "stream"), work_path(spark, "offsets")
    schema = R.table(spark, sf, "embeddings").schema
    rows = stream_corpus(spark, f"{sf}/embeddings.parquet*", schema)
    W.run_available(W.stream_means(rows, "label", "embedding", out, checkpoint))
    return long_form(W.running_presets(spark, out, "label"))
