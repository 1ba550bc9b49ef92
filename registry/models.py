"""The inference stage and the whole curation, with deterministic stand-ins for the models."""

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from registry import tables as R
from registry.base import collector
from registry.shards import FRAME, FRAMES, HOP, RATE, SIGNAL_DB, SILENCE_MS
from uttera import settings as S
from uttera.functions import text as T
from uttera.operators.infer import infer, quarantine
from uttera.plans.curation import Curation, Model, curate_corpus
from uttera.plans.evaluation import evaluation_report
from uttera.schemas import FLOATS, INTS
from uttera.session import work_path
from uttera.sources.shards import read_processed

query, QUERIES, ORACLES = collector()

TOKENS = Y.StructType([Y.StructField("tokens", INTS)])


def load() -> dict:
    return {"range": S.TOKEN_RANGE}


def encode_text(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    """Tokens of each text; a table row, which holds a bar, cannot be read."""
    if batch["text"].str.contains("|", regex=False).any():
        raise ValueError("unreadable")
    points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) % model["range"] for t in batch["text"]]
    return pd.DataFrame({"tokens": [p.astype(np.int32) for p in points]})


def inferred(spark: SparkSession, sf: str) -> DataFrame:
    return infer(R.documents(spark, sf), load, encode_text, TOKENS, ["text"], ["doc_id"], "encode")


@query("infer_stage", f"""SELECT doc_id, CASE WHEN NOT contains(text, '|') THEN length(text) END AS n,
    CASE WHEN NOT contains(text, '|') THEN CAST(list_sum({R.sql_tokens('text')}) AS BIGINT) END AS token_sum,
    CASE WHEN contains(text, '|') THEN 'encode: unreadable' END AS error FROM documents""")
def infer_stage(spark: SparkSession, sf: str) -> DataFrame:
    total = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)
    count = F.when(F.col("tokens").isNotNull(), F.size("tokens")).cast("bigint")
    return inferred(spark, sf).select("doc_id", count.alias("n"), total.alias("token_sum"), "error")


@query("quarantine", "SELECT doc_id, 'encode: unreadable' AS error FROM documents WHERE contains(text, '|')")
def set_aside(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = quarantine(inferred(spark, sf))
    return rejected.select("doc_id", "error")


# The whole flow: a text's characters are its audio samples, which the stand-in transcriber reads back.
def transcribe(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    texts = [(np.asarray(a["array"]) + 32).astype(np.uint32).tobytes().decode("utf-32-le") for a in batch["audio"]]
    if any("|" in t for t in texts):
        raise ValueError("unreadable")
    return pd.DataFrame({"transcript": texts})


def encode_audio(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    samples = [np.asarray(a["array"]) for a in batch["audio"]]
    return pd.DataFrame({
        "speech_tokens": [((s.astype(np.float64) + 32) % model["range"]).astype(np.int32) for s in samples],
        "global_embedding": [np.array([len(s), s.max()], dtype=np.float32) for s in samples],
    })


SPEC = Curation(
    language=R.LANGUAGE,
    state=None,
    keep_class=R.KEPT,
    script=R.LATIN,
    max_chars=R.MAX_CHARS,
    top_db=SIGNAL_DB,
    min_silence_ms=SILENCE_MS,
    frame_length=FRAME,
    hop=HOP,
    rows_per_shard=7,
)

CURATE_FLOW = f"""WITH {R.UTTERANCES}, {FRAMES}, marked AS (SELECT doc_id, frame,
    energy > max(energy) OVER (PARTITION BY doc_id) * pow(10, -{SIGNAL_DB} / 10.0) AS loud FROM frames),
  edges AS (SELECT doc_id, frame - lag(frame) OVER (PARTITION BY doc_id ORDER BY frame) - 1 AS silent
    FROM marked WHERE loud),
  gaps AS (SELECT doc_id, count(*) FILTER (silent >= 1 AND silent * {HOP} >= {RATE * SILENCE_MS // 1000}) AS gaps
    FROM edges GROUP BY doc_id),
  heard AS (SELECT u.*, {R.sql_clean('u.text')} AS cleaned, g.gaps FROM utterances u JOIN gaps g
      ON g.doc_id = u.source_index
    WHERE language = '{R.LANGUAGE}' AND duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}
      AND NOT contains(u.text, '|')),
  valid AS (SELECT * FROM heard WHERE {R.sql_valid('cleaned')})
  SELECT config, CAST((row_number() OVER (PARTITION BY config ORDER BY source_index) - 1) // 7 AS INTEGER) AS shard,
    seq || '_' || "speakerID" AS id, tagged AS text, {R.sql_joined(R.sql_tokens('text'))} AS speech_tokens,
    length(text) AS dim_one
  FROM ({R.sql_paused('cleaned', 'gaps', 'valid')})"""


def audio_of(text: str):
    samples = F.transform(T.code_points(F.col(text)), lambda p: (p - 32).cast("float"))
    return F.struct(samples.alias("array"), F.lit(RATE).alias("sampling_rate")).alias("audio")


def raw_audio(spark: SparkSession, sf: str) -> DataFrame:
    return R.utterances(spark, sf).withColumn("audio", audio_of("text")).drop("text")


@query("curate_flow", CURATE_FLOW)
def curate_flow(spark: SparkSession, sf: str) -> DataFrame:
    out = work_path(spark, "curated")
    curate_corpus(raw_audio(spark, sf), Model(load, transcribe), Model(load, encode_audio), out, spec=SPEC)
    stored = read_processed(spark, out)
    return shown(stored)


def shown(stored: DataFrame, *more: Column) -> DataFrame:
    return stored.select(
        "config",
        "shard",
        "id",
        "text",
        R.joined("speech_tokens").alias("speech_tokens"),
        F.col("global_embedding")[0].cast("bigint").alias("dim_one"),
        *more,
    )


LIMIT = 20


@query("curate_limited", f"SELECT * FROM ({CURATE_FLOW}) ORDER BY config, shard, CAST(split_part(id, '_', 1) AS BIGINT) LIMIT {LIMIT}")
def curate_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The first accepted rows of the run, in a dry run: the models see a part of the corpus only."""
    run = curate_corpus(
        raw_audio(spark, sf), Model(load, transcribe), Model(load, encode_audio), "", spec=SPEC, limit=LIMIT, dry_run=True
    )
    return shown(run.shards)


def encode_some(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    """Some signals cannot be encoded, others give no tokens, by their lengths."""
    if any(len(a["array"]) % 11 == 0 for a in batch["audio"]):
        raise ValueError("unreadable")
    made = encode_audio(model, batch)
    made["speech_tokens"] = [t[:0] if len(t) % 7 == 0 else t for t in made["speech_tokens"]]
    return made


@query("curate_funnel", f"""WITH {R.UTTERANCES}, plain AS (SELECT *, coalesce(language = '{R.LANGUAGE}', false) AS lang_ok,
    coalesce(duration IS NULL OR duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}, false) AS duration_ok FROM utterances),
  staged AS (SELECT *, CASE WHEN NOT lang_ok THEN 'language' WHEN NOT duration_ok THEN 'duration' WHEN text IS NULL THEN 'audio'
      WHEN contains(text, '|') THEN 'transcribe' WHEN NOT coalesce({R.sql_valid(R.sql_clean('text'))}, false) THEN 'validity'
      WHEN length(text) % 11 = 0 THEN 'encode' WHEN length(text) % 7 = 0 THEN 'no_tokens' ELSE 'accepted' END AS stage FROM plain)
  SELECT count(*) AS seen, {', '.join(f"count(*) FILTER (stage = '{s}') AS dropped_{s}" for s in
      ('language', 'duration', 'audio', 'transcribe', 'validity', 'encode', 'no_tokens'))},
    count(*) FILTER (stage = 'accepted') AS accepted FROM staged""")
def curate_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every row of a run, the models' part counted while they ran."""
    run = curate_corpus(raw_audio(spark, sf), Model(load, transcribe), Model(load, encode_some), "", spec=SPEC, dry_run=True)
    return run.funnel()


# Two channels whose mean is the signal; the encoder hands back what it heard, at half its rate. The samples stay arrays:
# a list takes eight times the memory.
def encode_and_return(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    made = encode_audio(model, batch)
    made["audio"] = [{"array": a["array"], "sampling_rate": int(a["sampling_rate"]) // 2} for a in batch["audio"]]
    return made


@query("curate_flow_stereo", f"""SELECT *, len(string_split(speech_tokens, ',')) AS samples, {RATE // 2} AS rate
  FROM ({CURATE_FLOW})""")
def curate_flow_stereo(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_audio(spark, sf)
    channels = F.transform("audio.array", lambda x: F.array(x - 1, x + 1))
    stereo = raw.withColumn("audio", F.struct(channels.alias("array"), F.col("audio.sampling_rate").alias("sampling_rate")))
    encoder = Model(load, encode_and_return, gives_audio=True)
    run = curate_corpus(
        stereo, Model(load, transcribe), encoder, work_path(spark, "stereo"), spec=replace(SPEC, keep_audio=True)
    )
    samples = F.size("audio.array").cast("bigint").alias("samples")
    return shown(run.shards, samples, F.col("audio.sampling_rate").alias("rate"))


SAMPLES = Y.StructType([Y.StructField("samples", FLOATS)])


def decode_tokens(model: dict, batch: pd.DataFrame) -> pd.DataFrame:
    pairs = zip(batch["tokens"], batch["voice"])
    return pd.DataFrame({"samples": [np.float32(np.asarray(t) + v[0]) for t, v in pairs]})


@query("decode_stage", f"""SELECT doc_id, length(text) AS n,
    CAST(list_sum(list_transform({R.sql_tokens('text')}, lambda t: t + n_chars % 7)) AS BIGINT) AS total FROM documents""")
def decode_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens and a voice back to samples by a caller's decoder."""
    voice = F.array((F.col("n_chars") % 7).cast("float"))
    spoken = R.documents(spark, sf).select("doc_id", R.tokens().alias("tokens"), voice.alias("voice"))
    decoded = infer(spoken, load, decode_tokens, SAMPLES, ["tokens", "voice"], ["doc_id"], "decode")
    total = F.aggregate("samples", F.lit(0.0).cast("double"), lambda a, x: a + x).cast("bigint")
    return decoded.select("doc_id", F.size("samples").cast("bigint").alias("n"), total.alias("total"))


# A vector is four positions of sixteen logits; the labels count up from the row's own, the first unscored.
@query("evaluation_report", f"""WITH rows AS (SELECT label, [embedding[1:16], embedding[17:32], embedding[33:48],
      embedding[49:64]] AS logits, [{S.IGNORED_LABEL}, label, (label + 1) % 16, (label + 2) % 16] AS labels FROM embeddings),
  preds AS (SELECT *, list_transform(logits, lambda x: list_position(x, list_max(x)) - 1) AS p FROM rows),
  hits AS (SELECT p[i] = labels[i + 1] AS hit FROM preds, unnest(range(1, 4)) AS r(i)
    WHERE labels[i + 1] <> {S.IGNORED_LABEL})
  SELECT count(*) FILTER (hit) AS correct, count(*) AS scored,
    round(count(*) FILTER (hit) / CAST(count(*) AS DOUBLE), 6) AS audio_token_accuracy,
    (SELECT round(exp(avg(label / CAST(10 AS DOUBLE))), 6) FROM embeddings) AS eval_perplexity FROM hits""")
def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    """Logits to one report of accuracy and perplexity."""
    vectors = R.table(spark, sf, "embeddings")
    logits = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * 16 + 1, 16))
    label = F.col("label").cast("int")
    labels = F.array(F.lit(S.IGNORED_LABEL), label, (label + 1) % 16, (label + 2) % 16)
    report = evaluation_report(vectors.select(logits.alias("logits"), labels.alias("labels"), (label / F.lit(10.0)).alias("loss")))
    return report.withColumns({c: F.round(c, 6) for c in ("audio_token_accuracy", "eval_perplexity")})
