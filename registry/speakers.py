"""Vectors, presets, requests and the scores of model output."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as R
from registry.base import collector
from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T
from uttera.operators import evaluate as E
from uttera.operators import presets as P
from uttera.plans.synthesis import prepare_requests
from uttera.session import work_path
from uttera.sources.presets import read_presets, write_presets

query, QUERIES, ORACLES = collector()

PRESETS = """used AS (
    SELECT CAST(label AS VARCHAR) AS spk, embedding FROM embeddings WHERE embedding IS NOT NULL),
  dims AS (SELECT spk, i, avg(CAST(embedding[i + 1] AS DOUBLE)) AS m, count(*) AS n
    FROM used, unnest(range(len(embedding))) AS r(i) GROUP BY spk, i),
  presets AS (SELECT spk, i, n, CASE WHEN norm > 0 THEN m / norm ELSE m END AS v
    FROM (SELECT *, sqrt(sum(m * m) OVER (PARTITION BY spk)) AS norm FROM dims))"""
PRESET_ROWS = f"""WITH {PRESETS} SELECT spk AS "speakerID", n, CAST(i AS BIGINT) AS pos,
  round(CAST(CAST(v AS FLOAT) AS DOUBLE), 5) AS value FROM presets"""


def presets(spark: SparkSession, sf: str) -> DataFrame:
    return P.speaker_presets(R.vectors(spark, sf))


def long_form(presets: DataFrame) -> DataFrame:
    rows = presets.select("speakerID", "n", F.posexplode("embedding").alias("pos", "v"))
    return rows.select(
        "speakerID", "n", F.col("pos").cast("bigint").alias("pos"), F.round(F.col("v").cast("double"), 5).alias("value")
    )


def stored_presets(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "presets")
    write_presets(presets(spark, sf), path)
    return read_presets(spark, path)


@query("speaker_presets", PRESET_ROWS)
def speaker_presets(spark: SparkSession, sf: str) -> DataFrame:
    return long_form(presets(spark, sf))


@query("presets_roundtrip", PRESET_ROWS)
def presets_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return long_form(stored_presets(spark, sf))


COUNTS = """SELECT CAST(label AS VARCHAR) AS "speakerID", count(*) AS n FROM embeddings
  WHERE embedding IS NOT NULL GROUP BY label"""


@query("speaker_counts", COUNTS)
def speaker_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.speaker_counts(R.vectors(spark, sf))


@query("top_speakers", f'{COUNTS} ORDER BY n DESC, "speakerID" LIMIT 20')
def top_speakers(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_speakers(P.speaker_counts(R.vectors(spark, sf)), 20)


@query("l2_normalize", """SELECT vec_id, CAST(i AS BIGINT) AS pos, round(embedding[i + 1]
    / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS value
  FROM embeddings, unnest(range(len(embedding))) AS r(i)""")
def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    normal = R.table(spark, sf, "embeddings").select("vec_id", A.l2_normalize(F.col("embedding")).alias("v"))
    rows = normal.select("vec_id", F.posexplode("v").alias("pos", "v"))
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.round("v", 6).alias("value"))


ARGMAX = "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS pred FROM embeddings"


@query("argmax_pred", ARGMAX)
def argmax_pred(spark: SparkSession, sf: str) -> DataFrame:
    logits = R.table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("token", "logit"))
    return E.argmax_pred(logits, ["vec_id"])


@query("argmax_array", ARGMAX)
def argmax_array(spark: SparkSession, sf: str) -> DataFrame:
    return R.table(spark, sf, "embeddings").select("vec_id", A.argmax(F.col("embedding")).alias("pred"))


REQUESTS = """requests AS (SELECT doc_id AS request_id, text,
    CASE WHEN lang = 'es' THEN '' ELSE CAST(doc_id % 12 AS VARCHAR) END AS speaker,
    CASE WHEN source <> 'src7' THEN n_chars END AS ref FROM documents)"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Two of twelve speakers are unknown; Spanish requests name none, and one source's have no reference."""
    speaker = F.when(F.col("lang") == "es", F.lit("")).otherwise((F.col("doc_id") % 12).cast("string"))
    reference = F.when(F.col("source") != "src7", F.array(F.col("n_chars").cast("float")))
    return R.documents(spark, sf).select(
        F.col("doc_id").alias("request_id"), "text", speaker.alias("speaker"), reference.alias("ref_embedding")
    )


@query("attach_preset", f"""WITH {PRESETS}, {REQUESTS}, heads AS (SELECT * FROM presets WHERE i = 0)
  SELECT r.request_id, r.speaker,
    round(CASE WHEN r.speaker <> '' THEN CAST(CAST(h.v AS FLOAT) AS DOUBLE) ELSE CAST(r.ref AS DOUBLE) END, 5) AS head,
    CASE WHEN r.speaker <> '' AND h.v IS NULL THEN 'unknown speaker'
         WHEN r.speaker = '' AND r.ref IS NULL THEN 'no speaker or reference' END AS error
  FROM requests r LEFT JOIN heads h ON h.spk = r.speaker""")
def attach_preset(spark: SparkSession, sf: str) -> DataFrame:
    voiced = P.attach_preset(requests(spark, sf), stored_presets(spark, sf))
    head = F.round(F.col("embedding")[0].cast("double"), 5)
    return voiced.select("request_id", "speaker", head.alias("head"), "error")


@query("synthesis_requests", f"""WITH {PRESETS}, {REQUESTS}, known AS (SELECT DISTINCT spk FROM presets)
  SELECT r.request_id, '{S.TURN_START}user' || chr(10) || {R.sql_strip('r.text')} || '{S.TURN_END}' || chr(10)
    || '{S.TURN_START}assistant' || chr(10) AS prompt
  FROM requests r LEFT JOIN known k ON k.spk = r.speaker
  WHERE k.spk IS NOT NULL OR (r.speaker = '' AND r.ref IS NOT NULL)""")
def synthesis_requests(spark: SparkSession, sf: str) -> DataFrame:
    prepared = prepare_requests(requests(spark, sf), stored_presets(spark, sf))
    return prepared.where(F.col("error").isNull()).select("request_id", "prompt")


@query("unresolved_speakers", f"""WITH {REQUESTS} SELECT speaker, count(*) AS requests FROM requests
  WHERE speaker <> '' AND speaker NOT IN (SELECT CAST(label AS VARCHAR) FROM embeddings) GROUP BY speaker""")
def unresolved_speakers(spark: SparkSession, sf: str) -> DataFrame:
    return P.unresolved_speakers(requests(spark, sf), stored_presets(spark, sf))


# Labels are the text's letters, other characters unscored; the prediction is that the next character repeats.
SCORED = f"""points AS (SELECT doc_id, lang, {R.sql_points('text')} AS p FROM documents),
  scored AS (SELECT lang, p[i] = p[i + 1] AS hit FROM points, unnest(range(1, len(p))) AS r(i)
    WHERE p[i + 1] >= 97)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    points = R.documents(spark, sf).select("doc_id", "lang", T.code_points(F.col("text")).alias("preds"))
    return points.withColumn(
        "labels", F.transform("preds", lambda p: F.when(p >= 97, p).otherwise(F.lit(S.IGNORED_LABEL)))
    )


@query("token_accuracy", f"""WITH {SCORED} SELECT lang, CAST(coalesce(sum(CAST(hit AS BIGINT)), 0) AS BIGINT) AS correct,
  count(*) AS scored, round(sum(CAST(hit AS BIGINT)) / CAST(count(*) AS DOUBLE), 6) AS audio_token_accuracy
  FROM scored GROUP BY lang""")
def token_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    scores = E.token_accuracy(predictions(spark, sf), by=("lang",))
    return scores.withColumn("audio_token_accuracy", F.round("audio_token_accuracy", 6))


@query("perplexity", """SELECT event_type, round(exp(avg(value / 100)), 6) AS eval_perplexity
  FROM events GROUP BY event_type""")
def perplexity(spark: SparkSession, sf: str) -> DataFrame:
    losses = R.table(spark, sf, "events").select("event_type", (F.col("value") / 100).alias("loss"))
    return E.perplexity(losses, by=("event_type",)).withColumn("eval_perplexity", F.round("eval_perplexity", 6))
