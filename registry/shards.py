"""Shards, limits, resuming, silence, batches and splits: the order-dependent work."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import tables as R
from registry.base import collector
from registry.curation import CURATED, curated
from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import text as T
from uttera.operators import examples as E
from uttera.operators import filters
from uttera.operators import shards as H
from uttera.operators import silence as Q
from uttera.schemas import PROCESSED
from uttera.session import materialize, work_path
from uttera.sources.progress import load_progress, save_progress
from uttera.sources.shards import read_processed, write_shards

query, QUERIES, ORACLES = collector()

WORKERS = 2
ROWS_PER_SHARD = 7


def accepted(spark: SparkSession, sf: str) -> DataFrame:
    """Utterances of accepted duration, with the worker each belongs to."""
    tagged = filters.worker_split(R.utterances(spark, sf), WORKERS)
    return filters.duration_between(tagged).select("config", "worker", "source_index")


ACCEPTED = f"""{R.UTTERANCES}, accepted AS (
    SELECT config, CAST(source_index % {WORKERS} AS INTEGER) AS worker, source_index FROM utterances
    WHERE duration IS NULL OR duration BETWEEN {S.MIN_DURATION_S} AND {S.MAX_DURATION_S}),
  sharded AS (SELECT *, CAST((row_number() OVER (PARTITION BY config, worker ORDER BY source_index) - 1)
      // {ROWS_PER_SHARD} AS INTEGER) AS shard FROM accepted)"""


@query("assign_shards", f"""WITH {ACCEPTED} SELECT *, config || '_w' || worker || '_s' || shard AS shard_name
  FROM sharded""")
def assign_shards(spark: SparkSession, sf: str) -> DataFrame:
    return H.assign_shards(accepted(spark, sf), ROWS_PER_SHARD)


@query("max_shards", f"WITH {ACCEPTED} SELECT * FROM sharded WHERE shard < 2")
def max_shards(spark: SparkSession, sf: str) -> DataFrame:
    return H.assign_shards(accepted(spark, sf), ROWS_PER_SHARD, max_shards=2).drop("shard_name")


@query("limit_accepted", f"""WITH {ACCEPTED} SELECT config, worker, source_index FROM (
  SELECT *, row_number() OVER (PARTITION BY worker ORDER BY config, source_index) AS pos FROM accepted)
  WHERE pos <= 100""")
def limit_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return H.limit_accepted(accepted(spark, sf), 100)


@query("dry_run_report", f"""WITH {ACCEPTED} SELECT config, worker, shard,
    config || '_w' || worker || '_s' || shard AS shard_name, count(*) AS rows
  FROM sharded GROUP BY config, worker, shard""")
def dry_run_report(spark: SparkSession, sf: str) -> DataFrame:
    return H.shard_sizes(H.assign_shards(accepted(spark, sf), ROWS_PER_SHARD))


@query("dry_run_samples", f"""WITH {CURATED} SELECT "speakerID" AS sid, length(text) AS chars,
    len(speech_tokens) AS tokens, substring(text, 1, 60) AS text
  FROM curated ORDER BY config, source_index LIMIT 3""")
def dry_run_samples(spark: SparkSession, sf: str) -> DataFrame:
    shown = H.samples(curated(spark, sf), 3).drop("emb_dim")
    return shown.withColumns({c: F.col(c).cast("bigint") for c in ("chars", "tokens")})


def stored_shards(spark: SparkSession, sf: str) -> str:
    rows = curated(spark, sf).withColumn("worker", F.pmod("source_index", F.lit(WORKERS)).cast("int"))
    path = work_path(spark, "shards")
    rows = materialize(rows, "curated")
    write_shards(H.assign_shards(rows, ROWS_PER_SHARD).drop("source_index"), path)
    return path


SHARDED = f"""{CURATED}, sharded AS (
  SELECT *, CAST(source_index % {WORKERS} AS INTEGER) AS worker, CAST((row_number() OVER (
    PARTITION BY config, source_index % {WORKERS} ORDER BY source_index) - 1) // {ROWS_PER_SHARD} AS INTEGER) AS shard
  FROM curated)"""


@query("shard_roundtrip", f"""WITH {SHARDED} SELECT config, worker, shard, id, text,
    {R.sql_joined('speech_tokens')} AS speech_tokens FROM sharded""")
def shard_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    stored = read_processed(spark, stored_shards(spark, sf), PROCESSED)
    return stored.select("config", "worker", "shard", "id", "text", R.joined("speech_tokens").alias("speech_tokens"))


@query("read_processed", f"""WITH {CURATED} SELECT id, "speakerID", language, text,
    len(speech_tokens) AS num_speech_tokens FROM curated""")
def read_all_shards(spark: SparkSession, sf: str) -> DataFrame:
    stored = read_processed(spark, [stored_shards(spark, sf), work_path(spark, "absent")])
    return stored.select(
        "id", "speakerID", "language", "text", F.col("num_speech_tokens").cast("bigint").alias("num_speech_tokens")
    )


def first_run(spark: SparkSession, sf: str) -> DataFrame:
    """The state after a run that stopped at two shards per config and worker."""
    path = work_path(spark, "progress")
    done = H.assign_shards(accepted(spark, sf), ROWS_PER_SHARD, max_shards=2)
    sizes = R.documents(spark, sf).groupBy(F.col("source").alias("config")).agg(
        (F.max("doc_id") + 1).alias("source_rows")
    )
    save_progress(H.progress_of(done, ROWS_PER_SHARD, sizes), path)
    return load_progress(spark, path)


STATE = f"""{ACCEPTED}, per_shard AS (
    SELECT config, worker, shard, count(*) AS n, max(source_index) AS last_index FROM sharded WHERE shard < 2
    GROUP BY config, worker, shard),
  state AS (SELECT p.config, p.worker, CAST(max(shard) + 1 AS INTEGER) AS completed_shards,
      CASE WHEN arg_max(n, shard) < {ROWS_PER_SHARD} THEN any_value(s.source_rows) ELSE max(last_index) + 1 END
        AS streamed_consumed
    FROM per_shard p JOIN (SELECT source AS config, max(doc_id) + 1 AS source_rows FROM documents GROUP BY source) s
      ON s.config = p.config GROUP BY p.config, p.worker)"""


@query("resume_state", f"WITH {STATE} SELECT * FROM state")
def resume_state(spark: SparkSession, sf: str) -> DataFrame:
    return first_run(spark, sf)


# The rows left over and their shards are those a single run would have given.
@query("resume_skip", f"""WITH {STATE} SELECT f.* FROM sharded f JOIN state USING (config, worker)
  WHERE f.source_index >= streamed_consumed""")
def resume_skip(spark: SparkSession, sf: str) -> DataFrame:
    left = H.skip_consumed(accepted(spark, sf), first_run(spark, sf))
    return H.assign_shards(left, ROWS_PER_SHARD, first_shard="first_shard").drop("first_shard", "shard_name")


# A user's events are its frames: a gap is silence of ten hours between loud events.
TOP_DB = 12.0
MIN_GAP_US = 36_000_000_000


def event_gaps(spark: SparkSession, sf: str) -> DataFrame:
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return Q.silence_gaps(
        R.table(spark, sf, "events"),
        utterance="user_id",
        order="ts",
        energy="value",
        start=at,
        end=at,
        min_gap=MIN_GAP_US,
        bucket=F.date_trunc("week", "ts"),
        top_db=TOP_DB,
    )


EVENT_GAPS = f"""frames AS (SELECT user_id, ts, epoch_us(ts) AS us,
    10 * log10(value / max(value) OVER (PARTITION BY user_id)) > -{TOP_DB} AS loud FROM events),
  counted AS (SELECT *, count(*) FILTER (NOT loud) OVER (PARTITION BY user_id ORDER BY ts) AS silent FROM frames),
  edges AS (SELECT *, lag(us) OVER w AS last_us, lag(silent) OVER w AS last_silent FROM counted WHERE loud
    WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  gaps AS (SELECT user_id, CAST(count(*) FILTER (silent > last_silent AND us - last_us >= {MIN_GAP_US}) AS INTEGER)
    AS gaps FROM edges GROUP BY user_id)"""


@query("silence_gaps", f"WITH {EVENT_GAPS} SELECT user_id, gaps FROM gaps")
def silence_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return event_gaps(spark, sf)


@query("add_pauses", f"""WITH {EVENT_GAPS}, counted_docs AS (
  SELECT d.doc_id, d.text, coalesce(g.gaps, 0) AS gaps FROM documents d LEFT JOIN gaps g ON g.user_id = d.doc_id)
  SELECT doc_id, tagged AS text FROM ({R.sql_paused('text', 'gaps', 'counted_docs')})""")
def add_pauses(spark: SparkSession, sf: str) -> DataFrame:
    gaps = materialize(event_gaps(spark, sf).withColumnRenamed("user_id", "doc_id"), "gaps")
    return Q.add_pauses(R.documents(spark, sf).select("doc_id", "text"), gaps, "doc_id")


# A text read as a signal: a character's code point above the space's is its sample.
FRAME, HOP, RATE, SIGNAL_DB, SILENCE_MS = 8, 2, 10, 4.0, 400
# A zero at the end opens the last frame's hop.
FRAMES = f"""samples AS (SELECT doc_id, list_append({R.sql_points('text')}, 32) AS s FROM documents),
  flat AS (SELECT doc_id, unnest(s) - 32 AS x, generate_subscripts(s, 1) - 1 AS i FROM samples),
  hops AS (SELECT doc_id, i // {HOP} AS b, sum(x * x) AS e FROM flat GROUP BY doc_id, i // {HOP}),
  frames AS (SELECT doc_id, b AS frame, CAST(sum(e) OVER (PARTITION BY doc_id ORDER BY b
      ROWS BETWEEN {FRAME // HOP // 2} PRECEDING AND {FRAME // HOP // 2 - 1} FOLLOWING) AS DOUBLE) / {FRAME} AS energy
    FROM hops)"""
SIGNAL_GAPS = f"""WITH {FRAMES}, marked AS (SELECT doc_id, frame,
    10 * log10(greatest(energy, {S.POWER_FLOOR})) - 10 * log10(greatest(max(energy) OVER (PARTITION BY doc_id),
    {S.POWER_FLOOR})) > -{SIGNAL_DB} AS loud FROM frames),
  edges AS (SELECT doc_id, frame - lag(frame) OVER (PARTITION BY doc_id ORDER BY frame) - 1 AS silent
    FROM marked WHERE loud)
  SELECT doc_id, CAST(count(*) FILTER (silent >= 1 AND silent * {HOP} >= {RATE * SILENCE_MS // 1000}) AS INTEGER)
    AS gaps FROM edges GROUP BY doc_id"""


def signals(spark: SparkSession, sf: str) -> DataFrame:
    points = T.code_points(F.col("text"))
    return R.documents(spark, sf).select("doc_id", F.transform(points, lambda p: p - 32).alias("samples"))


@query("frame_energy", f"""WITH {FRAMES} SELECT doc_id, count(*) AS frames, round(max(energy), 6) AS peak,
    round(sum(energy), 4) AS total FROM frames GROUP BY doc_id""")
def frame_energy(spark: SparkSession, sf: str) -> DataFrame:
    frames = Q.frame_energy(signals(spark, sf), "doc_id", F.col("samples"), FRAME, HOP)
    return frames.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("frames"),
        F.round(F.max("energy"), 6).alias("peak"),
        F.round(F.sum("energy"), 4).alias("total"),
    )


@query("signal_gaps", SIGNAL_GAPS)
def signal_gaps(spark: SparkSession, sf: str) -> DataFrame:
    counted = Q.signal_gaps(
        signals(spark, sf), F.col("samples"), F.lit(RATE), FRAME, HOP, SIGNAL_DB, SILENCE_MS
    )
    return counted.select("doc_id", "gaps")


@query("frame_gaps", SIGNAL_GAPS)
def frame_gaps(spark: SparkSession, sf: str) -> DataFrame:
    frames = Q.frame_energy(signals(spark, sf), "doc_id", F.col("samples"), FRAME, HOP)
    return Q.frame_gaps(frames, "doc_id", RATE, SIGNAL_DB, SILENCE_MS)


PIECE = 97


@query("cut_recording_gaps", SIGNAL_GAPS)
def cut_recording_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Each signal over many rows, cut where no frame ends."""
    whole = signals(spark, sf)
    starts = F.sequence(F.lit(0), F.size("samples") - 1, F.lit(PIECE))
    pieces = whole.where(F.size("samples") > 0).select("doc_id", "samples", F.explode(starts).alias("start"))
    pieces = pieces.select("doc_id", "start", F.slice("samples", F.col("start") + 1, PIECE).alias("samples"))
    return Q.piece_gaps(pieces, "doc_id", F.col("start"), F.col("samples"), RATE, FRAME, HOP, SIGNAL_DB, SILENCE_MS)


BATCH = 4


@query("pad_batches", f"""WITH sized AS (SELECT doc_id, length(text) AS n,
    (row_number() OVER (ORDER BY doc_id) - 1) // {BATCH} AS batch_id, {R.sql_points('text')} AS p FROM documents),
  longest AS (SELECT *, max(n) OVER (PARTITION BY batch_id) AS m FROM sized)
  SELECT batch_id, doc_id, m AS padded, md5({R.sql_joined("p || list_transform(range(m - n), lambda x: 0)")}) AS ids,
    md5({R.sql_joined("list_transform(p, lambda x: 1) || list_transform(range(m - n), lambda x: 0)")}) AS attended,
    md5({R.sql_joined(f"p || list_transform(range(m - n), lambda x: {S.IGNORED_LABEL})")}) AS labels FROM longest""")
def pad_batches(spark: SparkSession, sf: str) -> DataFrame:
    ids = R.documents(spark, sf).select("doc_id", T.code_points(F.col("text")).alias("input_ids"))
    examples = ids.select(
        "doc_id",
        "input_ids",
        A.attention_mask(F.col("input_ids")).alias("attention_mask"),
        F.col("input_ids").alias("labels"),
    )
    padded = E.pad_batches(examples, BATCH, pad_id=0, order="doc_id")
    return padded.select(
        "batch_id",
        "doc_id",
        F.size("input_ids").cast("bigint").alias("padded"),
        F.md5(R.digits("input_ids")).alias("ids"),
        F.md5(R.digits("attention_mask")).alias("attended"),
        F.md5(R.digits("labels")).alias("labels"),
    )


SPLIT = f"""split AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('{S.SEED}:' || doc_id))
    <= ceil(CAST({S.EVAL_RATIO} AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM documents)"""


@query("train_eval_split", f"WITH {SPLIT} SELECT doc_id, split FROM split")
def train_eval_split(spark: SparkSession, sf: str) -> DataFrame:
    return E.train_eval_split(R.documents(spark, sf).select("doc_id"), key="doc_id")


@query("split_sizes", f"WITH {SPLIT} SELECT split, count(*) AS rows FROM split GROUP BY split")
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return E.split_sizes(E.train_eval_split(R.documents(spark, sf).select("doc_id"), key="doc_id"))


# 0ccccccccccd is a twentieth of sixteen to the twelfth, rounded up.
@query("hash_split", f"""SELECT doc_id, CASE WHEN substring(md5('{S.SEED}:' || doc_id), 1, 12) < '0ccccccccccd'
  THEN 'test' ELSE 'train' END AS split FROM documents""")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return E.hash_split(R.documents(spark, sf).select("doc_id"), key="doc_id")
