"""Utterances to processed shards."""

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera import settings as S
from uttera.functions import arrays as A
from uttera.functions import signal
from uttera.functions import text as X
from uttera.operators import curate, filters, shards
from uttera.operators.infer import infer
from uttera.schemas import AUDIO, FLOATS, INTS, Columns
from uttera.session import materialize
from uttera.sources.manifest import IndexedCorpus
from uttera.sources.progress import load_progress, save_progress
from uttera.sources.shards import write_shards


@dataclass(frozen=True)
class Model:
    """``load()`` gives the model, once per task; ``apply(model, batch)`` maps the ``audio`` column to outputs.

    A transcriber returns ``transcript`` (string), an encoder ``speech_tokens`` and ``global_embedding``, and with
    ``gives_audio`` also the ``audio`` it encoded, at its own rate, which is then what ``keep_audio`` keeps.
    """

    load: Callable[[], Any]
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame]
    gives_audio: bool = False


@dataclass(frozen=True)
class Curation:
    columns: Columns = field(default_factory=Columns)
    language: str = S.LANGUAGE
    state: str | None = S.STATE
    min_duration: float = S.MIN_DURATION_S
    max_duration: float = S.MAX_DURATION_S
    keep_class: str = S.KEPT_CLASS
    script: str = S.SCRIPT_CLASS
    min_chars: int = S.MIN_CHARS
    max_chars: int = S.MAX_CHARS
    drop_empty: bool = True
    pauses_enabled: bool = True
    pause_tags: bool = True
    pause_tag: str = S.PAUSE_TAG
    top_db: float = S.TOP_DB
    min_silence_ms: int = S.MIN_SILENCE_MS
    frame_length: int = S.FRAME_LENGTH
    hop: int = S.HOP_LENGTH
    keep_audio: bool = False
    transcript_source: str = S.TRANSCRIPT_SOURCE
    rows_per_shard: int = S.ROWS_PER_SHARD
    shards_per_folder: int = S.SHARDS_PER_FOLDER
    # Rows ordered by one task; None: few where they carry audio.
    bucket_rows: int | None = None
    batch_rows: int = 64


    @property
    def ordered_rows(self) -> int:
        return self.bucket_rows or (S.AUDIO_BUCKET_ROWS if self.keep_audio else S.BUCKET_ROWS)


TRANSCRIPT = T.StructType([T.StructField("transcript", T.StringType())])
ENCODING = T.StructType([T.StructField("speech_tokens", INTS), T.StructField("global_embedding", FLOATS)])


def select_rows(raw: DataFrame, spec: Curation = Curation()) -> DataFrame:
    """The filters on plain columns: they come before the models, and reach the scan."""
    c = spec.columns
    df = filters.language_is(raw, c.language, spec.language)
    df = filters.state_is(df, c.state, spec.state)
    df = filters.duration_between(df, c.duration, spec.min_duration, spec.max_duration)
    return filters.audio_present(df, c.audio)


def mono(df: DataFrame, audio: str) -> Column:
    """The audio column; samples of several channels are averaged."""
    column, kind = F.col(audio), df.schema[audio].dataType
    if isinstance(kind["array"].dataType.elementType, T.ArrayType):
        return F.struct(A.downmix(column["array"]).alias("array"), column["sampling_rate"].alias("sampling_rate"))
    return column


#: What becomes of the rows that reach the models, in order.
MODEL_DROPS = ("transcribe", "validity", "encode", "no_tokens")


def process_rows(
    selected: DataFrame,
    transcribe: Model,
    encode: Model,
    spec: Curation = Curation(),
    carry: tuple[str, ...] = (),
    observed: list[Observation] | None = None,
) -> DataFrame:
    """Transcribe, clean, validate, tag pauses, encode; rows a model failed on keep their ``error``.

    ``carry`` names further columns to take along, such as the source index. Into ``observed`` go counts of what is
    dropped where, which are taken while the result is written: they cost no pass of their own. A stream has none.
    """
    c = spec.columns
    named = [c.sequence, c.speaker, c.gender, c.district, c.language, c.duration, *carry]
    source = selected.withColumn("_audio", A.normalize_audio(mono(selected, c.audio)))

    pauses = spec.pauses_enabled and spec.pause_tags

    def hear(model: Any, batch: pd.DataFrame) -> pd.DataFrame:
        """The transcript, and the silences, counted while the audio is in Python anyway."""
        heard = transcribe.apply(model, batch.rename(columns={"_audio": "audio"}))
        if pauses:
            powers = [signal.frame_powers(a["array"], spec.frame_length, spec.hop) for a in batch["_audio"]]
            rates = [a["sampling_rate"] for a in batch["_audio"]]
            heard["gaps"] = [
                signal.silences(p, r, spec.hop, spec.top_db, spec.min_silence_ms) for p, r in zip(powers, rates)
            ]
        return heard

    def speak(model: Any, batch: pd.DataFrame) -> pd.DataFrame:
        spoken = encode.apply(model, batch.rename(columns={"_audio": "audio", "_heard": "audio"}))
        return spoken.rename(columns={"audio": "_audio"})

    hearing = T.StructType([*TRANSCRIPT.fields, *([T.StructField("gaps", T.IntegerType())] if pauses else [])])
    heard = infer(
        source, transcribe.load, hear, hearing, ["_audio"], [*named, "_audio"], "transcribe", spec.batch_rows
    )
    failed = F.col("error").isNotNull()
    text = X.clean_transcript(F.col("transcript"), spec.keep_class)
    heard = heard.withColumn("text", text).drop("transcript")
    if spec.drop_empty:
        valid = F.coalesce(X.valid_transcript(F.col("text"), spec.min_chars, spec.max_chars, spec.script), F.lit(False))
        heard = _observe(heard, observed, transcribe=failed, validity=~failed & ~valid).where(failed | valid)
    else:
        heard = _observe(heard, observed, transcribe=failed, validity=F.lit(False))
    if pauses:
        heard = heard.withColumn("text", X.insert_pause_tags(F.col("text"), F.col("gaps"), spec.pause_tag))
    returned = spec.keep_audio and encode.gives_audio
    kept = [*named, "text", *(["_audio"] if spec.keep_audio and not returned else [])]
    encoding = T.StructType([*ENCODING.fields, *([T.StructField("_audio", AUDIO)] if returned else [])])
    if returned:
        heard = heard.withColumnRenamed("_audio", "_heard")
    encoded = infer(heard, encode.load, speak, encoding, ["_heard" if returned else "_audio"], kept, "encode", spec.batch_rows)
    tokens = F.coalesce(F.size("speech_tokens") > 0, F.lit(False))
    unspoken = F.coalesce(F.col("error").startswith("encode:"), F.lit(False))
    return _observe(encoded, observed, encode=unspoken, no_tokens=~failed & ~tokens, accepted=~failed & tokens).where(failed | tokens)


def _observe(df: DataFrame, observed: list[Observation] | None, **conditions: Column) -> DataFrame:
    if observed is None:
        return df
    observed.append(Observation())
    return df.observe(observed[-1], *[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def accepted_rows(processed: DataFrame, spec: Curation = Curation(), carry: tuple[str, ...] = ()) -> DataFrame:
    audio = "_audio" if spec.keep_audio else None
    return curate.build_rows(processed, spec.columns, keep=carry, audio=audio, transcript_source=spec.transcript_source)


@dataclass
class CurationRun:
    """``sources`` are the rows that the run looked at, ``observed`` what the models' part of it counted."""

    shards: DataFrame
    rejected: DataFrame
    spec: Curation
    sources: list[DataFrame]
    observed: list[Observation]

    def funnel(self) -> DataFrame:
        """One row: rows seen, rows dropped at each stage in order, rows accepted; a limit may cut the accepted ones further.

        The stages on plain columns are counted by a scan of those, the others were counted when the models ran.
        """
        c, spec = self.spec.columns, self.spec
        stages = curate.curation_stages(c, spec.language, spec.state, spec.min_duration, spec.max_duration)
        plain = reduce(DataFrame.unionByName, self.sources)
        plain = curate.funnel(plain, stages | {"audio": filters.audio_ok(c.audio)}).drop("accepted")
        total: dict[str, int] = dict.fromkeys((*MODEL_DROPS, "accepted"), 0)
        for observation in self.observed:
            for name, count in observation.get.items():
                total[name] += count
        counted = {f"dropped_{name}": F.lit(total[name]).cast("bigint") for name in MODEL_DROPS}
        return plain.withColumns(counted | {"accepted": F.lit(total["accepted"]).cast("bigint")})

    def report(self) -> DataFrame:
        """Rows accepted and rows a model failed on, per config."""
        accepted = self.shards.groupBy("config").agg(F.count(F.lit(1)).alias("accepted"))
        failed = self.rejected.groupBy("config").agg(F.count(F.lit(1)).alias("failed"))
        both = accepted.join(failed, "config", "full")
        return both.select("config", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("accepted", "failed")])


def _reached(extent: list, accepted: dict, hi: int, most: int | None, limit: int | None, order: list[str] | None) -> bool:
    """Are the rows before index ``hi`` enough for every worker? ``extent``: its configs with their last indexes."""
    place = {config: at for at, config in enumerate(order or [])}
    workers: dict = {}
    for config, worker, last in sorted(extent, key=lambda e: (place.get(e[0], -1), str(e[0]))):
        workers.setdefault(worker, []).append((config, last))
    for worker, configs in workers.items():
        total = 0
        for config, last in configs:
            count = min(accepted.get((config, worker), 0), most or (1 << 62))
            total += count
            if limit and total >= limit:
                break
            if last >= hi and not (most and count >= most):
                return False
    return True


def infer_rows(
    slice_of: Callable[[int, int], DataFrame],
    extent_of: Callable[[], list],
    run: Callable[[DataFrame], DataFrame],
    spec: Curation,
    first: int = 0,
    limit: int | None = None,
    max_shards: int | None = None,
    config_order: list[str] | None = None,
) -> DataFrame:
    """The rows of ``slice_of(lo, hi)`` through the models, slice by slice from index ``first``, each four times the one
    before, until there are enough for a limit or a number of shards: what is run is bounded by what is wanted.

    ``extent_of()`` gives (config, worker, last index) as far as it is known after a slice.
    """
    most = max_shards * spec.rows_per_shard if max_shards else None
    lo, width, parts = first, max(S.FIRST_SLICE, 2 * min(x for x in (limit, most) if x)), []
    while True:
        parts.append(materialize(run(slice_of(lo, lo + width)), "inferred"))
        lo, width = lo + width, 4 * width
        stored = reduce(DataFrame.unionByName, parts)
        counts = stored.where(F.col("error").isNull()).groupBy("config", "worker").count().collect()
        if _reached(extent_of(), {(r[0], r[1]): r[2] for r in counts}, lo, most, limit, config_order):
            return stored


def _first_fresh(corpus: IndexedCorpus, done: DataFrame | None, workers: int) -> int:
    """The first index that some worker of some config has not consumed."""
    if done is None:
        return 0
    corpus.extend(1)
    state = done.groupBy("config").agg(F.min("streamed_consumed").alias("done"), F.count("*").alias("workers"))
    known = corpus.sizes().join(state, "config", "left")
    fresh = F.when(F.col("workers") >= workers, F.col("done")).otherwise(F.lit(0))
    return known.agg(F.min(F.coalesce(fresh, F.lit(0)))).first()[0] or 0


def curate_corpus(
    raw: DataFrame | IndexedCorpus,
    transcribe: Model,
    encode: Model,
    out: str,
    progress: str | None = None,
    spec: Curation = Curation(),
    num_workers: int = 1,
    worker_id: int | None = None,
    limit: int | None = None,
    max_shards: int | None = None,
    config_order: list[str] | None = None,
    dry_run: bool = False,
    quarantine: str | None = None,
) -> CurationRun:
    """Run the whole curation of ``raw`` (with ``config`` and ``source_index``) into shards under ``out``.

    With ``progress`` the run skips what earlier runs consumed and records how far it came, after the shards are
    written. ``quarantine`` is a folder for the rows a model failed on. A dry run writes none of them. The models run
    once per row, and with a limit on no more rows than it takes to reach it. An ``IndexedCorpus`` as ``raw`` opens no
    more files than these rows lie in, and files that appear between runs do not shift the numbers of earlier ones.
    """
    carry = ("config", "worker", "source_index")
    corpus = raw if isinstance(raw, IndexedCorpus) else None
    spark: SparkSession = corpus.spark if corpus else raw.sparkSession
    done_before = load_progress(spark, progress, num_workers) if progress else None
    if progress:
        carry = (*carry, "first_shard")

    sources: list[DataFrame] = []
    observed: list[Observation] = []

    def fresh(rows: DataFrame) -> DataFrame:
        split = filters.worker_split(rows, num_workers, worker_id)
        return shards.skip_consumed(split, done_before) if progress else split

    def run(rows: DataFrame) -> DataFrame:
        sources.append(rows)
        return process_rows(select_rows(rows, spec), transcribe, encode, spec, carry, observed)

    workers = range(num_workers) if worker_id is None else [worker_id]
    if not limit and not max_shards:
        inferred = materialize(run(fresh(corpus.rows() if corpus else raw)), "inferred")
    elif corpus:
        inferred = infer_rows(
            lambda lo, hi: fresh(corpus.rows(lo, hi)),
            lambda: [(config, worker, last) for config, last in corpus.extent() for worker in workers],
            run, spec, _first_fresh(corpus, done_before, len(workers)), limit, max_shards, config_order,
        )
    else:
        rows = fresh(raw)
        # One row per config and worker.
        seen = select_rows(rows, spec).groupBy("config", "worker").agg(F.min("source_index").alias("first"), F.max("source_index").alias("last")).collect()
        extent = [(r["config"], r["worker"], r["last"]) for r in seen]
        inferred = infer_rows(
            lambda lo, hi: rows.where((F.col("source_index") >= lo) & (F.col("source_index") < hi)),
            lambda: extent, run, spec, min((r["first"] for r in seen), default=0), limit, max_shards, config_order,
        )
    done, rejected = inferred.where(F.col("error").isNull()).drop("error"), inferred.where(F.col("error").isNotNull())
    rows = accepted_rows(done, spec, carry)
    sharded = shards.assign_shards(
        rows,
        spec.rows_per_shard,
        max_shards,
        first_shard="first_shard" if progress else None,
        bucket_rows=spec.ordered_rows,
    )
    if limit:
        sharded = shards.limit_accepted(sharded, limit, config_order, bucket_rows=spec.ordered_rows)
    if dry_run:
        return CurationRun(sharded, rejected, spec, sources, observed)
    write_shards(sharded, out, per_folder=spec.shards_per_folder)
    if quarantine:
        rejected.write.mode("append").parquet(quarantine)
    if progress:
        sizes = corpus.sizes() if corpus else raw.groupBy("config").agg((F.max("source_index") + 1).alias("source_rows"))
        state = shards.progress_of(sharded, spec.rows_per_shard, sizes, limit, config_order)
        save_progress(state, progress, num_workers)
    return CurationRun(sharded, rejected, spec, sources, observed)
