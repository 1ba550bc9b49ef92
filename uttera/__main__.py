"""Run a whole flow: ``spark-submit`` this package, or ``python -m uttera <flow> ...``.

Models are named as ``module:attribute``, each a ``plans.curation.Model``.
"""

import argparse
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from uttera import settings as S
from uttera.operators import examples, presets
from uttera.operators.shards import samples, shard_sizes
from uttera.plans.curation import Curation, curate_corpus
from uttera.plans.evaluation import evaluation_report
from uttera.plans.synthesis import parse_generated, prepare_requests
from uttera.plans.training import padded_batches, training_set
from uttera.schemas import Columns
from uttera.session import CONF, discard_stored, materialize, work_path
from uttera.sources.manifest import open_corpus
from uttera.sources.presets import read_presets, write_presets
from uttera.sources.shards import read_processed, skipped_files


def named(name: str):
    module, attribute = name.split(":")
    return getattr(import_module(module), attribute)


def curate(spark: SparkSession, args: argparse.Namespace) -> None:
    configs = args.config or None
    # Runs that go on where others stopped keep their numbering of the rows beside their progress.
    manifest = f"{args.progress.rstrip('/')}_files" if args.progress else work_path(spark, "files")
    raw = open_corpus(spark, args.corpus, manifest, configs, args.split)
    names = dict(pair.split("=", 1) for pair in args.column)
    spec = Curation(
        columns=Columns(**names),
        language=args.language,
        state=args.state or None,
        min_duration=args.min_duration,
        max_duration=args.max_duration,
        min_chars=args.min_chars,
        max_chars=args.max_chars,
        keep_class=args.keep_class,
        script=args.script,
        pauses_enabled=not args.no_pauses,
        keep_audio=args.keep_audio,
        transcript_source=args.transcript_source,
        rows_per_shard=args.rows_per_shard,
    )
    run = curate_corpus(
        raw,
        named(args.transcriber),
        named(args.encoder),
        args.out,
        progress=None if args.no_push else args.progress,
        spec=spec,
        num_workers=args.num_workers,
        worker_id=args.worker_id,
        limit=args.limit,
        max_shards=args.max_shards,
        config_order=configs,
        dry_run=args.no_push,
        quarantine=args.quarantine,
    )
    run.funnel().show(truncate=False, vertical=True)
    run.report().show(truncate=False)
    run.rejected.select("config", "source_index", "error").show(truncate=False)
    if args.no_push:
        shard_sizes(run.shards).show(truncate=False)
        samples(run.shards, config_order=configs).show(truncate=False)


def processed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The shards, and a line for each file that cannot be read or is empty: they are passed over."""
    for row in skipped_files(spark, path).toLocalIterator():
        print(f"skipped {row['path']}")
    return read_processed(spark, path)


def build_presets(spark: SparkSession, args: argparse.Namespace) -> None:
    write_presets(presets.speaker_presets(processed_rows(spark, args.processed)), args.out)
    presets.top_speakers(read_presets(spark, args.out).select("speakerID", "n"), args.top).show(args.top, truncate=False)


def build_training_set(spark: SparkSession, args: argparse.Namespace) -> None:
    processed = processed_rows(spark, args.processed)
    known = spark.read.parquet(args.vocabulary) if args.vocabulary else None
    vocab = materialize(examples.vocabulary(processed, known=known), "vocabulary")
    made = training_set(processed, vocab, max_seq_len=args.max_seq_len, eval_ratio=args.eval_ratio, seed=args.seed)
    vocab.write.mode("overwrite").parquet(f"{args.out}/vocabulary")
    made.train.write.mode("overwrite").parquet(f"{args.out}/train")
    made.evaluation.write.mode("overwrite").parquet(f"{args.out}/eval")
    if args.batch_rows:
        for name, batches in zip(("train", "eval"), padded_batches(made, args.batch_rows)):
            batches.write.mode("overwrite").parquet(f"{args.out}/{name}_batches")
    made.sizes.show()


def prompts(spark: SparkSession, args: argparse.Namespace) -> None:
    prepared = prepare_requests(spark.read.parquet(args.requests), read_presets(spark, args.presets))
    prepared.write.mode("overwrite").parquet(args.out)


def parse(spark: SparkSession, args: argparse.Namespace) -> None:
    parse_generated(spark.read.parquet(args.generated)).write.mode("overwrite").parquet(args.out)


def evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    report = evaluation_report(spark.read.parquet(args.outputs), by=tuple(args.by))
    report.write.mode("overwrite").parquet(args.out)
    spark.read.parquet(args.out).show(truncate=False)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="uttera")
    parser.add_argument("--shuffle-partitions", type=int, default=None, help="partitions a shuffle starts from; AQE merges them")
    flows = parser.add_subparsers(required=True)

    def flow(name: str, run, *paths: str) -> argparse.ArgumentParser:
        added = flows.add_parser(name)
        added.set_defaults(run=run)
        for path in (*paths, "out"):
            added.add_argument(f"--{path}", required=True)
        return added

    c = flow("curate", curate, "corpus", "transcriber", "encoder")
    c.add_argument("--config", action="append", help="a config to read; may be repeated (default: all)")
    c.add_argument("--split", default="train")
    c.add_argument("--language", default=S.LANGUAGE)
    c.add_argument("--state", default=S.STATE)
    c.add_argument("--column", action="append", default=[], help="a source column's name, as speaker=speakerID")
    c.add_argument("--min-duration", type=float, default=S.MIN_DURATION_S)
    c.add_argument("--max-duration", type=float, default=S.MAX_DURATION_S)
    c.add_argument("--min-chars", type=int, default=S.MIN_CHARS)
    c.add_argument("--max-chars", type=int, default=S.MAX_CHARS)
    c.add_argument("--keep-class", default=S.KEPT_CLASS, help="characters a transcript keeps, as in a regular expression's brackets")
    c.add_argument("--script", default=S.SCRIPT_CLASS, help="characters of which a transcript must have one")
    c.add_argument("--no-pauses", action="store_true")
    c.add_argument("--keep-audio", action="store_true")
    c.add_argument("--transcript-source", default=S.TRANSCRIPT_SOURCE)
    c.add_argument("--quarantine", default=None, help="folder for the rows a model failed on")
    c.add_argument("--rows-per-shard", type=int, default=S.ROWS_PER_SHARD)
    c.add_argument("--worker-id", type=int, default=None, help="keep one worker's rows (default: all workers')")
    c.add_argument("--num-workers", type=int, default=1)
    c.add_argument("--limit", type=int, default=None, help="most accepted rows per worker")
    c.add_argument("--max-shards", type=int, default=None)
    c.add_argument("--progress", default=None, help="table of how far runs have come")
    c.add_argument("--no-push", action="store_true", help="dry run: report, write nothing")

    p = flow("presets", build_presets, "processed")
    p.add_argument("--top", type=int, default=20)

    t = flow("training-set", build_training_set, "processed")
    t.add_argument("--vocabulary", default=None, help="an earlier run's vocabulary, whose ids are kept")
    t.add_argument("--max-seq-len", type=int, default=S.MAX_SEQ_LEN)
    t.add_argument("--eval-ratio", type=float, default=S.EVAL_RATIO)
    t.add_argument("--batch-rows", type=int, default=None, help="also write padded batches of so many rows")
    t.add_argument("--seed", type=int, default=S.SEED)

    flow("prompts", prompts, "requests", "presets")
    flow("parse", parse, "generated")
    e = flow("evaluate", evaluate, "outputs")
    e.add_argument("--by", action="append", default=[], help="a column to report by; may be repeated")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments().parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName("uttera")
        for key, value in CONF.items():
            builder = builder.config(key, value)
        if args.shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(args.shuffle_partitions))
        spark = builder.getOrCreate()
    try:
        args.run(spark, args)
    finally:
        discard_stored(spark)


if __name__ == "__main__":
    main()
