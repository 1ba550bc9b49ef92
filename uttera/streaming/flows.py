"""The curation flow, its shard sink and the running presets, over a stream of files."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from uttera import settings as S
from uttera.operators import presets as P
from uttera.operators.shards import assign_shards
from uttera.session import discard, folder_names, work_path
from uttera.sources.shards import write_shards

BATCH_KEYS = ("config", "worker", "batch", "shard")


def run_available(query: StreamingQuery) -> None:
    """Wait until a query that processes what is there has done so."""
    query.awaitTermination()


def stream_curate(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Apply a stateless transform and append the rows under ``out``, each exactly once.

    A restart with the same checkpoint goes on with the files it has not seen.
    """
    return (
        transform(source)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_batch(
    batch: DataFrame, batch_id: int, out: str, counts: str, rows_per_shard: int = S.ROWS_PER_SHARD, shards_per_folder: int = 1
) -> None:
    """Write a micro-batch into the shards that it goes on filling.

    ``counts`` is a table of the rows that each micro-batch gave a (config, worker). Those of earlier ones add up to where
    this one begins, so a shard that a batch leaves open is filled by the next. A batch that is run again, because its end
    was not recorded, begins where it began and has the same rows, and so replaces what it wrote.
    """
    spark = batch.sparkSession
    # Numbering scans the batch twice; its transforms, models among them, run once, into the shared folder.
    path = work_path(spark, "batch")
    batch.write.parquet(path)
    stored = spark.read.schema(batch.schema).parquet(path)
    per_batch = stored.groupBy("config", "worker").agg(F.count("*").alias("rows"))
    _write_part(per_batch, batch_id, counts)
    earlier = spark.read.parquet(counts).where(F.col("part") < batch_id).groupBy("config", "worker").agg(F.sum("rows").alias("_before"))
    same = F.col("config").eqNullSafe(F.col("_config")) & F.col("worker").eqNullSafe(F.col("_worker"))
    begun = stored.join(earlier.withColumnsRenamed({"config": "_config", "worker": "_worker"}), same, "left")
    sharded = assign_shards(begun, rows_per_shard, rows_before="_before").drop("_before", "_config", "_worker")
    write_shards(sharded.withColumn("batch", F.lit(batch_id).cast("long")), out, BATCH_KEYS, shards_per_folder)
    discard(spark, path)


def stream_shards(
    rows: DataFrame, out: str, checkpoint: str, rows_per_shard: int = S.ROWS_PER_SHARD, shards_per_folder: int = 1
) -> StreamingQuery:
    """Cut a stream of curated rows into shards that fill across micro-batches; a table keeps one number of shards per folder.

    Rows are in their index' order within a micro-batch; if the files come in that order too, the shards are those of
    one run over all of them.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, out, f"{checkpoint}/rows", rows_per_shard, shards_per_folder)

    return (
        rows.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def batch_shard_name() -> Column:
    """The name of the part of a shard that one micro-batch wrote."""
    return F.format_string("%s_w%d_b%d_s%d", *[F.col(c) for c in BATCH_KEYS])


def stream_means(
    rows: DataFrame, speaker: str, vector: str, out: str, checkpoint: str, compact_every: int = S.COMPACT_BATCHES
) -> StreamingQuery:
    """Keep a running mean vector and count per speaker; a micro-batch writes those it changed.

    The mean is one mergeable state per speaker, in the stream's checkpoint. Micro-batch b is part 2b + 1 of the table.
    Before every ``compact_every``-th one, all that is stored is folded into part 2b, so the table holds no more than one
    row per speaker and what a few batches changed.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch_id and batch_id % compact_every == 0:
            compact_means(batch.sparkSession, out, speaker, 2 * batch_id)
        _write_part(batch, 2 * batch_id + 1, out)

    return (
        P.vector_means(rows, speaker, vector)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _write_part(rows: DataFrame, part: int, out: str) -> None:
    """Replace one part of a table; it appears whole or not at all."""
    rows.withColumn("part", F.lit(part).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("part").parquet(out)


def newest_means(stored: DataFrame, speaker: str) -> DataFrame:
    newest = F.max_by(F.struct("mean", "n"), "part").alias("newest")
    return stored.groupBy(speaker).agg(newest).select(speaker, "newest.mean", "newest.n")


def compact_means(spark: SparkSession, out: str, speaker: str, part: int) -> None:
    """Fold all earlier parts into ``part`` and delete them.

    The new part is newer than what it holds, so until the others are gone they do no harm; a run that was lost in
    between is taken up where it ended.
    """
    parts = [int(name.removeprefix("part=")) for name in folder_names(spark, out) if name.startswith("part=")]
    earlier = [p for p in parts if p < part]
    if earlier and part not in parts:
        _write_part(newest_means(spark.read.parquet(out).where(F.col("part") < part), speaker), part, out)
    for old in earlier:
        discard(spark, f"{out}/part={old}")


def running_presets(spark: SparkSession, out: str, speaker: str) -> DataFrame:
    """Presets from the newest means."""
    return P.presets_from_means(newest_means(spark.read.parquet(out), speaker), speaker)
