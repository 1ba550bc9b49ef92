"""Shards, limits and resuming: positions among the accepted rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.operators.ranking import index_bucket, ranked


def assign_shards(
    df: DataFrame,
    rows_per_shard: int = S.ROWS_PER_SHARD,
    max_shards: int | None = None,
    first_shard: str | None = None,
    index: str = "source_index",
    bucket_rows: int = S.BUCKET_ROWS,
    rows_before: str | None = None,
) -> DataFrame:
    """Consecutive accepted rows of a (config, worker) fill shard 0, 1, ...; adds ``shard`` and ``shard_name``.

    ``first_shard`` names a column with the number of shards already written. ``max_shards`` counts those too.
    ``rows_before`` names one with the number of rows already written, the last shard of which may go on filling.
    """
    start: Column = F.coalesce(F.col(first_shard), F.lit(0)) if first_shard else F.lit(0)
    before: Column = F.coalesce(F.col(rows_before), F.lit(0)) if rows_before else F.lit(0)
    below = (F.lit(max_shards) - start) * rows_per_shard - before if max_shards else None
    placed = ranked(
        df, ["config", "worker"], F.col(index), index_bucket(index, bucket_rows), out="_position", below=below
    )
    shard = (start + F.floor((before + F.col("_position")) / rows_per_shard)).cast("int")
    return placed.withColumn("shard", shard).withColumn("shard_name", shard_name()).drop("_position")


def shard_name() -> Column:
    return F.format_string("%s_w%d_s%d", F.col("config"), F.col("worker"), F.col("shard"))


def max_shards(df: DataFrame, n: int | None) -> DataFrame:
    """Keep shards below ``n`` of each (config, worker)."""
    return df.where(F.col("shard") < n) if n else df


def config_place(config_order: list[str] | None = None) -> Column:
    """Where a config comes in the run: in the order given, or by name."""
    if config_order is None:
        return F.struct(F.col("config"))
    listed = F.array(*[F.lit(c) for c in config_order])
    return F.struct(F.array_position(listed, F.col("config")).alias("at"), F.col("config"))


def limit_accepted(
    df: DataFrame,
    n: int | None,
    config_order: list[str] | None = None,
    index: str = "source_index",
    bucket_rows: int = S.BUCKET_ROWS,
) -> DataFrame:
    """Keep each worker's first ``n`` accepted rows, counted across configs in their order, then by index."""
    if not n:
        return df
    if n < 0:
        raise ValueError("the limit is a positive number of rows")
    place = config_place(config_order)
    bucket = F.struct(place.alias("place"), index_bucket(index, bucket_rows).alias("bucket"))
    order = F.struct(place.alias("place"), F.col(index))
    return ranked(df, ["worker"], order, bucket, out="_position", below=n).drop("_position")


def skip_consumed(df: DataFrame, progress: DataFrame, index: str = "source_index") -> DataFrame:
    """Drop source rows a finished run has consumed and add ``first_shard``, where its numbering goes on.

    ``progress`` has one row per (config, worker); Spark broadcasts it by its size.
    """
    done = progress.select(
        "config", "worker", F.col("completed_shards").alias("first_shard"), F.col("streamed_consumed").alias("_done")
    )
    joined = df.join(done, ["config", "worker"], "left")
    fresh = joined.where(F.col(index) >= F.coalesce(F.col("_done"), F.lit(0)))
    return fresh.withColumn("first_shard", F.coalesce(F.col("first_shard"), F.lit(0))).drop("_done")


def shard_sizes(df: DataFrame) -> DataFrame:
    """Rows per shard: what a dry run reports instead of writing."""
    return df.groupBy("config", "worker", "shard", "shard_name").agg(F.count(F.lit(1)).alias("rows"))


def samples(
    df: DataFrame, n: int = 3, index: str = "source_index", prefix: int = 60, config_order: list[str] | None = None
) -> DataFrame:
    """The first ``n`` accepted rows, in the order of the run, with the start of their text, for a dry run's display."""
    return (
        df.orderBy(config_place(config_order), index)
        .limit(n)
        .select(
            F.col("speakerID").alias("sid"),
            F.length("text").alias("chars"),
            F.col("num_speech_tokens").alias("tokens"),
            F.size("global_embedding").alias("emb_dim"),
            F.substring("text", 1, prefix).alias("text"),
        )
    )


def progress_of(
    sharded: DataFrame,
    rows_per_shard: int = S.ROWS_PER_SHARD,
    source_rows: DataFrame | None = None,
    limit: int | None = None,
    config_order: list[str] | None = None,
    index: str = "source_index",
) -> DataFrame:
    """Shards done and source rows consumed by a run that wrote ``sharded``, per (config, worker).

    A full last shard has consumed up to its last row. A partial one was flushed at the end of the source, so all
    of ``source_rows`` (config, source_rows) are consumed, unless ``limit`` stopped the run at that row.
    """
    per_shard = sharded.groupBy("config", "worker", "shard").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(index).alias("_last")
    )
    state = per_shard.groupBy("config", "worker").agg(
        (F.max("shard") + 1).cast("int").alias("completed_shards"),
        (F.max("_last") + 1).alias("streamed_consumed"),
        F.max_by("_rows", "shard").alias("_last_rows"),
        F.sum("_rows").alias("_rows"),
    )
    if source_rows is not None:
        if limit:
            # The worker's rows add up to the limit only if it stopped, which it did in its last config.
            totals = state.groupBy("worker").agg(
                F.sum("_rows").alias("_total"), F.max_by("config", config_place(config_order)).alias("_last_config")
            )
            state = state.join(totals, "worker").withColumn(
                "_stopped", (F.col("_total") >= limit) & (F.col("config") == F.col("_last_config"))
            )
        else:
            state = state.withColumn("_stopped", F.lit(False))
        state = state.join(source_rows, "config", "left").withColumn(
            "streamed_consumed",
            F.when((F.col("_last_rows") < rows_per_shard) & ~F.col("_stopped"), F.col("source_rows"))
            .otherwise(F.col("streamed_consumed")),
        )
    return state.select("config", "worker", "completed_shards", F.col("streamed_consumed").cast("long"))
