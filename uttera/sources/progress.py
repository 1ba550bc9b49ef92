"""How far each (config, worker) has come."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.schemas import PROGRESS


def is_absent(failure: AnalysisException) -> bool:
    """Was the path not there, as opposed to being unreadable?"""
    return failure.getCondition() == "PATH_NOT_FOUND"


def save_progress(state: DataFrame, path: str, num_workers: int = 1) -> None:
    """Append the state a run ended in. Call it after the shards are written: until then a rerun repeats them."""
    counted = state.withColumn("num_workers", F.lit(num_workers))
    counted.select(*PROGRESS.names).coalesce(1).write.mode("append").parquet(path)


def load_progress(spark: SparkSession, path: str, num_workers: int | None = None) -> DataFrame:
    """The furthest state per (config, worker); no rows before the first run. Both counters only ever grow.

    Rows are dealt to workers by their number, so going on with another number of workers would lose and repeat rows:
    it is refused.
    """
    try:
        saved = spark.read.schema(PROGRESS).parquet(path)
    except AnalysisException as failure:
        if not is_absent(failure):
            raise
        return spark.createDataFrame([], PROGRESS).drop("num_workers")
    if num_workers is not None:
        other = saved.where(F.col("num_workers") != num_workers).select("num_workers").first()
        if other:
            raise ValueError(f"{path} was kept by runs of {other[0]} workers, not {num_workers}")
    return saved.groupBy("config", "worker").agg(
        F.max("completed_shards").alias("completed_shards"),
        F.max("streamed_consumed").alias("streamed_consumed"),
    )
