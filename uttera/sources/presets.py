"""Speaker presets as a table."""

from pyspark.sql import DataFrame, SparkSession

from uttera.schemas import PRESETS


def write_presets(presets: DataFrame, path: str) -> None:
    presets.select(*PRESETS.names).write.mode("overwrite").parquet(path)


def read_presets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRESETS).parquet(path)
