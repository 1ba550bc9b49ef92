"""The raw corpus."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera import settings as S
from uttera.operators.ranking import with_source_index
from uttera.schemas import RAW_UTTERANCE


def reader(spark: SparkSession, path: str, split: str | None, schema: T.StructType, config_column: str) -> DataFrame:
    """All configs of a corpus; ``config`` and ``split`` are partition folders, or columns in ``schema``."""
    fields = list(schema.fields)
    for name in (config_column, "split") if split else (config_column,):
        if name not in schema.names:
            fields.append(T.StructField(name, T.StringType()))
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df.where(F.col("split") == split) if split else df


def read_corpus(
    spark: SparkSession,
    path: str,
    configs: list[str] | None = None,
    split: str | None = None,
    schema: T.StructType = RAW_UTTERANCE,
    config_column: str = "config",
    indexed: bool = False,
) -> DataFrame:
    """The named configs of a corpus, or all of it, in one scan.

    ``config`` and ``split`` are partition folders of the corpus (or columns in ``schema``), so that other configs are
    not read. ``indexed`` adds ``source_index``, each row's position in its config.
    """
    df = reader(spark, path, split, schema, config_column)
    if configs:
        df = df.where(F.col(config_column).isin(*configs))
    return with_source_index(df, by=config_column) if indexed else df


def stream_corpus(
    spark: SparkSession, path: str, schema: T.StructType = RAW_UTTERANCE, files_per_batch: int | None = S.FILES_PER_BATCH
) -> DataFrame:
    """The corpus as a stream of its files, so many at a time: ``path`` is a folder or a glob."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
