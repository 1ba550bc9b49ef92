"""Shards of processed rows."""

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera.schemas import PROCESSED
from uttera.session import folder_names, materialize
from uttera.sources.progress import is_absent

LOG = logging.getLogger(__name__)
SHARD_KEYS = ("config", "worker", "shard")
#: Folder of a run of shards.
FOLDER = "shards"
SHARD_FIELDS = [
    T.StructField("config", T.StringType()),
    T.StructField("worker", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
]


def write_shards(df: DataFrame, path: str, keys: tuple[str, ...] = SHARD_KEYS, per_folder: int = 1) -> None:
    """Write shards; one that exists already is replaced, others stay.

    With ``per_folder`` 1 each shard is a folder of its own. With more, so many consecutive shards share a folder and
    tell themselves apart by their last key, a column: at any scale there are as many files as there are bytes to fill
    them. Folders are replaced whole, so what they hold of other shards is read first; that is the one folder per config
    and worker that an earlier run left half full.
    """
    rows, shard = df.drop("shard_name", "first_shard"), keys[-1]
    if per_folder == 1:
        folders = keys
    else:
        folders = (*keys[:-1], FOLDER)
        rows = rows.withColumn(FOLDER, F.floor(F.col(shard) / per_folder).cast("int"))
        # A folder's rows meet in the tasks that write it; AQE divides what is too much for one.
        rows = _with_neighbours(rows, path, keys, folders).hint("rebalance", *folders)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def _with_neighbours(rows: DataFrame, path: str, keys: tuple[str, ...], folders: tuple[str, ...]) -> DataFrame:
    """``rows`` and the stored rows of other shards in the folders that ``rows`` will replace."""
    spark = rows.sparkSession
    if not folder_names(spark, path):
        return rows
    stored = spark.read.schema(rows.schema).parquet(path)
    new = materialize(rows, "shards")
    same = new.select(*folders).distinct()
    others = stored.join(same, list(folders), "left_semi").join(new.select(*keys).distinct(), list(keys), "left_anti")
    # Stored elsewhere before their folder is replaced.
    return new.unionByName(materialize(others.select(new.columns), "neighbours"))


def read_processed(
    spark: SparkSession, paths: str | list[str], schema: T.StructType = PROCESSED, skip_bad: bool = True
) -> DataFrame:
    """All shards under the given folders as one table.

    Folders that are not there and files that cannot be read are passed over, unless ``skip_bad`` is off; it is an error
    if no folder is there. ``skipped_files`` names the files left out.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    fields = [*schema.fields, *[f for f in SHARD_FIELDS if f.name not in schema.names]]
    reader = spark.read.schema(T.StructType(fields))
    if skip_bad:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    parts = []
    for path in listed:
        try:
            parts.append(reader.parquet(path))
        except AnalysisException as failure:
            if not (skip_bad and is_absent(failure)):
                raise
            LOG.warning("no processed data at %s: skipped", path)
    if not parts:
        raise RuntimeError(f"no processed data could be read from {listed}")
    return reduce(DataFrame.unionByName, [part.select([f.name for f in fields]) for part in parts])


def skipped_files(spark: SparkSession, path: str, schema: T.StructType = PROCESSED) -> DataFrame:
    """Files under ``path`` that ``read_processed`` gets no row from: unreadable ones, and empty ones."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    there = listed.load(path).select(F.regexp_replace("path", "^file:/+", "/").alias("path"))
    read = read_processed(spark, path, schema).select(F.col("_metadata.file_path").alias("path")).distinct()
    return there.join(read.select(F.regexp_replace("path", "^file:/+", "/").alias("path")), "path", "left_anti")
