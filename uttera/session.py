"""Session settings and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera import settings as S

# AQE sizes the shuffle partitions and splits skewed joins; Arrow batches are bounded in bytes as well as in rows
# because one row may carry a whole audio signal.
CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # Partial mean vectors are held per speaker: more than Spark's 128 groups fit in a task before it sorts instead.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def bound_batches(spark: SparkSession, rows: int = S.ARROW_ROWS, size: int = S.ARROW_BYTES) -> None:
    """Hand Python functions no more than so many rows and bytes at a time, whatever the session allows.

    Rows may carry whole signals, so Spark's ten thousand of them can be gigabytes in every worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def bound_scans(spark: SparkSession, rows: int = S.SCAN_ROWS) -> None:
    """Read no more than so many rows of a Parquet file at once: Spark's 4,096 rows of long arrays fill an executor's heap.

    Nor are the columns of a row group read by vectored reads, which keep a second copy of them outside the heap for each thread.
    """
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(rows))
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")


#: Paths written by ``materialize`` in this process.
STORED: list[str] = []


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("uttera")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session, which has neither in tests, gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="uttera-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write once, read back: later steps may scan it again without repeating the work behind it."""
    path = work_path(df.sparkSession, name)
    STORED.append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that a flow has done with."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []


def discard_stored(spark: SparkSession) -> None:
    """Delete what ``materialize`` stored so far: at the end of a flow whose results are written."""
    while STORED:
        discard(spark, STORED.pop())


def discard_since(spark: SparkSession, mark: int) -> None:
    """Delete what ``materialize`` stored after the first ``mark`` paths, but for the last: a stage's result stays."""
    *done, last = STORED[mark:]
    for path in done:
        discard(spark, path)
    STORED[mark:] = [last]


ROW = "_row"


def with_row_id(df: DataFrame) -> DataFrame:
    """The rows, stored, each with a number of its own in ``ROW``; rows that have one already are left as they are.

    The numbers are given once, when the rows are written, so every later scan sees the same ones. A flow numbers its rows
    at its start and its operators carry the number along.
    """
    return df if ROW in df.columns else materialize(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hand the rows of a small input with fewer files than the session has cores out to all of them, by a unique key.

    A file of one row group is read by one task, whatever its splits. Small is what has few splits for each core; a large
    input is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    small = len(df.inputFiles()) < cores and df.rdd.getNumPartitions() < 4 * cores
    return df.repartition(cores, key) if small else df
