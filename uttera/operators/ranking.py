"""Positions in a global order without sorting a whole group in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uttera import settings as S
from uttera.operators.lookup import lookup_join
from uttera.session import materialize


def ranked(
    df: DataFrame,
    by: list[str],
    order: Column,
    bucket: Column,
    out: str = "rank",
    below: Column | int | None = None,
) -> DataFrame:
    """Zero-based position of each row within ``by`` in the order of ``order``.

    ``bucket`` must never decrease along the order and must hold few rows per value. Rows are sorted only inside
    their (by, bucket) group; a count per bucket, summed over the earlier buckets, gives each group its offset. So
    a group of any size is spread over its buckets, and what one task orders in full is the counts. With ``below``
    only positions under it are kept, and buckets that start past it are dropped before the rows are sorted.

    The input is scanned twice (the counts read the key columns only): hand in a table, not the output of a model.
    """
    # A struct key keeps rows whose group column is null: a join on it would drop them.
    keyed = df.withColumn("_group", F.struct(*[F.col(c) for c in by], bucket.alias("_bucket")))
    counts = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_count"))
    earlier = (
        Window.partitionBy(*[F.col(f"_group.{c}") for c in by])
        .orderBy("_group._bucket")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select("_group", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_offset"))
    placed = keyed.join(offsets, "_group")
    if below is not None:
        placed = placed.where(F.col("_offset") < below)
    local = F.row_number().over(Window.partitionBy("_group").orderBy(order)) - 1
    result = placed.withColumn(out, F.col("_offset") + local).drop("_group", "_offset")
    return result if below is None else result.where(F.col(out) < below)


def index_bucket(index: str | Column, bucket_rows: int = S.BUCKET_ROWS) -> Column:
    """Bucket of a unique integer index: at most ``bucket_rows`` rows each."""
    column = F.col(index) if isinstance(index, str) else index
    return F.floor(column / bucket_rows)


def with_source_index(df: DataFrame, by: str | None = None, out: str = "source_index") -> DataFrame:
    """Number the rows of Parquet files in (file name, row) order, from 0 within each ``by``.

    ``df`` comes straight from the reader. Each row knows its place in its file; a count per file, from a scan that
    reads no column, gives the file's offset. The rows are not shuffled.
    """
    groups = [by] if by else []
    files = df.select(*groups, F.col("_metadata.file_path").alias("_file")).groupBy(*groups, "_file").count()
    earlier = Window.partitionBy(*groups).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("_file", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    return number_rows(df, offsets, F.col("_metadata.file_path"), out=out)


def number_rows(df: DataFrame, offsets: DataFrame, file: Column, out: str = "source_index") -> DataFrame:
    """Add ``out``: a row's number in its file plus the file's offset, by (``_file``, ``_offset``)."""
    # A name's hash is looked up, so a few million files fit into a broadcast table.
    offsets = materialize(offsets.select(F.xxhash64("_file").alias("_file"), "_offset"), "files")
    if offsets.groupBy("_file").count().where("count > 1").limit(1).count():
        raise RuntimeError("two file names share a hash")
    placed = df.select("*", F.xxhash64(file).alias("_file"), F.col("_metadata.row_index").alias("_row"))
    joined = lookup_join(placed, offsets, "_file")
    return joined.withColumn(out, F.col("_offset") + F.col("_row")).drop("_file", "_row", "_offset")
