"""What several of the operators need: tables, words, folds, and Python passes over batches of texts."""

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITESPACE = r"[\x20\x09-\x0D]+"
#: Everything ASCII that is neither a letter nor a digit.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bounds of one Arrow batch: texts cross into Python a few megabytes at a time.
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """The name, with so many underscores behind it that the table has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z only; letters outside ASCII stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, separators: str) -> Column:
    """The non-empty pieces between separators; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def held_out(key: Column) -> Column:
    """One of three folds by the key's CRC-32; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(key: Column) -> Column:
    """A key of the other two folds; a null key may not be learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def over_texts(spark: SparkSession, batch: Callable[[list[bytes | None]], Iterable], schema: str) -> Callable[[Column], Column]:
    """A column function running ``batch`` over lists of whole texts as UTF-8; one row of ``schema`` per text.

    The batches are bounded in rows and bytes. The optimizer may not repeat the call.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    names = [field.split()[0] for field in schema.split(",")]

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = batch([None if t is None else bytes(t) for t in texts])
        return pd.DataFrame(list(rows), columns=names)

    run.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    udf = F.pandas_udf(run, schema).asNondeterministic()
    return lambda text: udf(text.cast("binary"))
