"""Equi-join to a lookup table with one row per key."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttera import settings as S


def stored_bytes(table: DataFrame) -> int:
    """About how many bytes the table's rows take in memory; strings and arrays by their lengths."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        if isinstance(field.dataType, T.ArrayType):
            return F.greatest(F.size(field.name), F.lit(0)) * 8 + 16
        return F.lit(8)

    row = reduce(lambda a, b: a + b, [width(f) for f in table.schema.fields], F.lit(16))
    return table.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def is_small(table: DataFrame, max_bytes: int = S.BROADCAST_BYTES) -> bool:
    """May the table be sent to every executor?"""
    return stored_bytes(table) <= max_bytes


def lookup_join(df: DataFrame, table: DataFrame, key: str, max_broadcast_bytes: int = S.BROADCAST_BYTES) -> DataFrame:
    """Left join ``df`` to ``table`` on ``key``.

    ``table`` is measured and then joined, so hand in one that is stored. Found to be small, it is broadcast. Otherwise
    both sides are shuffled on the key once, and adaptive execution splits the rows of a hot key over several tasks.
    """
    if is_small(table, max_broadcast_bytes):
        return df.join(F.broadcast(table), key, "left")
    return df.join(table.hint("merge"), key, "left")
