"""Sums that do not depend on the order of their terms, so not on partitions, retries or the plan either."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits after the point of the coarse part, and of the fine part behind it.
COARSE, FINE = 20, 28
#: Terms of this size and above, and those that are not finite, are added as they come.
WIDE = float(1 << 22)


def exact_sum(value: Column) -> Column:
    """The sum of a column, as an aggregate: null for none, 48 bits after the point.

    Terms are split without error into two whole numbers, whose sums are exact in any order. A group may hold 2^35 rows
    and magnitudes that add up to 2^43; beyond that the sum is an error, not a wrong number.
    """
    x = value.cast("double")
    wide = F.isnan(x) | (F.abs(x) >= WIDE)
    scaled = F.when(~wide, x).otherwise(F.when(x.isNotNull(), 0.0)) * F.lit(float(1 << COARSE))
    coarse = F.floor(scaled)
    fine = F.rint((scaled - coarse) * F.lit(float(1 << FINE))).cast("bigint")
    total = F.sum(coarse) / F.lit(float(1 << COARSE)) + F.sum(fine) / F.lit(float(1 << (COARSE + FINE)))
    return total + F.coalesce(F.sum(F.when(wide, x)), F.lit(0.0))


def exact_mean(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))
