"""Name an intermediate value inside one expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A lambda body is evaluated per element, so an outer expression used in it would be recomputed for every
    element; a lambda variable is not.
    """
    return F.transform(F.array(value), body).getItem(0)
