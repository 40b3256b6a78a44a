"""Exact aggregation of money measures.

Doubles summed in task order give results that differ in the last bits from run to run
and engine to engine. Money is summed as ``decimal(38,10)`` instead (ten places is far
below a cent) and cast back to double once, so totals are reproducible bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,10)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact(x) -> Column:
    """A double measure as an exact ten-place decimal."""
    return _c(x).cast(EXACT)


def xsum(x) -> Column:
    """Exact sum, still a decimal (for further exact arithmetic)."""
    return F.sum(exact(x))


def dsum(x) -> Column:
    """Exact sum, as a double."""
    return F.sum(exact(x)).cast("double")


def davg(x) -> Column:
    """Mean over non-null values from the exact sum (null when there are none)."""
    return F.try_divide(dsum(x), F.count(_c(x)).cast("double"))
