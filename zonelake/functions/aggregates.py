"""Small aggregate expressions; exact sums of doubles are in ``functions.totals``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelake.functions.scalar import ColumnOrName, _col


def rounded_mean(c: ColumnOrName, digits: int = 1) -> Column:
    """``ROUND(AVG(c), digits)`` half away from zero, done in decimal arithmetic."""
    return F.round(F.avg(_col(c)).cast("decimal(38,10)"), digits).cast("double")


def sum_or_zero(c: ColumnOrName) -> Column:
    """Sum where an all-null group gives 0 (pandas semantics) instead of null."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))
