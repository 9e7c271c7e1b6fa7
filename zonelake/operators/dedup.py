"""Full-row and keyed deduplication.

``dropDuplicates(keys)`` keeps an arbitrary row.  Keep-first here is an aggregate:
``min`` over a struct that leads with the order columns, so the surviving row is
fixed by data, not by task scheduling, and hot keys are collapsed by the map-side
partial aggregation before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_full(df: DataFrame) -> DataFrame:
    """Remove exact duplicate rows (nulls compare equal)."""
    return df.dropDuplicates()


def dedup_keep_first(df: DataFrame, keys: Sequence[str],
                     order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row that sorts first by ``order_by`` (then by the remaining columns).

    Without ``order_by`` the remaining columns themselves, in schema order, define "first".
    Column order of the input is preserved.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    order = list(order_by or [])
    if len(rest) == 1 and set(order) <= {*keys, *rest}:
        # the row that sorts first holds the least value (null before all): plain minima are aggregated by hash, structs by sort
        value = F.col(f"`{rest[0]}`")
        least = F.when(F.bool_or(value.isNull()), F.lit(None)).otherwise(F.min(value)).alias(rest[0])
        return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(least).select(*[F.col(f"`{c}`") for c in df.columns])
    ordering = [F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)]
    packed = F.struct(*ordering, F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"))
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    out = first.select(*keys, "_first._row.*")
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
