"""Incremental load from a stream: each micro-batch is an idempotent insert-if-absent.

The reference loads batches; the same operator serves a Structured Streaming query
through ``foreachBatch``, so a replayed micro-batch (after a failure) adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from zonelake.operators.warehouse import append_new_rows


def idempotent_sink(table_path: str, keys: Sequence[str],
                    order_by: Sequence[str] | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending only rows whose key is not yet in the table."""
    def _sink(batch: DataFrame, _epoch_id: int) -> None:
        append_new_rows(table_path, batch, keys, order_by)
    return _sink
