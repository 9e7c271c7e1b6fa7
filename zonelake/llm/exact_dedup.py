"""Exact dedup by a heavy-hitter split (DataFrame functions only).

1. Every text becomes its SHA-256; the narrow rows (id, digest, row number) are stored once.
2. A frequent-items sketch (``approx_top_k``, a Misra-Gries summary merged from map-side partial
   summaries) proposes at most ``heavy_items`` frequent digests.
3. The candidates are verified with an exact count in one map-side pre-aggregated pass; those that hold
   at least ``1 / heavy_items`` of the rows are the heavy winners: at most ``heavy_items`` rows, so the
   broadcast has a proven bound.  Their rows are decided map-side, without a shuffle.
4. The remaining digests, each under that share, are grouped and joined by an ordinary shuffle.

Defined results: a null text counts as the empty text; of equal texts the row with the largest id stays
(a null id is smaller than any id); rows that also share the id are told apart by their stored row
number, so exactly one row of a group stays; an empty table gives an empty result; further columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm.common import load, stored, text_or_empty

HEAVY_ITEMS = 1024
TRACKED_ITEMS = 16384


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows (doc_id, digest, row_no): the only thing the later passes read."""
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_or_empty(text_col), 256).alias("digest"),
                              F.monotonically_increasing_id().alias("row_no")), "exact-digests")


def _winner() -> tuple:
    return (F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row_no")).alias("winner"))


def heavy_winners(rows: DataFrame, heavy_items: int = HEAVY_ITEMS, tracked: int = TRACKED_ITEMS) -> DataFrame:
    """Verified frequent digests with their exact size and winning row: ``heavy_items`` rows at most."""
    top = rows.agg(F.expr(f"approx_top_k(digest, {heavy_items}, {tracked})").alias("top"))
    candidates = top.select(F.explode("top.item").alias("digest"))
    least = rows.count() / heavy_items
    exact = rows.join(F.broadcast(candidates), "digest").groupBy("digest").agg(*_winner())
    return stored(exact.where((F.col("group_size") > 1) & (F.col("group_size") >= F.lit(least))), "exact-heavy")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digest_rows(docs, id_col, text_col)
    heavy = F.broadcast(heavy_winners(rows, heavy_items))
    light = rows.join(heavy.select("digest"), "digest", "left_anti")
    decided = rows.join(heavy, "digest").unionByName(
        light.join(light.groupBy("digest").agg(*_winner()), "digest"))
    return decided.select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("winner.row_no") == F.col("row_no")).alias("kept"), F.col("digest").alias("text_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of the whole ``documents`` table."""
    return exact_dedup(load(spark, sf_dir, "documents"))


OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
