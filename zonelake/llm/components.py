"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """Map every node of ``edges`` (a, b: bigint) to the least node it reaches: columns (node, root).

    Each round takes minima per node (pre-aggregated map-side) and joins them back to the edges, so a node
    that holds most edges is one row after the partial aggregation and its edges are split by the adaptive
    skew join.  The edge table is stored between rounds; it never grows beyond its first size.  Self loops
    and repeated edges are allowed; an empty table gives an empty result.
    """
    cur = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "cc-edges")
    seen = None
    while (now := _state(cur)) != seen and now[0]:
        seen = now
        both = cur.union(cur.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        cur = stored(small.where("a <> b").distinct(), "cc-edges")
    roots = cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
