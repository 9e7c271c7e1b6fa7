"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.session import stored_table


def hot_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Keys with more rows than an even share per task, and ``_buckets``: the even shares they hold.

    One pass, pre-aggregated map-side: the ``tasks`` largest keys (no more can exceed an even
    share) and, observed on the way, the number of rows.  At most ``tasks`` rows come back, so
    the result is safe to broadcast.
    """
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(total, F.sum("_n").alias("n"))
    largest = counts.orderBy(F.col("_n").desc()).limit(tasks).collect()
    share = max(1.0, (total.get["n"] or 0) / tasks)
    rows = [(*r[:-1], -int(-r["_n"] // share)) for r in largest if r["_n"] > share and None not in r[:-1]]
    schema = T.StructType([*(T.StructField(k, df.schema[k].dataType) for k in keys), T.StructField("_buckets", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
                tasks: int | None = None) -> DataFrame:
    """``big`` joined with ``small`` on ``keys`` (``inner`` or ``left``), hot keys spread over several tasks.

    Without a hot key this is a plain join.  Else ``big`` is stored first, so that a row keeps its position when a task runs
    again, and rows with a hot key are dealt by position to as many buckets as the key
    holds even shares of the rows; the rows of ``small`` for those keys are replicated once per
    bucket, every other key keeps bucket 0 on both sides.  Equal rows are spread like any
    others, and ``small`` grows by one row per bucket only.  Null keys never match.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    keys = list(keys)
    found = hot_keys(big, keys, tasks)
    if found.isEmpty():
        return big.join(small, keys, how)
    hot = F.broadcast(found)
    b = stored_table(big, "salted-side").join(hot, keys, "left")
    salt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("_buckets")), F.lit(0)).cast("int")
    b = b.withColumn("_salt", salt).drop("_buckets")
    s = small.join(hot, keys, "left")
    s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_buckets", F.lit(1)) - 1))).drop("_buckets")
    return b.join(s, keys + ["_salt"], how).drop("_salt")
