"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.session import apply_core_conf, data_path, scratch_path

# Rows an Arrow batch may hold: bounds a Python worker's memory when texts are long.
ARROW_ROWS = 128

# Bits of the fixed-size bitmaps (4 MB) that thin out rows before an exact join, and of one of their parts.
BITMAP_BITS, PART_BITS = 1 << 25, 32768

# Vectored reads of a local file go through direct buffers as long as the column chunks, and each thread keeps its own.
READ = {"parquet.hadoop.vectored.io.enabled": "false"}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table, read through Spark's own reader."""
    apply_core_conf(spark)
    return spark.read.options(**READ).parquet(data_path(sf_dir, table))


def bound_batches(spark: SparkSession) -> None:
    """Small Arrow batches, so that a batch of very long texts still fits a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once (with the writer's ``options``) into the shared scratch folder and read back: a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.options(**READ).schema(df.schema).parquet(path)


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that no column of ``df`` has, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = f"_zl_{base}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _bit_place(col: str) -> Column:
    return F.col(col).bitwiseAND(F.lit(BITMAP_BITS - 1)) + 1


def bitmap(keys: DataFrame, col: str) -> DataFrame:
    """Bitmap of the low bits of a long column: (part, bits), ``BITMAP_BITS / PART_BITS`` rows of 4 KB at most."""
    place = keys.select(_bit_place(col).alias("p"))
    return place.groupBy(F.bitmap_bucket_number("p").alias("part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def maybe_in(df: DataFrame, col: str, bits: DataFrame, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose bit is set (``keep``), or those whose bit is not set.

    Every row whose key is in the bitmap counts as set; as the bitmap fills up, so do others.  An exact join
    must follow; the broadcast is bounded by the size of the bitmap.
    """
    part, found, at = fresh(df, "part", "bits", "bit")
    named = bits.select(F.col("part").alias(part), F.col("bits").alias(found))
    rows = df.withColumn(part, F.bitmap_bucket_number(_bit_place(col))).withColumn(at, F.bitmap_bit_position(_bit_place(col)))
    byte = F.conv(F.hex(F.expr(f"substring({found}, cast({at} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col(at) % 8)) % 2 == 1, F.lit(False))
    joined = rows.join(F.broadcast(named), part, "inner" if keep else "left")
    return joined.where(is_set if keep else ~is_set).select(df.columns)


def bitmap_bytes(bits: DataFrame) -> np.ndarray:
    """The bitmap as bytes on the driver (``BITMAP_BITS / 8`` of them), to be shipped to Python workers."""
    out = np.zeros((BITMAP_BITS // PART_BITS, PART_BITS // 8), np.uint8)
    for r in bits.collect():
        out[r.part - 1] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.reshape(-1)


def bits_set(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each unsigned key is set."""
    at = keys & np.uint64(BITMAP_BITS - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
