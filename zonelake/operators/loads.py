"""Loads of several tables that become visible together and read only what a batch can meet.

A warehouse folder holds one folder per load, and in it the new rows of every table of that load::

    <root>/zl_load=<id>/zl_table=<table>/zl_period=<yyyymm or yyyy00>/...

* **Atomic.** The files are written below ``<root>/_aside`` first, which no reader lists; one rename of that
  folder publishes all tables of the load.  A load that dies before leaves nothing visible, and a load whose id
  is published already adds nothing.  The rename is one step on HDFS and on a local disk; on an object store
  that copies to rename, put the warehouse on a store that has it.
* **Pruned.** A key holds the day of its row, so a batch can only meet rows of its own periods: the fact's other
  folders are not read.  Of the rows that are, if more than the batch's, only those whose key may be in the batch (a bitmap of the batch's
  key hashes, ``BITMAP_BYTES`` at most, broadcast) reach the shuffle of the anti-join, which stays exact.

Loads with different ids must follow each other; two at a time would not see each other's rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.operators.warehouse import insert_if_absent
from zonelake.session import any_match, publish_folder, stored_table

BITMAP_BYTES, PART_BITS = 4 << 20, 32768
BITS_PER_KEY = 16
NO_PERIOD = 0  # of rows without a day


@dataclass(frozen=True)
class Batch:
    """New rows of one table: its key, the day column that is part of the key, which row of equal keys counts, and
    whether its folders hold a month or a year (the same in all loads of a table)."""
    rows: DataFrame
    keys: Sequence[str]
    day_col: str
    order_by: Sequence[str] | None = None
    monthly: bool = True

    def period(self) -> Column:
        day = F.col(f"`{self.day_col}`")
        return F.coalesce((F.year(day) * 100 + (F.month(day) if self.monthly else F.lit(0))).cast("int"), F.lit(NO_PERIOD))


def read_loaded(spark: SparkSession, root: str, table: str, columns: str) -> DataFrame:
    """The rows of ``table`` in all published loads, with ``zl_load`` and ``zl_period``; ``columns`` is its DDL schema."""
    schema = f"{columns}, zl_load string, zl_table string, zl_period int"
    where = f"{root}/zl_load=*/zl_table={table}"
    found = spark.read.schema(schema).option("basePath", root).parquet(where) if any_match(spark, where) else spark.createDataFrame([], schema)
    return found.drop("zl_table")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def thin_out(existing: DataFrame, batch: DataFrame, keys: Sequence[str], n_keys: int) -> DataFrame:
    """Rows of ``existing`` whose key may be in ``batch``: all that are, and few others."""
    bits = PART_BITS
    while bits < min(n_keys * BITS_PER_KEY, BITMAP_BYTES * 8):
        bits *= 2
    place = F.pmod(_key_hash(keys), F.lit(bits)) + 1
    parts = batch.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_part")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = existing.withColumn("_part", F.bitmap_bucket_number(place)).withColumn("_at", at)
    joined = rows.join(F.broadcast(parts), "_part")
    return joined.where(F.floor(byte / F.pow(F.lit(2), F.col("_at") % 8)) % 2 == 1).select(existing.columns)


def absent_rows(root: str, table: str, batch: Batch) -> DataFrame:
    """The batch's rows whose key no published load holds, with their ``zl_period``."""
    if batch.day_col not in batch.keys:
        raise ValueError(f"the day {batch.day_col!r} must be part of the key {list(batch.keys)}")
    rows = stored_table(batch.rows, f"load-{table}")
    keys = list(batch.keys)
    span = rows.select(batch.period().alias("p")).agg(F.min("p").alias("least"), F.min(F.when(F.col("p") != NO_PERIOD, F.col("p"))).alias("low"),
                                                      F.max("p").alias("high"), F.count(F.lit(1)).alias("n")).first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    met = F.col("zl_period").between(span.low, span.high) if span.low is not None else F.lit(False)
    if span.least == NO_PERIOD:
        met = met | (F.col("zl_period") == NO_PERIOD)
    existing = read_loaded(rows.sparkSession, root, table, columns).where(met).select(rows.columns)
    has_key = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    seen = existing
    if existing.count() > span.n:  # a batch of all that is there would leave nothing out
        seen = thin_out(existing.where(has_key), rows.where(has_key), keys, span.n).unionByName(existing.where(~has_key))
    return insert_if_absent(seen, rows, keys, batch.order_by).withColumn("zl_period", batch.period())


def write_aside(root: str, batches: Mapping[str, Batch]) -> str:
    """Write the absent rows of every batch into a folder of their own that no reader lists; its path."""
    aside = f"{root}/_aside/{uuid.uuid4().hex}"
    for table, batch in batches.items():
        rows = absent_rows(root, table, batch)
        rows.hint("rebalance", "zl_period").write.partitionBy("zl_period").parquet(f"{aside}/zl_table={table}")
    return aside


def load(spark: SparkSession, root: str, load_id: str, batches: Mapping[str, Batch]) -> bool:
    """Load all batches at once; False if a load of that id is published already (nothing is done then)."""
    target = f"{root}/zl_load={load_id}"
    return not any_match(spark, target) and publish_folder(spark, write_aside(root, batches), target)
