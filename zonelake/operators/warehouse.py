"""Star-schema load: surrogate keys, dimensions, facts, idempotent incremental loads.

Surrogate keys are dense ranks of the natural key, computed without a global
single-task sort: keys are range-partitioned, sorted within partitions and, in the
same job, tagged with (partition, position) and written as a table; the
per-partition row counts (one row per partition) are prefix-summed and broadcast,
and each row's key is its partition offset plus its position in the partition.
Because the result is built on a written table, later joins see its true size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from zonelake.functions.scalar import round_half_up_int
from zonelake.operators.dedup import dedup_keep_first
from zonelake.session import cut_lineage, read_if_there, scratch_path


def assign_surrogate_keys(df: DataFrame, keys: Sequence[str], sk_col: str, start: int = 0,
                          num_partitions: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Distinct ``keys`` of ``df`` with ``sk_col`` = start + dense rank by ``keys`` (1-based).

    Equals ``start + ROW_NUMBER() OVER (ORDER BY keys)`` over the distinct keys.
    ``carry`` columns ride along; ``df`` must hold one value of them per key.
    """
    keys, carry = list(keys), list(carry)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    distinct = df.select(*keys, *carry).where(not_null).dropDuplicates(keys)
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)
    # one job: range-partition, sort inside each partition, tag every row with (partition, position)
    # and write.  The tags are produced with the data, so the counting pass below reads exactly the
    # partitions that were numbered (a retried task re-reads the same shuffle output).
    path = scratch_path(spark, f"keys-{sk_col}")
    (distinct.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .select(*keys, *carry, pid.alias("_pid"), local.alias("_pos"))
     .write.parquet(path))
    tagged = spark.read.parquet(path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: bounded by the partition count, safe to broadcast.
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    # built on a written table: joins that use these keys see the dimension's real size
    return out.select(*keys, (F.lit(start) + F.col("_off") + F.col("_pos") + 1).cast("long").alias(sk_col), *carry)


def max_key(dim: DataFrame, sk_col: str) -> int:
    """Current maximum surrogate key of a dimension (a one-row aggregate)."""
    v = dim.agg(F.max(sk_col)).first()[0]
    return int(v or 0)


def extend_dimension(existing: DataFrame | None, candidates: DataFrame, keys: Sequence[str], sk_col: str,
                     attrs: DataFrame | None = None) -> DataFrame:
    """New dimension rows for keys not yet present; keys already loaded keep their surrogate.

    New keys get ``max(existing sk) + dense rank``.  ``attrs`` (one row per key)
    supplies the remaining columns.  Returns only the new rows (insert-if-absent).
    """
    keys = list(keys)
    fresh = candidates.select(*keys).dropDuplicates()
    start = 0
    if existing is not None:
        fresh = fresh.join(existing.select(*keys), keys, "left_anti")
        start = max_key(existing, sk_col)
    out = assign_surrogate_keys(fresh, keys, sk_col, start=start)
    if attrs is not None:
        out = out.join(attrs, keys, "left")
    return out


def user_dimension(staging: DataFrame, id_col: str, type_col: str, order_col: str,
                   sk_col: str = "usuario_sk") -> DataFrame:
    """One row per user; a user seen with several types keeps the type of the earliest row."""
    attrs = staging.groupBy(id_col).agg(
        F.min_by(F.col(type_col), F.struct(F.col(order_col), F.col(type_col))).alias(type_col))
    return assign_surrogate_keys(attrs, [id_col], sk_col, carry=[type_col]).select(sk_col, id_col, type_col)


def station_dimension(staging: DataFrame, origin_col: str, dest_col: str, id_col: str = "estacion_id",
                      sk_col: str = "estacion_sk") -> DataFrame:
    """Stations = origins UNION destinations (set union), each with a dense surrogate key."""
    stations = staging.select(F.col(origin_col).alias(id_col)).union(
        staging.select(F.col(dest_col).alias(id_col))).distinct()
    return assign_surrogate_keys(stations, [id_col], sk_col).select(sk_col, id_col)


def trip_fact(staging: DataFrame, users: DataFrame, stations: DataFrame, *, user_col: str,
              origin_col: str, dest_col: str, measures: Mapping[str, str], passthrough: Sequence[str] = (),
              user_sk: str = "usuario_sk", station_id: str = "estacion_id",
              station_sk: str = "estacion_sk") -> DataFrame:
    """Fact rows: natural keys looked up in the dimensions (inner joins; unmatched rows vanish).

    The station dimension plays two roles (origin and destination).  ``measures`` maps
    output column -> staging column; values are rounded half away from zero to int.
    """
    u = users.select(F.col(user_col).alias("_u"), F.col(user_sk))
    o = stations.select(F.col(station_id).alias("_o"), F.col(station_sk).alias("origen_sk"))
    d = stations.select(F.col(station_id).alias("_d"), F.col(station_sk).alias("destino_sk"))
    f = (staging.join(u, staging[user_col] == u["_u"])
         .join(o, staging[origin_col] == o["_o"])
         .join(d, staging[dest_col] == d["_d"]))
    return f.select(user_sk, "origen_sk", "destino_sk",
                    *[round_half_up_int(F.col(src)).alias(out) for out, src in measures.items()],
                    *passthrough)


def insert_if_absent(existing: DataFrame, candidates: DataFrame, keys: Sequence[str],
                     order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``candidates`` whose key is not in ``existing`` (one per key, keep-first).

    ``INSERT ... ON CONFLICT DO NOTHING``: appending the result makes a re-run a no-op.
    A row with a null in its key has no key: it is kept apart and counts as present only if
    the very same row is (all columns compared, nulls equal).
    """
    keys = list(keys)
    keyed = dedup_keep_first(candidates.where(_has_key(keys)), keys, order_by)
    keyed = keyed.join(existing.where(_has_key(keys)).select(*keys).dropDuplicates(), keys, "left_anti")
    loose = candidates.where(~_has_key(keys)).dropDuplicates()
    return keyed.unionByName(_rows_not_in(loose, existing.where(~_has_key(keys))))


def _has_key(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def _rows_not_in(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of which ``existing`` holds no equal one (nulls compare equal)."""
    old = existing.select(*[F.col(f"`{c}`").alias(f"_e{i}") for i, c in enumerate(rows.columns)])
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(old[f"_e{i}"]) for i, c in enumerate(rows.columns)])
    return rows.join(old, same, "left_anti")


def incremental_merge(existing: DataFrame, candidates: DataFrame, keys: Sequence[str],
                      order_by: Sequence[str] | None = None) -> DataFrame:
    """``existing`` plus the new rows of ``candidates`` (the table after an idempotent load)."""
    return existing.unionByName(insert_if_absent(existing, candidates, keys, order_by))


def append_new_rows(table_path: str, candidates: DataFrame, keys: Sequence[str],
                    order_by: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> int:
    """Append to the Parquet table at ``table_path`` only rows whose key is absent.

    The new rows are computed against the current table and written with
    ``mode("append")`` (new files only; the files being read are never overwritten).
    Returns the number of rows appended.
    """
    existing = read_if_there(candidates.sparkSession, table_path)
    if existing is None:
        existing = candidates.limit(0)
    new_rows = cut_lineage(insert_if_absent(existing, candidates, keys, order_by))
    if new_rows.isEmpty():
        return 0
    added = Observation()
    writer = new_rows.observe(added, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(table_path)
    return added.get["n"]


def decimal_columns(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast columns to the warehouse DECIMAL types, e.g. ``{"tarifa": "decimal(4,2)"}``."""
    return df.select(*[F.col(c).cast(spec[c]).alias(c) if c in spec else F.col(c) for c in df.columns])
