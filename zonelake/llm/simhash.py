"""SimHash near-dedup with a bit-sliced comparison.

Fingerprint: A-Z lower-cased, words split at ASCII white space, shingles of ``shingle`` words joined by one
space (fewer words: the whole sequence; none: fingerprint 0), XXH64 with seed 42 per shingle, repeats
included; a bit is set if it is set in over half the hashes.

Links (``radius`` or fewer differing bits) are found exactly and without a cap:

* Of equal fingerprints one row goes on (pre-aggregated), so copies never meet.
* Pigeonhole: the 64 bits are cut into radius + 1 runs; two linked fingerprints agree on one run at least.
  Every fingerprint goes to one bucket per run.  A bucket of more than ``BUCKET`` members is cut again by
  the same rule on the bits it does not yet share, so buckets stay bounded at any input size: after a few
  rounds too few free bits are left for a large bucket.
* Inside a bucket the fingerprints are stored as vertical bit planes, 64 members to a machine word.  The
  planes are compared with a query one by one; carry-save counters add up the differing bits of 64
  members at once, and a block is abandoned as soon as all of its members are over the radius.
* A bucket emits a spanning star of each group it finds (fewer rows than members), never all pairs; the
  groups are joined by distributed connected components.

Defined results: a null text has no words; rows with a null id take part and get their group's component;
the component is the smallest non-null id reachable (null if the group has none); repeated rows are all
returned; an empty table gives an empty result; further input columns are ignored by ``simhash_groups``
and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm.common import bound_batches, fresh, load, stored
from zonelake.llm.components import components

SHINGLE, RADIUS = 3, 3
BUCKET = 8192            # members a bucket may have before it is cut by further bits
LEAST_FREE_BITS = 13     # a bucket with this many free bits has 8192 members at most
HASHES_AT_ONCE = 1 << 16
LANES = 64
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# --- fingerprints ------------------------------------------------------------------------

def fingerprint(text: str | bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text."""
    if not text:
        return 0
    words = (text.encode() if isinstance(text, str) else text).lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    stops = (ends - 1)[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    count, total = np.zeros(64, np.int64), len(stops)
    for i in range(0, total, HASHES_AT_ONCE):
        part = [digest(line[a:b], 42) for a, b in zip(starts[i:min(i + HASHES_AT_ONCE, total)], stops[i:i + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, out_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``out_col``."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).astype(np.int64))

    return docs.withColumn(out_col, prints(F.col(text_col).cast("string")))


def hex_of(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


# --- buckets -----------------------------------------------------------------------------

def _runs(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` cut into ``parts`` runs of nearly equal length."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _children(path: int, shared: list[int], parts: int) -> list[tuple[int, int, int, list[int]]]:
    """(parent path, child path, mask of the shared bits, shared bits) of each run of the free bits."""
    free = [b for b in range(64) if b not in set(shared)]
    out = []
    for i, run in enumerate(_runs(free, parts)):
        bits = shared + run
        out.append((path, path * parts + i + 1, _signed(sum(1 << b for b in bits)), bits))
    return out


def buckets(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Rows (path, key, fp): each fingerprint in every bucket it belongs to; linked ones share a bucket."""
    spark = prints.sparkSession
    level = _children(0, [], radius + 1)
    cur = prints.select(F.explode(F.array(*[
        F.struct(F.lit(p).alias("path"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"), "fp")
        for _, p, m, _ in level])).alias("r")).select("r.*")
    leaves = None
    while True:
        sizes = cur.groupBy("path", "key").count()
        hot = stored(sizes.where(F.col("count") > bucket).select("path", "key"), "simhash-hot")
        if hot.isEmpty() or 64 - len(level[0][3]) < LEAST_FREE_BITS:
            return cur if leaves is None else leaves.union(cur)
        cold = cur.join(hot, ["path", "key"], "left_anti")
        leaves = cold if leaves is None else leaves.union(cold)
        level = [c for _, p, _, bits in level for c in _children(p, bits, radius + 1)]
        masks = spark.createDataFrame([(p, c, m) for p, c, m, _ in level], "path int, child int, mask long")
        cur = stored(cur.join(hot, ["path", "key"], "left_semi").join(F.broadcast(masks), "path")
                     .select(F.col("child").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"),
                     "simhash-cut")


# --- bit-sliced comparison ---------------------------------------------------------------

def planes_of(prints: np.ndarray, block: np.ndarray, lane: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Vertical planes (block, bit) and the mask of used lanes of each block."""
    bits = np.zeros((n_blocks, LANES, 64), np.uint8)
    bits[block, lane] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    used = np.zeros((n_blocks, LANES), np.uint8)
    used[block, lane] = 1
    planes = np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]
    return planes, np.packbits(used, axis=1, bitorder="little").view("<u8")[:, 0]


def close_lanes(query: np.ndarray, block: np.ndarray, planes: np.ndarray, used: np.ndarray, radius: int) -> np.ndarray:
    """For each pair (query fingerprint, block): a word with the bit of every lane within ``radius`` bits."""
    out = np.zeros(len(query), np.uint64)
    at, width = np.arange(len(query)), max(1, int(radius).bit_length())
    start = (1 << width) - 1 - radius  # the counters overflow exactly at radius + 1
    counters = [np.full(len(query), FULL if start >> i & 1 else 0, np.uint64) for i in range(width)]
    over = ~used[block]
    for bit in range(64):
        carry = planes[block, bit] ^ (np.uint64(0) - (query >> np.uint64(bit) & np.uint64(1)))
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over = over | carry
        if bit % 8 == 7:
            alive = over != FULL
            if not alive.all():  # blocks whose lanes are all over the radius are abandoned
                at, query, block, over = at[alive], query[alive], block[alive], over[alive]
                counters = [c[alive] for c in counters]
                if not len(at):
                    return out
    out[at] = ~over
    return out


def _join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs (a, b) in ``label``, in place; each group's label is its least member."""
    while len(a):
        ra, rb = label[a], label[b]
        differ = ra != rb
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
        while (label[label] != label).any():
            label[:] = label[label]


def bucket_groups(prints: np.ndarray, bucket: np.ndarray, radius: int, pairs_at_once: int = 1 << 14) -> np.ndarray:
    """Index of the first member of each fingerprint's group; ``bucket`` is non-decreasing."""
    n = len(prints)
    label = np.arange(n)
    first = np.searchsorted(bucket, bucket, "left")
    size = np.searchsorted(bucket, bucket, "right") - first
    rows = np.flatnonzero(size > 1)
    if not len(rows):
        return label
    rank = rows - first[rows]
    new_block = rank % LANES == 0
    block, lane = np.cumsum(new_block) - 1, rank % LANES
    planes, used = planes_of(prints[rows], block, lane, int(new_block.sum()))
    head = rows[new_block]                       # row of each block's first lane
    last = block[np.searchsorted(rows, (first + size - 1)[rows])]  # last block of the query's bucket
    for i in range(0, len(rows), max(1, pairs_at_once // (1 + int((last - block).max())))):
        part = slice(i, i + max(1, pairs_at_once // (1 + int((last - block).max()))))
        reach = last[part] - block[part] + 1     # own and later blocks: each pair of members once
        query = np.repeat(rows[part], reach)
        target = np.repeat(block[part], reach) + np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        words = close_lanes(prints[query], target, planes, used, radius)
        hit = np.flatnonzero(words)
        lanes = np.unpackbits(words[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pair, at = np.nonzero(lanes)
        _join_labels(label, query[hit][pair], head[target[hit][pair]] + at)
    return label


def bucket_stars(sorted_rows, radius: int, rows_at_once: int = 4096):
    """mapInArrow body: whole buckets of a sorted stream in, star edges (a, b) out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(path, key, fp):
        change = np.concatenate([[True], (path[1:] != path[:-1]) | (key[1:] != key[:-1])])
        label = bucket_groups(fp.view(np.uint64), np.cumsum(change), radius)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return pa.record_batch([pa.array(fp[moved]), pa.array(fp[label[moved]])], schema=schema)

    held: list = []
    for batch in sorted_rows:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("path", "key", "fp")])
        if sum(len(h[0]) for h in held) < rows_at_once:
            continue
        path, key, fp = (np.concatenate(x) for x in zip(*held))
        ends = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1]))
        if not len(ends):
            held = [[path, key, fp]]
            continue
        cut = ends[-1] + 1  # the last bucket may go on in the next batch
        yield edges(path[:cut], key[:cut], fp[:cut])
        held = [[path[cut:], key[cut:], fp[cut:]]]
    if held and len(held[0][0]):
        yield edges(*(np.concatenate(x) for x in zip(*held)))


def linked_prints(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Star edges (a, b) whose connected components are the groups linked within ``radius`` bits."""
    members = buckets(prints, radius, bucket)
    dealt = members.repartition("path", "key").sortWithinPartitions("path", "key", "fp")
    return dealt.mapInArrow(lambda it: bucket_stars(it, radius), "a long, b long")


# --- operator ----------------------------------------------------------------------------

def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, row_no (its number here)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(with_fingerprints(rows, "text", "fp", shingle)
                  .select("doc_id", "fp", F.monotonically_increasing_id().alias("row_no")), "simhash-prints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(linked_prints(prints.select("fp"), radius, bucket))
    named = prints.join(groups, prints.fp == groups.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = stored(named, "simhash-named")
    ids = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", hex_of("fp").alias("fingerprint"), "component_id", "row_no")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id (nulls last), all columns unchanged."""
    (row,) = fresh(docs, "row")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-docs")
    groups = simhash_groups(kept, row, text_col, shingle, radius)
    # component_id is the smallest row number of the group; the row with the smallest id stands for it
    order = kept.select(F.col(row).alias("doc_id"), F.col(id_col).alias("own_id"))
    best = groups.join(order, "doc_id").groupBy("component_id").agg(
        F.min(F.struct(F.col("own_id").isNull(), "own_id", "doc_id")).alias("best"))
    return kept.join(best.select(F.col("best.doc_id").alias(row)), row, "left_semi").drop(row)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of the whole ``documents`` table."""
    return simhash_groups(load(spark, sf_dir, "documents")).drop("row_no")
