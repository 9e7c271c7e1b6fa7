"""Conversation prefix trie by range minima over sorted longest common prefixes.

What training on conversations with shared beginnings can save: the trie of all first turns.

1. Turns become (128-bit digest of role and text, bytes of the text); a conversation is the row of its
   digests in turn order, written one after the other as a sortable string.
2. The conversations are range-partitioned and sorted by (string, conv_id): the members of every prefix are
   a run, in it those that end there come first, by conv_id.
3. A task holds its partition (``PARTITION_ROWS`` conversations or ``PARTITION_TURNS`` turns on average): the
   common prefix of each row with the row before it, and a sparse table of their minima.  Every candidate prefix
   (row, depth) finds its left and right extent by its own binary search, a step of halving length per level
   of the table.  Members, children, leaves and saved bytes are counts and prefix sums over the interval.
4. A prefix of a partition's first or last row may go on in the next partition.  Such pieces carry sums that
   add up; the edge rows (two of each partition) give what only neighbours know.

Subtree sums need no walk: with C(i, d) the bytes of the first d turns of row i, a row that shares its first
l turns with the row before it adds C(i, l) - C(i, d - 1) to the saving of a prefix of depth d.

Defined results: a null role or text counts as empty; a null turn sorts first; turns with the same number are
ordered by their digest, so repeated rows are turns of their own; rows with a null conv_id belong to no
conversation; an empty table gives an empty result; further columns are not read.  The digests of one
conversation (32 characters a turn) are one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bound_batches, load, stored

PARTITION_ROWS, PARTITION_TURNS = 32768, 262144
DIGEST = 32                # characters of a turn's digest
GROUP, HEADS = 5, 9        # of the query: conversations that share a beginning, and lengths of it
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

NODE = pa.schema([("node", pa.string()), ("parent", pa.string()), ("open", pa.bool_()), ("conv_id", pa.int64()),
                  ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                  ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("before", pa.int64()), ("ends", pa.string()),
                  ("first_end", pa.int64()), ("ends_sha256", pa.string()), ("edge", pa.string()), ("edge_bytes", pa.list_(pa.int64()))])
NODE_DDL = ("node string, parent string, open boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, before long, ends string, first_end long, ends_sha256 string, edge string, "
            "edge_bytes array<long>")


# --- conversations ------------------------------------------------------------------------

def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of (digest, bytes) in order) of (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256), 1, DIGEST)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"), digest.alias("digest"),
                 F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")) \
        .select("conv_id", F.transform("t", lambda t: F.struct(t.digest.alias("digest"), t.bytes.alias("bytes"))).alias("turns"))


def share_beginnings(convs: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Every conversation c rebuilt: the first crc32(c) % ``heads`` turns of c - c % ``group``, then its own after as many."""
    base = F.col("conv_id") - F.col("conv_id") % group
    first = convs.where(F.col("conv_id") % group == 0) \
        .select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, heads - 1)).alias("head"))
    joined = convs.withColumn("base", base).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")) \
        .join(first, "base", "left")
    none = F.slice("turns", 1, 0)
    head = F.when(F.col("h") == 0, none).otherwise(F.coalesce(F.slice("head", F.lit(1), F.greatest(F.col("h"), F.lit(1))), none))
    return joined.select("conv_id", F.concat(head, F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))


# --- sparse tables ------------------------------------------------------------------------

class RangeMin:
    """Minima of all runs of 1, 2, 4, ... values."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            low, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def right_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First place from ``at`` on whose value is under ``least`` (the length if there is none)."""
        pos = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = pos < len(level)
            fits[fits] = level[pos[fits]] >= least[fits]
            pos[fits] += 1 << k
        return pos

    def left_extent(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last place up to ``at`` whose value is under ``least`` (-1 if there is none)."""
        pos = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = pos - (1 << k) + 1
            fits = start >= 0
            fits[fits] = self.levels[k][start[fits]] >= least[fits]
            pos[fits] -= 1 << k
        return pos

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minimum of values[left:right] (not empty): two runs that cover it."""
        k = np.frexp((right - left).astype(np.float64))[1] - 1
        out = np.empty(len(left), self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            run = self.levels[level]
            out[at] = np.minimum(run[left[at]], run[right[at] - (1 << int(level))])
        return out


def common_turns(a: str, b: str) -> int:
    """Length of the common prefix of two rows of digests, in turns."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    low, high = 0, n // DIGEST - 1
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid * DIGEST] == b[:mid * DIGEST] else (low, mid - 1)
    return low


def node_of(row: str, depth: int) -> str:
    """Identity of a prefix."""
    return hashlib.sha256(row[:depth * DIGEST].encode()).hexdigest()


def partition_nodes(conv: np.ndarray, rows: list[str], turn_bytes: list):
    """Record batches of the nodes of one sorted partition (``NODE``).

    The prefixes of its first and last row are ``open`` pieces: n_convs, n_children, n_leaves and saved_tokens
    are sums to be added up (saved_tokens still without the share of ``before`` = C(d - 1)), ``ends`` are the
    decimal ids of this piece.  Two ``edge`` rows carry the first and last row.
    """
    n = len(rows)
    length = np.fromiter((len(r) // DIGEST for r in rows), np.int64, n)
    total = np.cumsum(np.concatenate([[0], *turn_bytes]).astype(np.int64))
    first = np.cumsum(length) - length            # C(i, d) = total[first[i] + d] - total[first[i]]
    lcp = np.array([-1, *(common_turns(a, b) for a, b in zip(rows, rows[1:]))], np.int64)
    table, least_conv = RangeMin(lcp), RangeMin(conv)

    new = np.maximum(length - lcp, 0)             # new prefixes of each row: depths lcp + 1 .. length
    row = np.repeat(np.arange(n), new)
    depth = lcp[row] + 1 + np.arange(len(row)) - np.repeat(np.cumsum(new) - new, new)
    left = np.maximum(table.left_extent(row, depth), 0)
    right = table.right_extent(row + 1, depth)
    is_open = (left == 0) | (right == n)

    cut = lambda i, d: total[first[i] + d] - total[first[i]]
    own = np.where(lcp > 0, cut(np.arange(n), np.maximum(lcp, 0)), 0)
    saved = np.concatenate([[0], np.cumsum(own)])
    leaf = np.concatenate([lcp[1:] < length[:-1], [False]])       # the last row's is known at the edge
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    longer = np.flatnonzero((lcp >= 0) & (length > lcp))          # rows that begin a child of depth lcp
    by_depth = longer[np.lexsort((longer, lcp[longer]))]
    keys = lcp[by_depth] * (n + 1) + by_depth
    inner = np.searchsorted(keys, depth * (n + 1) + right) - np.searchsorted(keys, depth * (n + 1) + left + 1)
    opens_child = (length[left] > depth) & (left > 0)             # row 0: known at the edge
    before = np.where(depth > 0, cut(row, np.maximum(depth - 1, 0)), 0)
    n_convs = right - left
    gain = saved[right] - saved[left + 1]
    gain = np.where(is_open, gain, gain - (n_convs - 1) * before)
    other = np.concatenate([(lcp[1:] != length[1:]) | (length[1:] != length[:-1]), [True]])
    last_equal = np.flatnonzero(other)                            # last rows of runs of equal sequences
    stop = last_equal[np.searchsorted(last_equal, np.arange(n))] + 1
    convs = least_conv.of(left, right)

    # a prefix's parent begins at the same row or further left: its extent is found in the same way
    up = np.maximum(depth - 1, 0)
    parent_left, parent_right = np.maximum(table.left_extent(row, up), 0), table.right_extent(row + 1, up)
    parent_open = (parent_left == 0) | (parent_right == n)
    parent_conv = least_conv.of(parent_left, parent_right)

    at_end = length[left] == depth
    for i in range(0, len(row), 8192):
        part = range(i, min(i + 8192, len(row)))
        out = {c: [] for c in NODE.names}
        for j in part:
            r, d, o = int(row[j]), int(depth[j]), bool(is_open[j])
            ids = conv[left[j]:stop[left[j]]].tolist() if at_end[j] else []
            text = ",".join(map(str, ids))
            ask = d > 0 and bool(parent_open[j])
            out["node"].append(node_of(rows[r], d) if o else None)
            out["parent"].append(node_of(rows[r], d - 1) if ask else None)
            out["open"].append(o)
            out["parent_conv_id"].append(None if d == 0 or ask else int(parent_conv[j]))
            out["ends"].append(text if o and ids else None)
            out["first_end"].append(ids[0] if o and ids else None)
            out["ends_sha256"].append(None if o else hashlib.sha256(text.encode()).hexdigest() if ids else EMPTY_SHA)
            out["edge"].append(None)
            out["edge_bytes"].append(None)
        s = slice(i, i + len(part))
        out |= {"conv_id": convs[s], "depth": depth[s], "n_convs": n_convs[s], "n_children": (inner + opens_child)[s],
                "n_leaves": (leaves[right] - leaves[left])[s], "saved_tokens": gain[s], "before": before[s]}
        yield pa.record_batch([pa.array(out[c], t) for c, t in zip(NODE.names, NODE.types)], schema=NODE)
    edges = {c: [None, None] for c in NODE.names}
    edges |= {"open": [False, True], "edge": [rows[0], rows[-1]],
              "edge_bytes": [np.asarray(turn_bytes[0]).tolist(), np.asarray(turn_bytes[-1]).tolist()]}
    yield pa.record_batch([pa.array(edges[c], t) for c, t in zip(NODE.names, NODE.types)], schema=NODE)


def _pieces(batches):
    conv, rows, sizes = [], [], []
    for b in batches:
        conv.append(b.column("conv_id").to_numpy(zero_copy_only=False))
        rows += b.column("seq").to_pylist()
        sizes += [np.asarray(x, np.int64) for x in b.column("bytes").to_pylist()]
    if rows:
        yield from partition_nodes(np.concatenate(conv), rows, sizes)


# --- edges of partitions ------------------------------------------------------------------

def edge_rows(edges: DataFrame) -> DataFrame:
    """What the pieces lack, as rows to be added: (node, n_children, n_leaves, saved_tokens).

    ``edges`` (pid, last, edge, edge_bytes) has two rows a partition.  With l the common prefix of a
    partition's first row f and the row p before it: f adds C(f, l) to the prefixes of depth <= l, begins a child of the one of
    depth l, and is the first member of the deeper ones; p is a leaf if l is under its length.
    """
    schema = pa.schema([("node", pa.string()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])

    def known(batches):
        for b in batches:
            out = []
            for last, row, row_bytes, near in zip(*(b.column(c).to_pylist() for c in ("last", "edge", "edge_bytes", "near"))):
                shared = -1 if near is None else common_turns(row, near)
                if last:      # near: the row after it
                    if shared < len(row) // DIGEST:
                        out += [(node_of(row, d), 0, 1, 0) for d in range(len(row) // DIGEST + 1)]
                    continue
                total = np.concatenate([[0], np.cumsum(row_bytes)]).astype(np.int64).tolist()
                for d in range(len(row) // DIGEST + 1):
                    child = len(row) // DIGEST > d and d >= shared
                    out.append((node_of(row, d), int(child), 0, total[shared] if 0 <= d <= shared else 0))
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    order = Window.orderBy("pid", "last")      # two rows a partition
    near = F.when(F.col("last"), F.lead("edge").over(order)).otherwise(F.lag("edge").over(order))
    return edges.withColumn("near", near).select("last", "edge", "edge_bytes", "near") \
        .mapInArrow(known, "node string, n_children long, n_leaves long, saved_tokens long")


def ends_digests(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) of pieces (node, first_end, ends): the ids run through one digest, piece after piece."""
    schema = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])

    def run(batches):
        now, digest = None, None
        for b in batches:
            done = []
            for node, ends in zip(b.column("node").to_pylist(), b.column("ends").to_pylist()):
                if node != now:
                    if now is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = node, hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            if done:
                yield pa.record_batch([pa.array(c, pa.string()) for c in zip(*done)], schema=schema)
        if now is not None:
            yield pa.record_batch([pa.array([now]), pa.array([digest.hexdigest()])], schema=schema)

    return pieces.repartition("node").sortWithinPartitions("node", "first_end").select("node", "ends") \
        .mapInArrow(run, "node string, ends_sha256 string")


# --- operator -----------------------------------------------------------------------------

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(convs: DataFrame, partition_rows: int = PARTITION_ROWS, partition_turns: int = PARTITION_TURNS) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, turns: array of (digest, bytes))."""
    spark = convs.sparkSession
    bound_batches(spark)
    rows = stored(convs.select("conv_id", F.array_join("turns.digest", "").alias("seq"), F.col("turns.bytes").alias("bytes")), "trie-convs")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("bytes")), F.lit(0)).alias("turns")).first()
    parts = max(1, -(-size.n // partition_rows), -(-size.turns // partition_turns))
    dealt = rows.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    nodes = stored(dealt.mapInArrow(_pieces, NODE_DDL).withColumn("pid", F.spark_partition_id()), "trie-nodes")

    edges = nodes.where("edge is not null").select("pid", F.col("open").alias("last"), "edge", "edge_bytes")
    parts_of = nodes.where("node is not null")
    sums = parts_of.select("node", "conv_id", "depth", "parent", "before", "n_convs", "n_children", "n_leaves", "saved_tokens") \
        .unionByName(edge_rows(edges), allowMissingColumns=True).groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
            F.max("before").alias("before"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    open_nodes = stored(sums.withColumn("saved_tokens", F.col("saved_tokens") - (F.col("n_convs") - 1) * F.col("before"))
                        .join(ends_digests(parts_of.where("ends is not null")), "node", "left")
                        .fillna(EMPTY_SHA, ["ends_sha256"]), "trie-open")
    above = open_nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    closed = nodes.where("node is null and edge is null")
    both = open_nodes.withColumn("parent_conv_id", F.lit(None).cast("long")).select("parent", *RESULT) \
        .unionByName(closed.select("parent", *RESULT))
    asking = both.where("parent is not null").join(above, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return asking.select(RESULT).unionByName(both.where("parent is null").select(RESULT))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of the whole ``conversations`` table, rebuilt with shared beginnings."""
    return prefix_trie(share_beginnings(sequences(load(spark, sf_dir, "conversations"))))


OP12_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         substr(sha256(concat_ws(':', strlen(coalesce(role, '')), coalesce(role, ''), coalesce(text, ''))), 1, 32) AS dg
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'dg': dg, 'b': strlen(text)} ORDER BY turn NULLS FIRST, dg) AS turns FROM t GROUP BY conv_id
), crc AS (
  SELECT conv_id, turns, conv_id::VARCHAR AS s FROM c
), step AS (
  SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(s) + 1), lambda i: ord(substr(s, i, 1))::BIGINT)),
    lambda acc, x: list_reduce(list_prepend(xor(acc, x), list_transform(range(8), lambda j: 0::BIGINT)),
      lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) AS acc
  FROM crc
), h AS (SELECT conv_id, xor(acc, 4294967295) % 9 AS h FROM step),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:h.h], []), coalesce(c.turns[h.h + 1:], [])) AS turns
  FROM c JOIN h USING (conv_id) LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 5
), p AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r
), q AS (
  SELECT conv_id, n, depth, list_transform(turns[1:depth], lambda x: x.dg) AS pre,
         CASE WHEN depth > 0 THEN list_transform(turns[1:depth - 1], lambda x: x.dg) END AS up,
         CASE WHEN depth > 0 THEN turns[depth].b ELSE 0 END AS b
  FROM p
), node AS (
  SELECT depth, pre, any_value(up) AS up, any_value(b) AS b, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM q GROUP BY depth, pre
), child AS (SELECT up AS pre, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY up),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child ON node.pre = child.pre
), sub AS (
  SELECT list_slice(pre, 1, k) AS pre, sum((n_convs - 1) * b) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM full_node) GROUP BY 1
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sub s ON s.pre = f.pre LEFT JOIN node u ON u.pre = f.up
"""
