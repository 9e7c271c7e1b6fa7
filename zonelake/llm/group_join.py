"""N-gram Jaccard join by grouped prefixes.

Documents whose sets of word shingles overlap by a least share of their union, and the groups they form:

1. Every text becomes its set of 64-bit shingle hashes; documents with equal sets are one class.  The same pass
   counts shingles in 2**20 bins of their hashes, which gives an order of shingles: rare bins first, then by hash.
   Shingles that turn out to be in several prefixes are moved to the end of the order (bits of a fixed-size bitmap).
   The order decides about the work only, never about the result.
2. Two sets of similarity t share one of their first n - ceil(t * n) + 1 shingles.  Classes with identical prefixes and
   size are one group; only a group's prefix is posted, once for all its members.
3. Group pairs from the same posting are filtered by size, by the places of the common shingle and by the shingles their
   prefixes share at most.  Those that are left are expanded to their members, and the whole sets are compared.  Before that the
   sets' sketches are: a bit of a sketch is the parity of the shingles that fall on it, so two sets differ by as many shingles as
   their sketches by bits, at least.  No similar pair is lost by it.
4. Links come in two passes, so that n copies that differ by a word don't cost n * n pairs.  First every group is paired
   with one group per posting and size band, and every member with the first of its group.  Then postings hold classes
   by the component reached; components that meet in a posting are paired, and all their members that meet there are
   compared.  Pairs inside a component need no comparison: a link there changes no component.

Every pair of linked documents is thus in one component, and no other: links are verified on whole sets.

Defined results: a null or empty text has the empty set and is linked with nothing; a text of fewer words than the
shingle's is one shingle; repeated rows are in one component; null ids count for no component's smallest id; an empty
table gives an empty result; further columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.llm.common import bitmap, bound_batches, load, maybe_in, stored
from zonelake.llm.components import components

SHINGLE, NUMERATOR, DENOMINATOR = 5, 4, 5          # similarity 4/5
BINS, BIN_BLOCK, DEALT = 1 << 20, 8192, 64
ROUNDS = 2                                         # of counting prefixes before they are taken
PART_BITS, HELD_BITS, PENDING = 10, 27, 1 << 20    # leading bits of a shingle that name a part, that name its bit; shingles a task packs at once
SKETCH, BRIEF = 1024, 4                            # bits of a sketch, 64-bit words of its short form


# --- sets ---------------------------------------------------------------------------------

def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    width = min(shingle, len(words))
    starts, stops = (ends - sizes)[:len(words) - width + 1].tolist(), (ends - 1)[width - 1:].tolist()
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((digest(line[a:b]) for a, b in zip(starts, stops)), np.uint64, len(starts)))


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, np.ndarray]:
    """Stored sets (row_no, doc_id, n, digest, shingles), and the level of each bin (one byte, higher where more shingles are)."""
    schema = pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("shingles", pa.list_(pa.int64())), ("block", pa.int32()), ("counts", pa.binary())])

    def sets(batches):
        counts = np.zeros(BINS, np.int64)
        for b in batches:
            made = [shingle_set(t, shingle) for t in b.column("text").to_pylist()]
            every = np.concatenate([*made, np.zeros(0, np.uint64)])
            np.add.at(counts, (every >> np.uint64(44)).astype(np.int64), 1)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), pa.array(every.view(np.int64)))
            yield pa.record_batch([b.column("row_no"), b.column("doc_id"), pa.array([len(m) for m in made], pa.int64()),
                                   pa.array([hashlib.sha256(m.tobytes()).digest()[:16] for m in made], pa.binary()), lists,
                                   pa.nulls(len(made), pa.int32()), pa.nulls(len(made), pa.binary())], schema=schema)
        parts = counts.reshape(-1, BIN_BLOCK)
        used = [i for i in range(len(parts)) if parts[i].any()]
        none = [pa.nulls(len(used), t) for t in schema.types[:5]]
        yield pa.record_batch([*none, pa.array(used, pa.int32()), pa.array([_small(parts[i]) for i in used], pa.binary())], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    both = stored(rows.mapInArrow(sets, "row_no long, doc_id long, n long, digest binary, shingles array<long>, block int, counts binary"),
                  "join-sets", **{"parquet.writer.version": "v2"})      # sorted hashes as differences
    return both.where("row_no is not null").drop("block", "counts"), bin_levels(both.where("block is not null").select("block", "counts"))


def _small(counts: np.ndarray) -> bytes:
    """A block's counts in as few bytes each as the largest one needs."""
    return counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _counts(block: bytes) -> np.ndarray:
    return np.frombuffer(block, f"u{len(block) // BIN_BLOCK}").astype(np.int64)


def bin_levels(blocks: DataFrame) -> np.ndarray:
    """A level for each bin: four times the binary logarithm of its count, from the sum of all tasks' counts."""
    schema = pa.schema([("block", pa.int32()), ("counts", pa.binary())])

    def add(batches):
        now, total = None, None
        for b in batches:
            for block, counts in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
                if block != now:
                    if now is not None:
                        yield pa.record_batch([pa.array([now], pa.int32()), pa.array([_small(total)], pa.binary())], schema=schema)
                    now, total = block, np.zeros(BIN_BLOCK, np.int64)
                total += _counts(counts)
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.int32()), pa.array([_small(total)], pa.binary())], schema=schema)

    deal = F.expr(f"pmod(xxhash64(counts), {DEALT})")
    some = blocks.withColumn("deal", deal).repartition("block", "deal").sortWithinPartitions("block").select("block", "counts").mapInArrow(add, "block int, counts binary")
    whole = some.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, counts binary")
    counts = np.zeros((BINS // BIN_BLOCK, BIN_BLOCK), np.int64)
    for r in whole.collect():          # 8 bytes a bin
        counts[r.block] += _counts(bytes(r.counts))
    return (4 * np.log2(1 + counts.reshape(-1))).astype(np.uint8)


def prefix_length(n: int, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> int:
    """How many of a set's first shingles any similar set shares one of."""
    return n - -(-n * numerator // denominator) + 1 if n else 0


def _held(bits: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Whether the bit of each shingle is set."""
    at = shingles >> np.uint64(64 - HELD_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _first_ones(values: np.ndarray, sizes: np.ndarray, levels: np.ndarray, late: np.ndarray | None, numerator: int, denominator: int) -> tuple:
    """The rank of every shingle, and for each set (``values`` holds one after the other) where its first ones are."""
    rank = levels[(values >> np.uint64(44)).astype(np.int64)].astype(np.uint16)
    if late is not None:
        rank += _held(late, values).astype(np.uint16) << 8
    taken, start = [], 0
    for end in np.cumsum(sizes).tolist():
        # the hashes of a set are sorted, so a stable sort by rank is the order
        taken.append(start + np.argsort(rank[start:end], kind="stable")[:prefix_length(end - start, numerator, denominator)])
        start = end
    return rank, taken


def sketches(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of 64-bit words for each set: bit i is the parity of its shingles whose low bits are i."""
    at = np.repeat(np.arange(len(sizes)) * SKETCH, sizes) + (values & np.uint64(SKETCH - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=len(sizes) * SKETCH) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).reshape(len(sizes), SKETCH // 64)


def _prefixes(sets: DataFrame, order: tuple, numerator: int, denominator: int, several: np.ndarray) -> DataFrame:
    """(row_no, doc_id, n, digest, prefix_digest, last, at, prefix, sketch): places and hashes of each set's first shingles.

    ``last`` is the place of the last of them in the order (hashes with equal upper 48 bits share one).  ``order`` is (levels, bits of shingles that come last); only the shingles whose bit in ``several`` is set are given.
    """
    schema = pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("prefix_digest", pa.binary()),
                        ("last", pa.int64()), ("at", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])
    shared = sets.sparkSession.sparkContext.broadcast((*order, several))

    def lists(parts):
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()),
                                        pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])))

    def first(batches):
        levels, late, wanted = shared.value
        for b in batches:
            values = b.column("shingles").flatten().to_numpy().view(np.uint64)
            rank, taken = _first_ones(values, b.column("n").to_numpy(), levels, late, numerator, denominator)
            place = (rank.astype(np.uint64) << np.uint64(48) | values >> np.uint64(16)).view(np.int64)
            digests, last, places, tokens = [], [], [], []
            for first_ones in taken:
                h = values[first_ones]
                last.append(int(place[first_ones[-1]]) if len(h) else 0)
                digests.append(hashlib.sha256(h.tobytes()).digest()[:16])
                at = np.flatnonzero(_held(wanted, h))
                places.append(at)
                tokens.append(h[at].view(np.int64))
            yield pa.record_batch([b.column("row_no"), b.column("doc_id"), b.column("n"), b.column("digest"),
                                   pa.array(digests, pa.binary()), pa.array(last, pa.int64()), lists(places), lists(tokens),
                                   lists(list(sketches(values, b.column("n").to_numpy())))], schema=schema)

    return sets.select("row_no", "doc_id", "n", "digest", "shingles").mapInArrow(
        first, "row_no long, doc_id long, n long, digest binary, prefix_digest binary, last long, "
               "at array<long>, prefix array<long>, sketch array<long>")


def _held_by_several(sets: DataFrame, order: tuple, numerator: int, denominator: int) -> np.ndarray:
    """Bitmap (``2**HELD_BITS`` bits) of the shingles that are in the prefixes of several rows.

    Shingles are counted by their first 32 + ``PART_BITS`` bits, which move packed by part, 4 bytes a shingle.
    """
    shared = sets.sparkSession.sparkContext.broadcast(order)
    schema = pa.schema([("part", pa.int32()), ("low", pa.binary())])
    parts = np.arange(1 << PART_BITS, dtype=np.uint64)

    def packed(tokens):
        tokens = np.sort(np.concatenate(tokens))
        ends = np.append(np.searchsorted(tokens, parts << np.uint64(64 - PART_BITS)), len(tokens))
        low = (tokens >> np.uint64(32 - PART_BITS)).astype(np.uint32)
        used = np.flatnonzero(np.diff(ends)).tolist()
        return pa.record_batch([pa.array(used, pa.int32()), pa.array([low[ends[i]:ends[i + 1]].tobytes() for i in used], pa.binary())], schema=schema)

    def pack(batches):
        levels, late = shared.value
        pending, held = [], 0
        for b in batches:
            values = b.column("shingles").flatten().to_numpy().view(np.uint64)
            taken = _first_ones(values, b.column("n").to_numpy(), levels, late, numerator, denominator)[1]
            pending.append(values[np.concatenate([*taken, np.zeros(0, np.int64)])])
            held += len(pending[-1])
            if held >= PENDING:
                yield packed(pending)
                pending, held = [], 0
        if held:
            yield packed(pending)

    def several(part, low):
        low = np.sort(np.concatenate(low))
        bits = np.zeros(1 << HELD_BITS - PART_BITS, bool)
        bits[low[1:][low[1:] == low[:-1]] >> np.uint32(32 + PART_BITS - HELD_BITS)] = True
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], schema=schema)

    def merge(batches):
        now, some = None, []
        for b in batches:
            for part, low in zip(b.column("part").to_pylist(), b.column("low").to_pylist()):
                if part != now and some:
                    yield several(now, some)
                    some = []
                now = part
                some.append(np.frombuffer(low, np.uint32))
        if some:
            yield several(now, some)

    merged = sets.select("n", "shingles").mapInArrow(pack, "part int, low binary") \
        .repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, low binary")
    out = np.zeros((1 << PART_BITS, 1 << HELD_BITS - PART_BITS - 3), np.uint8)
    for r in merged.collect():          # 16 MB
        out[r.part] = np.frombuffer(bytes(r.low), np.uint8)
    return out.reshape(-1)


def prefixes(sets: DataFrame, levels: np.ndarray, numerator: int, denominator: int, rounds: int = ROUNDS) -> DataFrame:
    """Stored prefixes, of whose shingles those that no other row's prefix holds are left out.

    Shingles found in several prefixes come last in the next round's order: a passage that many documents share
    thus leaves the prefixes of those that have enough shingles of their own.  Both bitmaps have a fixed size; where
    they fill up, the order is less helpful and more shingles are given.
    """
    late = several = None
    for _ in range(rounds):
        if several is not None:
            late = several if late is None else late | several
        several = _held_by_several(sets, (levels, late), numerator, denominator)
    return stored(_prefixes(sets, (levels, late), numerator, denominator, several), "join-prefixes")


# --- candidates ---------------------------------------------------------------------------

def _sizes_fit(a: str, b: str, numerator: int, denominator: int) -> str:
    return f"{a} * {numerator} <= {b} * {denominator} and {b} * {numerator} <= {a} * {denominator}"


def _rest(n: str, numerator: int, denominator: int) -> str:
    """How many shingles of a set come after its prefix: ceil(t * n) - 1."""
    return f"(({n} * {numerator} + {denominator - 1}) div {denominator} - 1)"


def _may_link(a: str, b: str, numerator: int, denominator: int):
    """Whether the groups of two postings may be similar if this is their first common shingle: by their sizes, by
    the shingles from here on, and by those left in their prefixes that any other prefix holds."""
    n_a, n_b = f"n{a}", f"n{b}"
    return F.expr(" and ".join([
        _sizes_fit(n_a, n_b, numerator, denominator),
        f"{numerator + denominator} * least({n_a} - pos{a}, {n_b} - pos{b}) >= {numerator} * ({n_a} + {n_b})",
        f"{numerator + denominator} * (least(left{a}, left{b}) + {_rest(f'greatest({n_a}, {n_b})', numerator, denominator)}) "
        f">= {numerator} * ({n_a} + {n_b})"]))


def _differ_little(a: str, b: str, words: list[str], numerator: int, denominator: int) -> str:
    """Whether sketches differ by no more bits than two similar sets do by shingles."""
    return f"{numerator + denominator} * ({' + '.join(words)}) <= {denominator - numerator} * ({a} + {b})"


def _asked(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows that are in any of the pairs (a, b), and perhaps a few more."""
    keys = pairs.select(F.explode(F.array(F.xxhash64("a"), F.xxhash64("b"))).alias("key"))
    return maybe_in(rows.withColumn("key", F.xxhash64("row_no")), "key", bitmap(keys, "key"))


def promising(pairs: DataFrame, rows: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) whose prefixes have enough shingles in common, and whose sketches differ by few enough bits.

    Of the set whose prefix ends first in the order, only the shingles after its prefix can be common beside those
    that both prefixes hold.
    """
    pairs = stored(pairs, "join-met")
    asked = _asked(rows.select("row_no", "n", "last", "prefix", "sketch"), pairs)
    a, b = (asked.select(F.col("row_no").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n", "last", "prefix", "sketch"))) for s in "ab")
    rest_a, rest_b = _rest("n_a", numerator, denominator), _rest("n_b", numerator, denominator)
    rest = f"case when last_a < last_b then {rest_a} when last_a > last_b then {rest_b} else greatest({rest_a}, {rest_b}) end"
    differ = ["aggregate(zip_with(sketch_a, sketch_b, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"]
    return pairs.join(a, "a").join(b, "b").where(_sizes_fit("n_a", "n_b", numerator, denominator)) \
        .where(_differ_little("n_a", "n_b", differ, numerator, denominator)).where(
        f"{numerator + denominator} * (size(array_intersect(prefix_a, prefix_b)) + {rest}) >= {numerator} * (n_a + n_b)").select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar enough, compared on whole sets."""
    pairs = stored(pairs, "join-pairs")
    asked = _asked(sets.select("row_no", "n", "shingles"), pairs)
    a = asked.select(F.col("row_no").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("set_a"))
    b = asked.select(F.col("row_no").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("set_b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    return stored(pairs.join(a, "a").join(b, "b")
                  .where(common * (numerator + denominator) >= (F.col("n_a") + F.col("n_b")) * numerator).select("a", "b"), "join-links")


def with_component(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with ``root``, the component of each class under the links."""
    roots = components(links)
    return classes.join(roots.select(F.col("node").alias("class"), "root"), "class", "left") \
        .withColumn("root", F.coalesce("root", "class"))


def star_pairs(postings: DataFrame, classes: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Class pairs (a, b): every member with the first class of its group, and with that of one group per posting and size band."""
    band = F.floor(F.log("n") / F.log(F.lit(denominator / numerator)))
    rows = postings.withColumn("band", band)
    hubs = rows.groupBy("token", "band").agg(F.count(F.lit(1)).alias("held"), F.max(F.struct(
        (F.col("given") / F.col("n")).alias("central"), F.col("group").alias("hub"), F.col("n").alias("n_h"), F.col("pos").alias("pos_h"),
        F.col("left").alias("left_h"))).alias("h"))
    met = rows.join(hubs.where("held > 1").select("token", "band", "h.*"), ["token", "band"]) \
        .where(F.col("group") != F.col("hub")).where(_may_link("", "_h", numerator, denominator)) \
        .select("group", "hub").distinct()
    outside = met.join(classes.select("group", "class"), "group").select(F.col("class").alias("a"), F.col("hub").alias("b"))
    return outside.unionByName(classes.where("class <> group").select(F.col("class").alias("a"), F.col("group").alias("b")))


def cross_pairs(postings: DataFrame, classes: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Class pairs (a, b) of different components that share a posting and may be similar, and those within a group."""
    brief = [f"brief{i}" for i in range(BRIEF)]
    rows = postings.join(classes.select("group", "root", *brief).distinct(), "group")
    mixed = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
    rows = stored(rows.join(mixed, "token"), "join-mixed")
    # what the members of a component have at best
    best = rows.groupBy("token", "root").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("room"),
                                             F.max("left").alias("left"), *(F.when(F.count(F.lit(1)) == 1, F.min(c)).alias(c) for c in brief))
    # null, and no filter, for several groups of a component or several classes of a group
    close = "coalesce(" + _differ_little("{0}_a", "{0}_b", [f"bit_count({c}_a ^ {c}_b)" for c in brief], numerator, denominator) + ", true)"
    x, y = (best.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("root", "least", "most", "room", "left", *brief))) for s in "ab")
    met = x.join(y, "token").where(" and ".join([
        "root_a < root_b", f"least_a * {numerator} <= most_b * {denominator}", f"least_b * {numerator} <= most_a * {denominator}",
        f"{numerator + denominator} * least(room_a, room_b) >= {numerator} * (least_a + least_b)",
        f"{numerator + denominator} * (least(left_a, left_b) + {_rest('greatest(most_a, most_b)', numerator, denominator)}) "
        f">= {numerator} * (least_a + least_b)", close.format("most")])) \
        .select("token", "root_a", "root_b", *(F.col(f"{c}_b").alias(f"{c}_o") for c in ("least", "most", "room", "left", *brief)))
    a, b = (rows.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("root", "group", "n", "pos", "left", *brief))) for s in "ab")
    # the groups of one component against what the other has at best
    near = met.join(a, ["token", "root_a"]).where(" and ".join([
        f"least_o * {numerator} <= n_a * {denominator}", f"n_a * {numerator} <= most_o * {denominator}",
        f"{numerator + denominator} * least(n_a - pos_a, room_o) >= {numerator} * (n_a + least_o)",
        f"{numerator + denominator} * (least(left_a, left_o) + {_rest('greatest(n_a, most_o)', numerator, denominator)}) >= {numerator} * (n_a + least_o)",
        "coalesce(" + _differ_little("n_a", "most_o", [f"bit_count({c}_a ^ {c}_o)" for c in brief], numerator, denominator) + ", true)"])) \
        .select("token", "root_a", "root_b", "group_a", "n_a", "pos_a", "left_a", *(f"{c}_a" for c in brief))
    groups = near.join(b, ["token", "root_b"]) \
        .where(F.col("group_a") != F.col("group_b")).where(_may_link("_a", "_b", numerator, denominator)) \
        .where(close.format("n")).select("group_a", "root_a", "group_b", "root_b").distinct()
    parts = classes.select("group", "root").distinct()      # of a group whose members reached different components
    inside = parts.select("group", F.col("root").alias("root_a")).join(parts.select("group", F.col("root").alias("root_b")), "group") \
        .where("root_a < root_b").select(F.col("group").alias("group_a"), "root_a", F.col("group").alias("group_b"), "root_b")
    groups = groups.unionByName(inside)
    member = lambda s: classes.select(F.col("group").alias(f"group_{s}"), F.col("root").alias(f"root_{s}"), F.col("class").alias(s))
    between = groups.join(member("a"), ["group_a", "root_a"]).join(member("b"), ["group_b", "root_b"]).select("a", "b")
    return between.distinct()


# --- operator -----------------------------------------------------------------------------

def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets, levels = shingle_sets(docs, shingle)
    rows = prefixes(sets, levels, numerator, denominator)
    # the sketch folded to fewer bits: parities of more shingles
    folded = {f"brief{i}": " ^ ".join(f"sketch[{j}]" for j in range(i, SKETCH // 64, BRIEF)) for i in range(BRIEF)}
    named = rows.where("n > 0").groupBy("digest").agg(
        F.min("row_no").alias("class"), F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("prefix_digest").alias("prefix_digest"),
        *(F.min(F.expr(e)).alias(c) for c, e in folded.items()))
    named = stored(named, "join-classes")
    groups = named.groupBy("n", "prefix_digest").agg(F.min("class").alias("group"), F.count(F.lit(1)).alias("members"))
    of_one = [F.when(F.col("members") == 1, F.col(c)).alias(c) for c in folded]
    classes = stored(named.join(groups, ["n", "prefix_digest"]).select("class", "digest", "least", "n", "group", *of_one), "join-groups")

    postings = rows.join(classes.select(F.col("group").alias("row_no")).distinct(), "row_no") \
        .select(F.col("row_no").alias("group"), "n", F.size("prefix").alias("given"), F.posexplode(F.arrays_zip("at", "prefix")).alias("i", "t"))
    postings = stored(postings.select("group", "n", "given", (F.col("given") - F.col("i")).alias("left"), F.col("t.at").alias("pos"), F.col("t.prefix").alias("token")), "join-postings")

    def linked(pairs: DataFrame) -> DataFrame:
        return verified(promising(pairs, rows, numerator, denominator), sets, numerator, denominator)

    stars = linked(star_pairs(postings, classes, numerator, denominator))
    reached = stored(with_component(classes, stars), "join-reached")
    links = stars.unionByName(linked(cross_pairs(postings, reached, numerator, denominator)))
    final = stored(with_component(classes, links).select("digest", "least", "root"), "join-final")
    ids = final.join(final.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("digest", "component_id")
    linked = rows.where("n > 0").join(ids, "digest").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard components of the whole ``documents`` table."""
    return jaccard_components(load(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT k, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh
  FROM d
), c AS (SELECT k, doc_id, len(sh) AS n, md5(array_to_string(list_sort(sh), chr(10))) AS dg, sh FROM s),
rep AS (SELECT dg, any_value(n) AS n, any_value(sh) AS sh FROM c WHERE n > 0 GROUP BY dg),
tok AS (SELECT dg, n, unnest(sh) AS t FROM rep),
link AS (
  SELECT a.dg AS a, b.dg AS b FROM tok a JOIN tok b ON a.t = b.t AND a.dg < b.dg AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.dg, b.dg, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (
  SELECT dg, dg FROM rep UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a
), least AS (SELECT reach.a AS dg, min(c.doc_id) AS component_id FROM reach JOIN c ON c.dg = reach.b GROUP BY reach.a)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles, CASE WHEN c.n = 0 THEN c.doc_id ELSE least.component_id END AS component_id
FROM c LEFT JOIN least USING (dg)
"""
