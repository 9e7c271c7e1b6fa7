"""Source divergence audit by a minimal-perfect-hash recount.

How a source's use of words differs from the other sources of its language, and which words it prefers:

1. Exact frequency filter: every task counts in how many of its documents a term occurs, the counts are
   added by (lang, term), and terms in at least ``least_docs`` documents of the language are kept.
2. The kept terms become minimal perfect hashes in shards (a language has as many as its terms need), built
   in tasks: terms fall into small buckets, the largest first, each gets the displacement that sends its
   terms to free slots.  A shard holds its keys in slot order.  All shards together are broadcast; their
   bytes are bounded by ``head_bytes``: the most frequent terms go in, as far as the bound allows.
3. The second pass hashes the words of whole batches at once, finds their slots, compares the stored key
   byte for byte (a word that was not kept finds some slot, too) and increments the dense slots of the
   document's group.  Dense slots are emitted as (group, slot, count) and cleared when a task holds over
   ``DENSE_SLOTS`` of them.
4. Terms beyond the bound and those over ``KEY_BYTES`` bytes are counted by the same pass in a table per
   task and joined on (lang, term): exact as well.
5. Divergences are sums over blocks of terms and blocks of sources; each block has a fixed size.

Probabilities are integers in billionths, with ``smoothing`` added to each count; products are decimals.

Defined results: null text, lang and source count as empty; a group without terms is there with N = 0; a
language with no kept term gives its pairs the value 0 and no term rows; repeated rows count as often as
they are there; an empty table gives an empty result; further columns are not read, whatever their names.
Groups and terms are told apart by 64-bit hashes of (lang, source); equal hashes of different groups are an
error, not a wrong sum.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bound_batches, load, stored, text_or_empty

LEAST_DOCS, SMOOTHING, TOP_TERMS, SCALE = 30, 5, 50, 1_000_000_000
HEAD_BYTES = 32 << 20     # bytes of terms in the broadcast perfect hashes
KEY_BYTES = 64            # longer terms are joined, not hashed
SHARD_KEYS = 16384        # terms of a shard, on average
TASK_TERMS = 400_000      # entries of a task's tables before they are emitted
DENSE_SLOTS = 1 << 23     # slots of a task's dense counters (8 bytes each) before they are emitted
WINDOW_BYTES = 2 << 20    # bytes of text that are hashed at once
TERM_BLOCK, SOURCE_BLOCK = 2048, 64
SLOT_BLOCK, TASKS_AT_ONCE = 16384, 256
FEW_LANGS = 10_000        # a row a language is broadcast up to so many
DISPLACEMENTS = 1024      # tried at once

# ASCII letters in lower case, every other ASCII character a blank, other bytes unchanged.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- first pass: exact document frequencies -----------------------------------------------

def terms_of(text: str) -> list[bytes]:
    """The terms of a text: runs of letters and of characters beyond ASCII, A-Z in lower case."""
    return text.encode().translate(LETTERS).split()


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, n_docs) over all documents (lang, text)."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n", pa.int64())])

    def count(batches):
        held: dict[str, Counter] = {}

        def emit():
            for lang, counts in held.items():
                terms, numbers = list(counts), list(counts.values())
                for i in range(0, len(terms), 16384):
                    part = terms[i:i + 16384]
                    yield pa.record_batch([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.string()),
                                           pa.array(numbers[i:i + 16384], pa.int64())], schema=schema)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if lang not in held:
                    held[lang] = Counter()
                held[lang].update(set(terms_of(text)))
            if sum(map(len, held.values())) > TASK_TERMS:
                yield from emit()
        yield from emit()

    return docs.select("lang", "text").mapInArrow(count, "lang string, term string, n long") \
        .groupBy("lang", "term").agg(F.sum("n").alias("n_docs"))


# --- perfect hashes -----------------------------------------------------------------------

def chunks_of(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of a buffer (which ends in eight spare bytes) as one word."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer.data, strides=(1,))


def chunk_at(chunks: np.ndarray, starts: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Eight bytes at ``starts``, those beyond the ``rest`` bytes of the word blanked out."""
    free = np.uint64(8) * (np.uint64(8) - np.minimum(rest, 8).astype(np.uint64))
    return chunks[starts] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> free)


def word_hashes(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of at most ``KEY_BYTES`` bytes at ``starts``."""
    chunks, h = chunks_of(buffer), lengths.astype(np.uint64) * STEP
    for k in range(0, int(lengths.max(initial=0)), 8):
        at = np.flatnonzero(lengths > k)
        x = (h[at] ^ chunk_at(chunks, starts[at] + k, lengths[at] - k)) * MIX
        h[at] = x ^ (x >> np.uint64(29))
    return h


def spread(h: np.ndarray, displacement: np.ndarray) -> np.ndarray:
    """The slot hash of a key under a displacement."""
    x = (h ^ (displacement.astype(np.uint64) * STEP)) * MIX
    return (x ^ (x >> np.uint64(32))) * STEP >> np.uint64(16)


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, slot of each key) for distinct hashes; the slots are 0 .. len(h) - 1.

    A bucket of one key holds its slot itself, as a negative number.
    """
    n = len(h)
    buckets = n // 3 + 1
    bucket = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    sizes = np.bincount(bucket, minlength=buckets)
    order = np.lexsort((bucket, -sizes[bucket]))
    displacement, slot, taken = np.zeros(buckets, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
    at = 0
    while at < n and sizes[bucket[order[at]]] > 1:
        keys = order[at:at + sizes[bucket[order[at]]]]
        first = 0
        while True:
            tried = np.arange(first, first + DISPLACEMENTS, dtype=np.int64)
            places = (spread(h[keys][:, None], tried[None, :]) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(places, axis=0)
            good = ~taken[places].any(axis=0) & (ordered[1:] != ordered[:-1]).all(axis=0)
            if good.any():
                break
            first += DISPLACEMENTS
        best = int(np.argmax(good))
        displacement[bucket[keys[0]]], slot[keys] = tried[best], places[:, best]
        taken[places[:, best]] = True
        at += len(keys)
    single = order[at:]
    slot[single] = np.flatnonzero(~taken)
    displacement[bucket[single]] = -slot[single] - 1
    return displacement, slot


def build_shard(lang: str, shard: int, terms: list[bytes], h: np.ndarray) -> dict:
    """One shard: displacements, and keys (lengths and chunks of eight bytes) in slot order."""
    displacement, slot = perfect_hash(h)
    ordered = [b""] * len(terms)
    for t, s in zip(terms, slot.tolist()):
        ordered[s] = t
    padded = b"".join(t + bytes(-len(t) % 8) for t in ordered)
    return {"lang": lang, "shard": shard, "terms": [t.decode() for t in ordered],
            "displacement": displacement.astype("<i8").tobytes(), "keys": padded,
            "lengths": np.fromiter(map(len, ordered), "<i4", len(ordered)).tobytes()}


def _pack(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(words) + bytes(8), np.uint8), np.cumsum(lengths) - lengths, lengths


def shards(head: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(lang, shard, n_shards, terms, displacement, keys, lengths) of the terms (lang, term); stored.

    A term whose hash another term of its language has is in no shard (left to the join).
    """

    @F.pandas_udf("long")
    def hashed(terms: pd.Series) -> pd.Series:
        return pd.Series(word_hashes(*_pack([t.encode() for t in terms])).view(np.int64))

    per_lang = _per_lang(head.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_keys).alias("n_shards")))
    rows = head.withColumn("h", hashed("term"))
    rows = rows.withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("lang", "h"))).where("same = 1")
    rows = rows.join(per_lang, "lang").withColumn("shard", F.expr("shiftrightunsigned(h, 40) % n_shards"))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        made = build_shard(key[0], int(key[1]), [t.encode() for t in pdf.term], pdf.h.to_numpy().view(np.uint64))
        return pd.DataFrame([made | {"n_shards": int(pdf.n_shards.iloc[0])}])

    schema = "lang string, shard long, terms array<string>, displacement binary, keys binary, lengths binary, n_shards long"
    return stored(rows.groupBy("lang", "shard").applyInPandas(build, schema), "divergence-shards")


class Lookup:
    """All shards as flat arrays; the slots of a language are one run."""

    def __init__(self, parts: list):
        parts = sorted(parts, key=lambda r: (r.lang, r.shard))
        self.langs: dict[str, tuple[int, int, int, int]] = {}   # lang: first slot, end, first shard, shards
        lengths = [np.frombuffer(bytes(r.lengths), "<i4").astype(np.int64) for r in parts]
        displacements = [np.frombuffer(bytes(r.displacement), "<i8") for r in parts]
        self.size = np.array([len(x) for x in lengths], np.int64)
        self.buckets = np.array([len(x) for x in displacements], np.int64)
        self.offset = np.cumsum(self.size) - self.size
        self.bucket_offset = np.cumsum(self.buckets) - self.buckets
        self.displacement = np.concatenate([*displacements, np.zeros(0, np.int64)])
        self.lengths = np.concatenate([*lengths, np.zeros(0, np.int64)])
        words = (self.lengths + 7) // 8
        self.key_at = np.cumsum(words) - words
        self.keys = np.frombuffer(b"".join(bytes(r.keys) for r in parts) + bytes(8), "<u8")
        self.first = {}
        ends = self.offset + self.size
        present: dict[str, dict[int, int]] = {}
        for i, r in enumerate(parts):
            low, high, _, _ = self.langs.get(r.lang, (int(self.offset[i]), 0, 0, 0))
            self.langs[r.lang] = (low, int(ends[i]), 0, int(r.n_shards))
            present.setdefault(r.lang, {})[int(r.shard)] = i
        place = []   # shard number of a language -> index here, -1 where a shard got no term
        for lang, (low, high, _, n) in self.langs.items():
            self.langs[lang] = (low, high, len(place), n)
            place += [present[lang].get(s, -1) for s in range(n)]
        self.place = np.array(place, np.int64)

    def slots(self, buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: np.ndarray,
              count: np.ndarray) -> np.ndarray:
        """The slot of each word, -1 where it is no key; ``base`` and ``count`` are its language's shards."""
        h = word_hashes(buffer, starts, lengths)
        shard = self.place[base + ((h >> np.uint64(40)) % count.astype(np.uint64)).astype(np.int64)]
        safe = np.maximum(shard, 0)
        bucket = ((h >> np.uint64(20)) % self.buckets[safe].astype(np.uint64)).astype(np.int64)
        moved = self.displacement[self.bucket_offset[safe] + bucket]
        inside = (spread(h, moved) % self.size[safe].astype(np.uint64)).astype(np.int64)
        slot = self.offset[safe] + np.where(moved < 0, -moved - 1, inside)
        fits = (shard >= 0) & (self.lengths[slot] == lengths)
        chunks = chunks_of(buffer)
        for k in range(0, int(lengths[fits].max(initial=0)), 8):   # stored keys, byte for byte
            at = np.flatnonzero(fits & (lengths > k))
            fits[at] = self.keys[self.key_at[slot[at]] + k // 8] == chunk_at(chunks, starts[at] + k, lengths[at] - k)
        return np.where(fits, slot, -1)


# --- second pass: dense slots per group ---------------------------------------------------

def windows(text: bytes, size: int = WINDOW_BYTES):
    """Pieces of a blanked text, cut at blanks."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            if cut <= at:
                cut = text.find(b" ", end)
            end = len(text) if cut < 0 else cut + 1
        yield text[at:end]
        at = end


def _words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buffer = np.frombuffer(text + bytes(8), np.uint8)
    letter = np.concatenate([[False], buffer[:len(text)] != 32, [False]])
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    return buffer, edge[::2], edge[1::2] - edge[::2]


def recount(docs: DataFrame, lookup: Lookup, with_rest: bool) -> tuple[DataFrame, DataFrame]:
    """Occurrences by group: (g, slot, n) of the keys and, ``with_rest``, (g, lang, term, n) of all other terms.

    A task emits the used slots of a group's dense counters by blocks of ``SLOT_BLOCK`` slots, as one row a block.
    """
    schema = pa.schema([("task", pa.int64()), ("g", pa.int64()), ("block", pa.int64()), ("slots", pa.binary()), ("counts", pa.binary()),
                        ("lang", pa.string()), ("term", pa.string()), ("n", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def batch_of(**columns):
        n = len(next(iter(columns.values())))
        return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def count(batches):
        table = shared.value
        dense: dict[int, tuple[int, np.ndarray]] = {}
        rest: Counter = Counter()

        def emit():
            for g, (low, counts) in dense.items():
                out = []
                for at in range(0, len(counts), SLOT_BLOCK):
                    part = counts[at:at + SLOT_BLOCK]
                    used = np.flatnonzero(part)
                    if len(used):
                        out.append((g, low + at, used.astype("<u2").tobytes(), part[used].astype("<i8").tobytes()))
                if out:
                    yield batch_of(**dict(zip(("g", "block", "slots", "counts"), zip(*out))))
            items = list(rest.items())
            for i in range(0, len(items), 8192):
                keys, numbers = zip(*items[i:i + 8192])
                g, lang, term = zip(*keys)
                yield batch_of(g=g, lang=lang, term=term, n=numbers)
            dense.clear()
            rest.clear()

        def add(held):
            """The words of some documents [(group, lang, blanked text)], hashed at once."""
            text = b" ".join(t for _, _, t in held)
            buffer, starts, lengths = _words(text)
            if not len(starts):
                return
            sizes = np.array([len(t) + 1 for _, _, t in held])
            ends = np.searchsorted(starts, np.cumsum(sizes)).tolist()
            known = [table.langs.get(lang) for _, lang, _ in held]
            per_doc = np.diff([0, *ends])
            base = np.repeat(np.array([k[2] if k else 0 for k in known]), per_doc)
            count_ = np.repeat(np.array([k[3] if k else 0 for k in known]), per_doc)
            keyed = np.flatnonzero((count_ > 0) & (lengths <= KEY_BYTES))
            slot = np.full(len(starts), -1, np.int64)
            if len(keyed):
                slot[keyed] = table.slots(buffer, starts[keyed], lengths[keyed], base[keyed], count_[keyed])
            a = 0
            for (g, lang, _), k, b in zip(held, known, ends):
                found = slot[a:b]
                if k and b > a:
                    if g not in dense:
                        dense[g] = (k[0], np.zeros(k[1] - k[0], np.int64))
                    low, counts = dense[g]
                    np.add.at(counts, found[found >= 0] - low, 1)
                if with_rest:
                    rest.update((g, lang, text[s:s + n]) for s, n in
                                zip(starts[a:b][found < 0].tolist(), lengths[a:b][found < 0].tolist()))
                a = b

        held, size = [], 0
        for batch in batches:
            for g, lang, text in zip(*(batch.column(c).to_pylist() for c in ("g", "lang", "text"))):
                for piece in windows(text.encode().translate(LETTERS)):
                    held.append((g, lang, piece))
                    size += len(piece)
                    if size > WINDOW_BYTES:
                        add(held)
                        held, size = [], 0
                        if sum(len(c) for _, c in dense.values()) > DENSE_SLOTS or len(rest) > TASK_TERMS:
                            yield from emit()
        if held:
            add(held)
        yield from emit()

    raw = stored(docs.select("g", "lang", "text").mapInArrow(
        count, "task long, g long, block long, slots binary, counts binary, lang string, term string, n long")
        .withColumn("task", F.spark_partition_id().cast("long")), "divergence-recount")
    rest = raw.where("term is not null").groupBy("g", "lang", "term").agg(F.sum("n").alias("n"))
    return merged_blocks(raw.where("block is not null").select("task", "g", "block", "slots", "counts")), rest


def merged_blocks(blocks: DataFrame) -> DataFrame:
    """(g, slot, n): the blocks of all tasks added up, those of ``TASKS_AT_ONCE`` tasks first."""
    part = pa.schema([("task", pa.int64()), ("g", pa.int64()), ("block", pa.int64()), ("slots", pa.binary()), ("counts", pa.binary())])
    flat = pa.schema([("g", pa.int64()), ("slot", pa.int64()), ("n", pa.int64())])

    def add(batches, last: bool):
        now, total = None, None

        def done():
            used = np.flatnonzero(total)
            if last:
                return pa.record_batch([pa.array(np.full(len(used), now[1])), pa.array(used + now[2]), pa.array(total[used])], schema=flat)
            return pa.record_batch([pa.array([x], t) for x, t in zip((*now, used.astype("<u2").tobytes(), total[used].tobytes()), part.types)], schema=part)

        for b in batches:
            for *key, slots, counts in zip(*(b.column(c).to_pylist() for c in part.names)):
                if key != now:
                    if now is not None:
                        yield done()
                    now, total = key, np.zeros(SLOT_BLOCK, np.int64)
                total[np.frombuffer(slots, "<u2")] += np.frombuffer(counts, "<i8")
        if now is not None:
            yield done()

    def dealt(df):
        return df.repartition("task", "g", "block").sortWithinPartitions("task", "g", "block").select(part.names)

    some = dealt(blocks.withColumn("task", F.expr(f"task div {TASKS_AT_ONCE}"))) \
        .mapInArrow(lambda it: add(it, False), "task long, g long, block long, slots binary, counts binary")
    return dealt(some.withColumn("task", F.lit(0).cast("long"))).mapInArrow(lambda it: add(it, True), "g long, slot long, n long")


# --- operator -----------------------------------------------------------------------------

def head_terms(kept: DataFrame, head_bytes: int = HEAD_BYTES) -> tuple[DataFrame, bool]:
    """The most frequent kept terms whose bytes are within the bound, and whether there are others."""
    cost = F.octet_length("term") + F.octet_length("lang") + 24
    level = F.floor(F.log2("n_docs") * 8)
    short = F.octet_length("term") <= KEY_BYTES
    sizes = kept.where(short).groupBy(level.alias("level")).agg(F.sum(cost).alias("bytes")).orderBy(F.desc("level")).collect()
    total, least = 0, None      # a few hundred levels at most
    for r in sizes:
        total += r.bytes
        if total > head_bytes:
            break
        least = r.level
    head = kept.where(short & (level >= F.lit(least))) if least is not None else kept.limit(0)
    return head.select("lang", "term"), total > head_bytes


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, head_bytes: int = HEAD_BYTES,
                shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, DataFrame]:
    """Stored terms (term_id, lang, term) and stored counts (g, term_id, n > 0) of ``docs`` (g, lang, text)."""
    spark = docs.sparkSession
    kept = stored(document_frequencies(docs).where(F.col("n_docs") >= least_docs), "divergence-kept")
    head, _ = head_terms(kept, head_bytes)
    parts = shards(head, shard_keys)
    lookup = Lookup(parts.select("lang", "shard", "n_shards", "displacement", "keys", "lengths").collect())
    keys = parts.select("lang", "shard", F.posexplode("terms").alias("at", "term"))
    starts = spark.createDataFrame(
        [(lang, s, int(lookup.offset[lookup.place[base + s]])) for lang, (_, _, base, n) in lookup.langs.items()
         for s in range(n) if lookup.place[base + s] >= 0], "lang string, shard long, first long")
    keys = keys.join(F.broadcast(starts), ["lang", "shard"]).select((F.col("first") + F.col("at")).alias("term_id"), "lang", "term")
    others = kept.join(keys, ["lang", "term"], "left_anti").select(
        (F.monotonically_increasing_id() + len(lookup.lengths)).alias("term_id"), "lang", "term")
    terms = stored(keys.unionByName(others), "divergence-terms")
    rest = terms.where(F.col("term_id") >= len(lookup.lengths))
    found, others = recount(docs, lookup, not rest.isEmpty())
    named = others.join(rest, ["lang", "term"]).select("g", "term_id", "n")
    return terms, stored(found.withColumnRenamed("slot", "term_id").unionByName(named), "divergence-counts")


def _per_lang(df: DataFrame) -> DataFrame:
    """A table of one row a language, to be joined: broadcast if it is counted as small."""
    df = stored(df, "divergence-langs")
    return F.broadcast(df) if df.count() <= FEW_LANGS else df


def _share(count: str, total: str, smoothing: int, scale: int):
    """1 + floor(scale * (count + smoothing) / (total + smoothing * V)), exact."""
    over = f"(cast({count} as decimal(20,0)) + {smoothing}) * cast({scale} as decimal(12,0))"
    return F.expr(f"1 + ({over}) div (cast({total} as decimal(20,0)) + cast({smoothing} as decimal(10,0)) * cast(v as decimal(20,0)))")


def _block_sums(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of absolute differences over a block of terms for all pairs of two blocks of sources."""
    _, _, x, y = key
    zero = pdf.drop_duplicates("g").set_index("g").sort_index()
    ids = zero.index.to_numpy()
    filled = pdf[pdf.term_id.notna()]
    term, names = pd.factorize(filled.term_id)
    share = np.repeat(zero.z.to_numpy(np.int64)[:, None], max(1, len(names)), axis=1)
    share[pd.Index(ids).get_indexer(filled.g), term] = filled.p.to_numpy(np.int64)
    share = share[:, :len(names)]
    block = zero.block.to_numpy()
    out = []
    for i in np.flatnonzero(block == x):
        others = np.flatnonzero(block == y)
        if x == y:
            others = others[others > i]
        sums = np.abs(share[others] - share[i]).sum(axis=1)
        out.append(pd.DataFrame({"a": ids[i], "b": ids[others], "part_sum": sums, "n_terms": len(names)}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "part_sum": [], "n_terms": []}, dtype=np.int64)


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               least_docs: int = LEAST_DOCS, smoothing: int = SMOOTHING, top_terms: int = TOP_TERMS,
               scale: int = SCALE, head_bytes: int = HEAD_BYTES, shard_keys: int = SHARD_KEYS,
               source_block: int = SOURCE_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): divergences between the sources of a language (``pair``)
    and the terms that a source uses more than its language (``term``, the first ``top_terms``)."""
    bound_batches(docs.sparkSession)
    docs = docs.select(text_or_empty(text_col).alias("text"), text_or_empty(lang_col).alias("lang"),
                       text_or_empty(source_col).alias("source")).withColumn("g", F.xxhash64("lang", "source"))
    names = stored(docs.select("g", "lang", "source").distinct(), "divergence-groups")
    if not names.groupBy("g").count().where("count > 1").isEmpty():
        raise ValueError("two groups have the same 64-bit hash")
    terms, counts = term_counts(docs, least_docs, head_bytes, shard_keys)

    sizes = _per_lang(names.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
                      .join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left").fillna(0, ["v"]))
    totals = counts.groupBy("g").agg(F.sum("n").alias("total"))
    groups = names.join(totals, "g", "left").fillna(0, ["total"]).join(sizes, "lang") \
        .withColumn("z", F.when(F.col("v") > 0, _share("0", "total", smoothing, scale)).otherwise(F.lit(0)))
    groups = stored(groups.withColumn("blocks", F.ceil(F.col("n_sources") / source_block))
                    .withColumn("block", F.expr("pmod(g, blocks)"))
                    .withColumn("term_blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / term_block))), "divergence-sizes")
    shares = stored(counts.join(groups.select("g", "lang", "total", "v", "z", "block", "blocks", "term_blocks"), "g")
                    .withColumn("p", _share("n", "total", smoothing, scale))
                    .withColumn("term_block", F.expr("pmod(xxhash64(term_id), term_blocks)")), "divergence-shares")

    # pairs: every group is in every block of terms, there with its zero share at least
    empty = groups.select("g", "lang", "z", "block", "blocks", F.explode(F.expr("sequence(0L, term_blocks - 1)")).alias("term_block"),
                          F.lit(None).cast("long").alias("term_id"), F.lit(None).cast("long").alias("p"))
    cells = shares.select(empty.columns).unionByName(empty)
    dealt = cells.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)"))) \
        .withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    sums = dealt.groupBy("lang", "term_block", "x", "y").applyInPandas(
        _block_sums, "a long, b long, part_sum long, n_terms long")
    sums = sums.groupBy("a", "b").agg(F.sum("part_sum").alias("part_sum"), F.sum("n_terms").alias("n_terms"))
    a = groups.select(F.col("g").alias("a"), "lang", F.col("source").alias("source_a"), F.col("z").alias("z_a"), "v")
    b = groups.select(F.col("g").alias("b"), F.col("source").alias("source_b"), F.col("z").alias("z_b"))
    value = F.col("part_sum") + (F.col("v") - F.col("n_terms")) * F.abs(F.col("z_a") - F.col("z_b"))
    pairs = sums.join(a, "a").join(b, "b").select("lang", "source_a", "source_b", value.alias("value"))
    pairs = pairs.select("lang", F.explode(F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))).alias("r"), "value") \
        .select("lang", "r.source", F.lit("pair").alias("part"), "r.item", "value")

    # terms: the group's share against its language's
    whole = counts.join(terms.select("term_id", "lang"), "term_id").groupBy("lang", "term_id").agg(F.sum("n").alias("n"))
    whole = whole.join(_per_lang(groups.groupBy("lang").agg(F.sum("total").alias("total"))), "lang").join(sizes, "lang") \
        .select("term_id", _share("n", "total", smoothing, scale).alias("q"))
    above = shares.join(whole, "term_id").where("p > q") \
        .join(terms.select("term_id", "term"), "term_id").join(groups.select("g", "source"), "g") \
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.withColumn("rank", F.row_number().over(order)) \
        .unionByName(above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence audit of the whole ``documents`` table."""
    return divergence(load(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30
), g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
cell AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, v.v,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), share AS (
  SELECT lang, source, term, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * v) AS p FROM cell
), lang_cell AS (
  SELECT lang, term, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS total, any_value(v) AS v
  FROM cell GROUP BY lang, term
), lang_share AS (
  SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * v) AS q FROM lang_cell
), diff AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pair AS (
  SELECT x.lang, x.source, y.source AS item, coalesce(diff.value, 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN diff ON diff.lang = x.lang AND diff.source = x.source AND diff.item = y.source
), term AS (
  SELECT lang, source, term AS item, p - q AS value FROM share JOIN lang_share USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pair
UNION ALL
SELECT * FROM (
  SELECT lang, source, 'term' AS part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM term
) WHERE rank <= 50
"""
