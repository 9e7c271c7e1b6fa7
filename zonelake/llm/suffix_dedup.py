"""Repeated-passage removal by a depth-limited radix sort of suffixes.

A byte goes if it lies in a string of ``threshold`` bytes that also starts anywhere else.  Suffixes are
sorted by most-significant-digit passes and only as deep as the threshold; suffixes that share their first
``threshold`` bytes end up in equal groups, which are exactly the repeated windows, and every pass drops the
suffixes that are alone already.  Digits are 64-bit fingerprints of byte ranges (two of them cover a window).

So that a pass need not move every suffix, suffixes are taken in bunches.  A window's *anchor* is the
``gram`` bytes in it with the least hash; equal windows have equal anchors at equal places.  The windows of
a text that share an anchor are a bunch, about ``threshold - gram`` of them at most:

1. Pass over the anchors: a bunch whose anchor occurs once holds no repeated window.
2. Bunches with equal anchors and equal bytes all around (*context*) repeat as a whole and are decided.
3. Of the rest one bunch per context goes on, as a slice of its text: a few hundred bytes at each end of a
   repeated passage.  The slices are dealt by anchor, and in each bucket the windows are sorted by their first
   digit, those alone dropped, and by their second.  A bucket of more than ``BUCKET`` slices is not put into
   one task: its windows are dealt by their digits instead, the same two passes over all tasks.

Texts that occur more than once repeat whole and take part as one text.  All minima and counts are
pre-aggregated before they are shuffled; nothing is capped.  A bitmap of fixed size thins out anchors and
texts before the exact joins.

Defined results: a null text is empty; texts under the threshold lose nothing; rows with equal texts have
equal results; an empty table gives an empty result; matches never cross texts; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bitmap, bitmap_bytes, bits_set, bound_batches, load, maybe_in, stored, text_or_empty

THRESHOLD, GRAM = 200, 32
BUCKET = 32768           # slices of one anchor that a task may hold (about 10 MB)
CHUNK = 1 << 19          # window starts treated at once
TEXT = ["t1", "t2"]      # 128-bit key of a text
BASE = np.uint64(0x9E3779B97F4A7C15)
POSITION_BITS = np.uint64(21)


# --- bunches of windows in numpy ---------------------------------------------------------

def _power_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = CHUNK + 4096
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    powers, inverses = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))]) for b in (BASE, inverse))
    letters = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return powers, inverses, letters


_TABLES: list = []


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    return x


def _least_before(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i + width] for every i, by block-wise running minima from both sides."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    full = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(x)] = x
    full = full.reshape(blocks, width)
    left = np.minimum.accumulate(full, axis=1).reshape(-1)
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def bunches(texts: list[bytes], gram: int, threshold: int = THRESHOLD):
    """Bunches of windows with a common anchor, chunk by chunk: text, first and last window start, anchor hash
    and context hash."""
    if not _TABLES:
        _TABLES.extend(_power_tables())
    powers, inverses, letters = _TABLES
    whole = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    for at in range(0, max(0, len(whole) - threshold + 1), CHUNK):
        part = whole[at:at + CHUNK + threshold - 1]
        n = len(part) - threshold + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(letters[part] * powers[:len(part)], out=sums[1:])

        def ranges(start, stop):
            return (sums[stop] - sums[start]) * inverses[start]

        count = len(part) - gram + 1
        grams = (sums[gram:] - sums[:count]) * inverses[:count]
        order = (_mixed(grams, 1) >> POSITION_BITS << POSITION_BITS) | np.arange(count, dtype=np.uint64)
        anchor = (_least_before(order, threshold - gram + 1) & ((np.uint64(1) << POSITION_BITS) - np.uint64(1))).astype(np.int64)
        place = np.arange(at, at + n)
        owner = np.searchsorted(begins, place, "right") - 1
        inside = place + threshold <= (begins + sizes)[owner]
        change = np.ones(n, bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n) - 1
        used = inside[first]
        first, last = first[used], last[used]
        where = anchor[first]
        context = _mixed(ranges(first, last + threshold), 2) + _mixed(
            ((where - first).astype(np.uint64) << np.uint64(32)) + (last - first).astype(np.uint64), 3)
        text = owner[first]
        yield {"text": text, "first": first + at - begins[text], "last": last + at - begins[text],
               "anchor": _mixed(grams[where], 4), "context": context}


def windows(texts: list[bytes], threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and the two digits of every window of short texts."""
    if not _TABLES:
        _TABLES.extend(_power_tables())
    powers, inverses, letters = _TABLES
    out = []
    for at, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(letters[raw] * powers[:len(raw)], out=sums[1:])
        start = np.arange(len(raw) - threshold + 1)
        half = start + threshold // 2
        out.append((np.full(len(start), at), start, _mixed((sums[half] - sums[start]) * inverses[start], 5),
                    _mixed((sums[start + threshold] - sums[half]) * inverses[half], 6)))
    return tuple(np.concatenate(x) for x in zip(*out))


def repeated(digits: tuple[np.ndarray, np.ndarray], weight: np.ndarray) -> np.ndarray:
    """Which windows are not alone, sorting by one digit after the other; weights of 2 count as two windows."""
    rows = np.arange(len(weight))
    key = np.zeros(len(weight), np.int64)
    for digit in digits:
        order = np.lexsort((digit[rows], key[rows]))
        rows = rows[order]
        opens = np.ones(len(rows), bool)
        opens[1:] = (digit[rows][1:] != digit[rows][:-1]) | (key[rows][1:] != key[rows][:-1])
        group = np.cumsum(opens) - 1
        key[rows] = group
        rows = rows[np.bincount(group, weight[rows])[group] > 1]  # suffixes that are alone are sorted no further
    out = np.zeros(len(weight), bool)
    out[rows] = True
    return out


# --- passes ------------------------------------------------------------------------------

def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(t1, t2, text) of every row; the key is a 128-bit hash."""
    return docs.select(*text_key(text_col), text_or_empty(text_col).alias("text"))


def anchors(texts: DataFrame, threshold: int, gram: int) -> DataFrame:
    """The anchor of every bunch."""
    def run(batches):
        for batch in batches:
            for b in bunches(batch.column("text").cast(pa.binary()).to_pylist(), gram, threshold):
                yield pa.record_batch([_longs(b["anchor"])], names=["anchor"])

    return texts.select("text").mapInArrow(run, "anchor long")


def bunch_rows(texts: DataFrame, threshold: int, gram: int, wanted: np.ndarray) -> DataFrame:
    """Bunches whose anchor's bit is set: t1, t2, anchor, context, place (first << 9 | last - first)."""
    def run(batches):
        for batch in batches:
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in TEXT]
            for b in bunches(batch.column("text").cast(pa.binary()).to_pylist(), gram, threshold):
                on = bits_set(wanted, b["anchor"])
                yield pa.record_batch([
                    *(pa.array(k[b["text"][on]]) for k in keys), _longs(b["anchor"][on]), _longs(b["context"][on]),
                    pa.array((b["first"] << 9 | (b["last"] - b["first"]))[on])], names=[*TEXT, "anchor", "context", "place"])

    return texts.mapInArrow(run, "t1 long, t2 long, anchor long, context long, place long")


def slices_of(ranges: DataFrame, threshold: int) -> DataFrame:
    """One row per open bunch of (t1, t2, text, bunches): t1, t2, anchor, begin, many, large, bytes."""
    def run(batches):
        for batch in batches:
            keys, source, rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in TEXT], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for i, found in enumerate(batch.column("bunches").to_pylist()):
                for f in found:
                    begin = f["place"] >> 9
                    source.append(i)
                    rows.append((f["anchor"], begin, f["many"], f["large"], texts[i][begin:begin + (f["place"] & 511) + threshold]))
            anchor, begin, many, large, part = zip(*rows) if rows else [()] * 5
            source = np.array(source, np.int64)
            yield pa.record_batch([
                *(pa.array(k[source]) for k in keys), pa.array(anchor, pa.int64()), pa.array(begin, pa.int64()),
                pa.array(many, pa.bool_()), pa.array(large, pa.bool_()), pa.array(part, pa.binary())],
                names=[*TEXT, "anchor", "begin", "many", "large", "bytes"])

    return ranges.mapInArrow(run, "t1 long, t2 long, anchor long, begin long, many boolean, large boolean, bytes binary")


def repeated_in_bucket(rows, threshold: int, rows_at_once: int = 2048):
    """mapInArrow body: slices sorted by anchor in, spans (t1, t2, begin, end) of their repeated windows out."""
    names = [*TEXT, "anchor", "begin", "many", "bytes"]

    def spans(held):
        t1, t2, _, begin, many, part = held
        text, start, d1, d2 = windows(part, threshold)
        many = np.array(many, bool)
        found = repeated((d1, d2), 1 + many[text].astype(np.int64)) & ~many[text]
        text, start = text[found], start[found]
        opens = np.ones(len(text), bool)
        opens[1:] = (text[1:] != text[:-1]) | (start[1:] > start[:-1] + threshold)
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(text))[:len(first)] - 1
        t1, t2, begin = (np.array(x, np.int64) for x in (t1, t2, begin))
        owner = text[first]
        return pa.record_batch([pa.array(t1[owner]), pa.array(t2[owner]), pa.array(begin[owner] + start[first]),
                                pa.array(begin[owner] + start[last] + threshold)], names=[*TEXT, "begin", "end"])

    held = [[] for _ in names]
    for batch in rows:
        for kept, c in zip(held, names):
            kept.extend(batch.column(c).to_pylist())
        if len(held[0]) < rows_at_once or held[2][0] == held[2][-1]:
            continue
        cut = np.searchsorted(np.array(held[2]), held[2][-1], "left")  # the last bucket may go on in the next batch
        yield spans([x[:cut] for x in held])
        held = [x[cut:] for x in held]
    if held[0]:
        yield spans(held)


def window_rows(slices: DataFrame, threshold: int) -> DataFrame:
    """One row per window of the slices: t1, t2, at, many, d1, d2."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            text, start, d1, d2 = windows(batch.column("bytes").to_pylist(), threshold)
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False)[text] for c in (*TEXT, "begin")}
            yield pa.record_batch([pa.array(columns["t1"]), pa.array(columns["t2"]), pa.array(columns["begin"] + start),
                                   batch.column("many").take(pa.array(text)), _longs(d1), _longs(d2)],
                                  names=[*TEXT, "at", "many", "d1", "d2"])

    return slices.mapInArrow(run, "t1 long, t2 long, at long, many boolean, d1 long, d2 long")


def repeated_windows(rows: DataFrame, threshold: int) -> DataFrame:
    """(t1, t2, begin, end) of the windows that are not alone, by one pass per digit; ``many`` counts double."""
    digits = ["d1", "d2"]
    for depth in (1, 2):
        keys = digits[:depth]
        sizes = rows.groupBy(*keys).agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1").select(*keys)
        rows = rows.join(sizes, keys, "left_semi")
    return rows.where("not many").select(*TEXT, F.col("at").alias("begin"), (F.col("at") + threshold).alias("end"))


def _merged(found: DataFrame) -> DataFrame:
    """(t1, t2, spans): overlapping and touching spans of a text joined."""
    order = Window.partitionBy(*TEXT).orderBy("begin", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = found.withColumn("opens", (reach.isNull() | (F.col("begin") > reach)).cast("int"))
    runs = opens.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*TEXT, "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy(*TEXT).agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))


def distinct_texts(docs: DataFrame, text_col: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """One row (t1, t2, text) per distinct text of at least ``threshold`` bytes, and the stored keys of those
    that occur more than once.  Only texts that may be copies are shuffled."""
    texts = _texts(docs, text_col).where(F.octet_length("text") >= threshold)
    copies = stored(texts.groupBy(*TEXT).count().where("count > 1").select(*TEXT), "suffix-copies")
    bits = stored(bitmap(copies, "t1"), "suffix-bits")
    first = stored(maybe_in(texts, "t1", bits).groupBy(*TEXT).agg(F.first("text").alias("text")), "suffix-texts")
    return maybe_in(texts, "t1", bits, keep=False).union(first), copies


def repeated_spans(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM,
                   bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(t1, t2, spans): the merged byte spans that go, per text that occurs once and loses any (stored); and
    (t1, t2) of the texts that occur more than once, which go whole (stored)."""
    if not 1 <= gram < threshold <= gram + 511:
        raise ValueError("anchors must be shorter than the threshold, by 511 bytes at most")
    bound_batches(docs.sparkSession)
    texts, copies = distinct_texts(docs, text_col, threshold)
    shared = anchors(texts, threshold, gram).groupBy("anchor").count().where("count > 1").select("anchor")
    shared = stored(shared, "suffix-anchors")
    rows = bunch_rows(texts, threshold, gram, bitmap_bytes(bitmap(shared, "anchor")))
    rows = stored(rows.join(shared, "anchor", "left_semi"), "suffix-bunches")
    place = F.struct(*TEXT, "place")
    groups = rows.groupBy("anchor", "context").agg(F.min(place).alias("low"), (F.min(place) != F.max(place)).alias("many"))
    groups = stored(groups, "suffix-contexts")
    whole = rows.join(groups.where("many").select("anchor", "context"), ["anchor", "context"], "left_semi") \
        .select(*TEXT, F.shiftright("place", 9).alias("begin"),
                (F.shiftright("place", 9) + F.col("place").bitwiseAND(F.lit(511)) + threshold).alias("end"))
    torn = groups.groupBy("anchor").count().where("count > 1").select("anchor", (F.col("count") > bucket).alias("large"))
    torn = groups.join(torn, "anchor").select("low.*", "anchor", "many", "large")
    torn = torn.groupBy(*TEXT).agg(F.collect_list(F.struct("place", "anchor", "many", "large")).alias("bunches"))
    torn = stored(torn, "suffix-torn")
    slices = slices_of(maybe_in(texts, "t1", bitmap(torn, "t1")).join(torn, TEXT), threshold)
    slices = stored(slices, "suffix-slices")
    local = slices.where("not large").repartition("anchor").sortWithinPartitions("anchor") \
        .mapInArrow(lambda it: repeated_in_bucket(it, threshold), "t1 long, t2 long, begin long, end long")
    wide = repeated_windows(window_rows(slices.where("large"), threshold), threshold)
    found = whole.union(local).union(wide).join(copies, TEXT, "left_anti").distinct()
    return stored(_merged(found), "suffix-spans"), copies


# --- operator ----------------------------------------------------------------------------

def _without(text: bytes, spans: list) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(text[at:s["begin"]])
        at = s["end"]
    return b"".join([*out, text[at:]])


def _kept(docs: DataFrame, text_col: str, spans: DataFrame) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept): remaining bytes of the texts that lose some."""
    def run(batches):
        for batch in batches:
            texts, spans = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()
            yield pa.record_batch([
                batch.column("t1"), batch.column("t2"),
                pa.array([sum(x["end"] - x["begin"] for x in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array([_without(t, s) for t, s in zip(texts, spans)], pa.binary())],
                names=[*TEXT, "n_removed", "n_spans", "kept"])

    likely = maybe_in(_texts(docs, text_col), "t1", bitmap(spans, "t1"))
    return likely.join(spans, TEXT).mapInArrow(run, "t1 long, t2 long, n_removed long, n_spans long, kept binary")


def remaining_bytes(docs: DataFrame, text_col: str = "text", threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept) of every distinct text that loses bytes; ``t1, t2`` as in ``text_key``."""
    spans, copies = repeated_spans(docs, text_col, threshold, gram)
    gone = copies.select(*TEXT, F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                         F.lit(b"").alias("kept"))
    return _kept(docs, text_col, spans).union(gone)


def text_key(text_col: str = "text") -> list:
    """The key columns t1, t2 of a text column."""
    text = text_or_empty(text_col)
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(17), text).alias("t2")]


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                   gram: int = GRAM) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), *text_key(text_col), F.octet_length(text).cast("long").alias("n_bytes"),
                       F.sha2(text, 256).alias("own"))
    lost = remaining_bytes(docs, text_col, threshold, gram) \
        .select(*TEXT, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    lost = stored(lost, "suffix-lost")
    return rows.join(lost, TEXT, "left").select(
        "doc_id", "n_bytes",
        F.when(F.col("kept_sha256").isNull(), 0).otherwise(F.coalesce("n_removed", "n_bytes")).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "own").alias("kept_sha256"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 200-byte strings from the whole ``documents`` table."""
    return dedup_passages(load(spark, sf_dir, "documents"))
