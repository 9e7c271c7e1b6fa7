"""Benchmark decontamination by template canonicalisation.

Words (split at white space, outer punctuation removed, lower-cased) become template tokens: numbers turn
into ``<num>``, a unit after a number into ``<unit>`` and, in the *typed* form, a capitalised word inside a
sentence into ``<name>``; in the *opened* form, so does a capitalised word that begins a sentence and may be
a name.  The *plain* form keeps names, so that re-cased copies are found as well.  Five consecutive tokens
are a window.  The windows of the benchmark items are hash-joined with those of all
documents.  On one diagonal (same shift between item and document) an item value stands for one document
value, the one in most windows (then the equal one, then the greatest); windows with another one are no
match, unless they equal the item's word for word.  A document is contaminated by an item if its matches
cover ``similarity`` or more of the item's windows.

Scale: a document emits only windows whose bit is set in a bitmap of fixed size built from
the benchmark windows, whatever their number; false positives fall out in the join, nothing is missed.
Rows are keyed by the SHA-256 of their text, so copies collapse before the join and nothing of the
documents or the benchmark but that bitmap passes the driver.

An item with fewer than five words, or whose windows all have fewer than ``LITERALS`` words that are no
placeholder, is matched whole: its words and symbols, numbers included, are one window of its own length.
Characters of scripts without blanks are a word each.

Defined results: a null text has no words; an item without words contaminates nothing; an item or
document that occurs repeatedly counts each time; an empty benchmark flags nothing; further columns are
kept by ``drop_contaminated`` and not read otherwise.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bitmap, bitmap_bytes, bits_set, bound_batches, fresh, load, stored, text_or_empty

WORDS, SIMILARITY, LITERALS = 5, 0.8, 2
CACHED_WORDS = 600_000
TOGETHER = 1 << 18   # characters of the texts that are taken apart in one pass
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons tonne
tonnes oz lb lbs pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min minute
minutes h hr hour hours day days week weeks month months year years percent % degree degrees c f k w kw v a hz
mb gb tb usd eur gbp dollar dollars euro euros cent cents people items""".split())
NUMBER = re.compile(r"\d[\d.,:/]*(?:st|nd|rd|th|%|[a-zµ°]{1,4})?")
NUM, UNIT, NAME = (np.uint64(xxhash.xxh64_intdigest(f"<{x}>", 1)) for x in ("num", "unit", "name"))
LITERAL, IS_NUM, IS_UNIT, IS_CAP, ENDS, EMPTY, SYMBOL = 0, 1, 2, 4, 8, 16, 32
NO_BLANKS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
                       "\U00020000-\U0003ffff][\u0300-\u036f\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u3099\u309a]*)")
BREAK = b"\x00"
BASE, BASE_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


class _Index(dict):
    """Number of each word; a word that is not in it yet gets the next one and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class Vocabulary:
    """Hash and properties of words, kept per Python worker in a bounded cache."""

    def __init__(self, cached_words: int = CACHED_WORDS):
        self.cached_words = cached_words
        self._clear()

    def _clear(self) -> None:
        self.index, self.cores = _Index(), []
        self.hashes, self.flags = np.zeros(1024, np.uint64), np.zeros(1024, np.uint8)

    def _learn(self, words: list[bytes]) -> None:
        shown = b"\n".join(words).decode().split("\n")
        stems = [w[:-1] if w[-1] in ".," else w for w in shown]
        lows, flags = "\n".join(stems).lower().split("\n"), []
        for i, (stem, low) in enumerate(zip(stems, lows)):
            if stem.isalpha():  # the common case: letters, at most a point or comma behind
                flags.append(ENDS * (shown[i][-1] == ".") | IS_UNIT * (low in UNITS) | IS_CAP * (stem[0].isupper() and stem != stem.upper()))
            else:
                lows[i], flag = self._odd(shown[i])
                flags.append(flag)
        at, end = len(self.cores), len(self.cores) + len(words)
        while end > len(self.hashes):
            self.hashes, self.flags = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hashes, self.flags))
        self.hashes[at:end], self.flags[at:end] = np.fromiter(map(xxhash.xxh64_intdigest, lows), np.uint64, len(words)), flags
        self.cores += lows

    def _odd(self, shown: str) -> tuple[str, int]:
        """Core and properties of a word that is not only letters."""
        core = re.sub(r"^[\W_]+|[\W_]+$", "", shown)
        flags = ENDS if shown.rstrip("\"'”’)]»").endswith((".", "!", "?", ":", BREAK.decode())) else 0
        low = core.lower()
        if not core:
            symbol = SYMBOL * any(c in "-*/&#@" or unicodedata.category(c) == "Sm" for c in shown)
            return ("%", flags | IS_UNIT) if shown == "%" else (shown, flags | EMPTY | symbol)
        if NUMBER.fullmatch(low):
            return low, flags | IS_NUM
        return low, flags | IS_UNIT * (low in UNITS) | IS_CAP * (core[0].isupper() and core != core.upper())

    def look_up(self, words: list[bytes]) -> np.ndarray:
        if len(self.index) > self.cached_words:
            self._clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.new:
            self._learn(self.index.new)
            self.index.new = []
        return at


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _may_lack_blanks(text: str) -> bool:
    """Whether any character lies in the span of the scripts without blanks (punctuation in between left out)."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return bool(((code >= 0xe00) & ((code < 0x2000) | (code >= 0x3005))).any())


class Templates:
    """Template tokens of texts, one text after the other, and the windows inside each."""

    def __init__(self, texts: list[str | None], vocabulary: Vocabulary, words: int = WORDS):
        raw, sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = text or ""
            if not text.isascii() and _may_lack_blanks(text):
                text = NO_BLANKS.sub(r" \1 ", text)
            own = text.encode().replace(b"\n", b" " + BREAK + b" ").split()
            sizes[i] = len(own)
            raw += own
        at = vocabulary.look_up(raw)
        self.cores = vocabulary.cores
        flags = vocabulary.flags[at]
        of = np.repeat(np.arange(len(texts)), sizes)
        first = np.ones(len(at), bool)
        first[1:] = ((flags[:-1] & ENDS) > 0) | (of[1:] != of[:-1])
        real = (flags & EMPTY) == 0
        self._all, self._vocabulary = (at, flags, real, of), vocabulary
        if not real.all():
            at, flags, first, of = at[real], flags[real], first[real], of[real]
        self.at, self.of = at, of
        counts = np.bincount(of, minlength=len(texts))
        self.starts = np.cumsum(counts) - counts
        num = (flags & IS_NUM) > 0
        unit = (flags & IS_UNIT) > 0
        unit[:1] = False
        unit[1:] &= num[:-1] & (of[1:] == of[:-1])
        self.fixed = num | unit
        cap = ((flags & IS_CAP) > 0) & ~self.fixed
        self.name, opens = cap & ~first, cap & first
        plain = vocabulary.hashes[self.at]
        plain[num], plain[unit] = NUM, UNIT
        self.words, self.n = words, max(0, len(plain) - words + 1)
        inside = self.of[:self.n] == self.of[words - 1:]
        # hashes of the windows with enough literal words; further forms only where they differ
        usable = inside & (self._sums(~self.fixed) >= LITERALS) if self.fixed.any() else inside
        self.forms = [(self.fixed, *self._form(plain, usable))]  # slots, places, hashes
        slots = self.fixed
        for added in (self.name, opens):
            if added.any():
                slots = slots | added
                tokens = np.where(slots & ~self.fixed, NAME, plain)
                self.forms.append((slots, *self._form(tokens, inside & (self._sums(~slots) >= LITERALS) & (self._sums(added) > 0))))
        self.usable = np.bincount(self.of[:self.n][usable], minlength=len(texts))  # of each text

    def _sums(self, mask: np.ndarray) -> np.ndarray:
        return sum(mask[j:j + self.n].astype(np.int8) for j in range(self.words)) if self.n else np.zeros(0, np.int8)

    def _form(self, tokens: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the usable windows."""
        at = np.flatnonzero(usable)
        every = 2 * len(at) > self.n  # slices of all windows are quicker than picking most of them
        h, mixed = np.zeros(self.n if every else len(at), np.uint64), _mixed(tokens)
        for j in range(self.words if len(at) else 0):
            h ^= mixed[j:j + self.n] if every else mixed[at + j]
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
        return at, h[at] if every and len(at) < self.n else h

    @cached_property
    def _whole(self) -> tuple[np.ndarray, np.ndarray]:
        at, flags, real, of = self._all
        worded = np.bincount(of[real], minlength=len(self.usable)) > 0
        kept = (real | ((flags & SYMBOL) > 0)) & worded[of]
        return self._vocabulary.hashes[at[kept]], of[kept]

    @property
    def whole(self) -> np.ndarray:
        """Hashes of the words and symbols of texts with any word; to be asked for before the vocabulary sees further texts."""
        return self._whole[0]

    @cached_property
    def whole_sizes(self) -> np.ndarray:
        """How many words and symbols each text has in ``whole``."""
        return np.bincount(self._whole[1], minlength=len(self.usable))

    @cached_property
    def whole_starts(self) -> np.ndarray:
        return np.cumsum(self.whole_sizes) - self.whole_sizes

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All runs of ``size`` words and symbols inside a text: its number, their positions in it and hashes."""
        of = self._whole[1]
        n = max(0, len(of) - size + 1)
        at = np.flatnonzero(of[:n] == of[size - 1:])
        return of[at], at - self.whole_starts[of[at]], self.exact(size)[at]

    def ones_without_windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts that have words and no usable window: numbers, sizes and hashes, each as one run."""
        which = np.flatnonzero((self.whole_sizes > 0) & (self.usable == 0))
        start, size = self.whole_starts[which], self.whole_sizes[which]
        total, back = self._polynomial
        return which, size, _mixed((total[start + size] - total[start]) * back[start] + size.astype(np.uint64))

    def exact(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words and symbols as they are, those that go from a text to the next included."""
        n = max(0, len(self.whole) - size + 1)
        total, back = self._polynomial
        return _mixed((total[size:size + n] - total[:n]) * back[:n] + np.uint64(size))

    @cached_property
    def _polynomial(self) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of a polynomial in odd BASE, modulo 2 ** 64, and the inverse powers that take a run to its start."""
        m = len(self.whole)
        total = np.zeros(m + 1, np.uint64)
        np.cumsum(_mixed(self.whole) * np.cumprod(np.full(m, BASE, np.uint64)), out=total[1:])
        return total, np.cumprod(np.full(m, BASE_INVERSE, np.uint64))

    def values(self, place: int, slots: np.ndarray) -> list[str]:
        """Values of the placeholders of the window at a place, in order."""
        part = slice(place, place + self.words)
        return [self.cores[k] for k in self.at[part][slots[part]]]


class Template(Templates):
    """Template tokens of one text and its windows."""

    def __init__(self, text: str | None, vocabulary: Vocabulary, words: int = WORDS):
        super().__init__([text], vocabulary, words)


def together(texts: list[str | None]) -> list[list[str | None]]:
    """The texts in runs of ``TOGETHER`` characters at most, or of one text."""
    out, held = [], TOGETHER
    for text in texts:
        held += len(text or "")
        if held > TOGETHER or not out:
            out.append([])
            held = len(text or "")
        out[-1].append(text)
    return out


_VOCABULARY = Vocabulary()


def vocabulary() -> Vocabulary:
    """The worker's vocabulary.  Tasks reach it through this function: a global that a task's function names is copied with it."""
    return _VOCABULARY


WINDOW_TYPE = pa.struct([("position", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.string())), ("size", pa.int32())])
WINDOW_SCHEMA = "position int, hash long, slots array<string>, size int"


def _windows(rows: DataFrame, words: int, wanted: np.ndarray | None, sizes: list[int] | None = None) -> DataFrame:
    """Windows of ``rows`` (key, text): key, n_windows, position, hash, slots; only those whose bit is set in
    ``wanted``.  Positions with several forms give a row of each.  Without ``sizes`` a text that has no
    usable window gives itself as one; with them every run of these sizes is a window, too.  ``size`` is null
    for the windows of ``words`` tokens."""
    bound_batches(rows.sparkSession)
    key_type = rows.schema["key"].dataType.simpleString()

    def found(t: Templates) -> list[tuple]:
        """(number of the text, n_windows, positions, hashes, slots, size), as arrays."""
        out = []
        for form, place, h in t.forms:
            if wanted is not None and len(place):
                set_ = bits_set(wanted, h)
                place, h = place[set_], h[set_]
            of = t.of[place]
            out.append((of, t.usable[of], place - t.starts[of], h, [t.values(p, form) for p in place.tolist()], [None] * len(of)))
        if sizes is None:
            of, size, h = t.ones_without_windows()
            runs = [(of, np.zeros(len(of), np.int64), h, size.tolist())]
        else:
            runs = [(*t.runs(k), [k]) for k in sizes]
        for of, position, h, size in runs:
            if sizes is not None:
                size = size * len(of)
            if wanted is not None and len(of):
                set_ = bits_set(wanted, h)
                of, position, h, size = of[set_], position[set_], h[set_], [k for k, s in zip(size, set_.tolist()) if s]
            out.append((of, np.ones(len(of), np.int64), position, h, [[]] * len(of), size))
        return out

    def cut(batches):
        for batch in batches:
            before, parts = 0, []
            for texts in together(batch.column("text").to_pylist()):
                parts += [(of + before, *rest) for of, *rest in found(Templates(texts, vocabulary(), words))]
                before += len(texts)
            source, total, position, hashes = (np.concatenate([p[i] for p in parts] + [np.zeros(0, kind)]) for i, kind in enumerate(("i8", "i8", "i8", "u8")))
            slots, size = ([x for p in parts for x in p[i]] for i in (4, 5))
            yield pa.record_batch([
                batch.column("key").take(pa.array(source)), pa.array(total), pa.array(position.astype(np.int32)), pa.array(hashes.view(np.int64)),
                pa.array(slots, pa.list_(pa.string())), pa.array(size, pa.int32())],
                names=["key", "n_windows", "position", "hash", "slots", "size"])

    return rows.mapInArrow(cut, f"key {key_type}, n_windows long, {WINDOW_SCHEMA}")


def torn_pairs(match: DataFrame) -> DataFrame:
    """Per diagonal with an item value that stands for several document values: the pairs (a, b) that lose."""
    diagonal = ["key", "row", "shift"]
    votes = match.select(*diagonal, "item_at", F.explode("pairs").alias("pair")).distinct() \
        .groupBy(*diagonal, "pair.a", "pair.b").agg(F.count(F.lit(1)).alias("n"))
    values = votes.groupBy(*diagonal, "a").agg(F.max(F.struct("n", F.col("a") == F.col("b"), "b"))["b"].alias("best"),
                                               F.collect_list("b").alias("bs")).where(F.size("bs") > 1)
    lost = values.select(*diagonal, "a", "best", F.explode("bs").alias("b")).where("b <> best")
    return lost.groupBy(*diagonal).agg(F.collect_list(F.struct("a", "b")).alias("torn"))


def candidates(found: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """Pairs (key, row) of texts and items that share one of the item's rarest windows.

    A text that covers the share of an item's windows misses n - ceil(share * n) of them at most, so it holds one
    of any n - ceil(share * n) + 1.  Taken are those that fewest texts hold: a beginning that many questions and
    texts have in common pairs none of them.
    """
    held = found.groupBy("hash").agg(F.count(F.lit(1)).alias("held"))
    weight = own.join(held, "hash", "left").groupBy("row", "item_at", "n_windows").agg(F.coalesce(F.sum("held"), F.lit(0)).alias("weight"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy("weight", "item_at"))
    rare = weight.withColumn("rank", rank).where(F.col("rank") <= F.col("n_windows") - F.ceil((similarity - 1e-9) * F.col("n_windows")) + 1)
    rare = own.join(rare.where("weight > 0").select("row", "item_at"), ["row", "item_at"]).select("row", "hash").distinct()
    return found.select("key", "hash").distinct().join(rare, "hash").select("key", "row").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """Stored rows (text_sha256, item_ids, containment) of the contaminated texts."""
    items = benchmark.select(F.struct(F.col(item_col).alias("item"), F.monotonically_increasing_id().alias("row")).alias("key"),
                             F.col(item_text_col).cast("string").alias("text"))
    items = stored(items.select("key.item", "key.row", "text"), "decontam-items")
    own = _windows(items.select(F.col("row").alias("key"), "text"), words, None)
    own = stored(own.select(F.col("key").alias("row"), "n_windows", F.col("position").alias("item_at"), "hash",
                            F.col("slots").alias("item_slots"), "size"), "decontam-windows")
    sizes = sorted(r[0] for r in own.where("size is not null").select("size").distinct().collect())  # a number per length
    texts = docs.select(F.sha2(text_or_empty(text_col), 256).alias("key"), F.col(text_col).cast("string").alias("text"))
    found = stored(_windows(texts, words, bitmap_bytes(bitmap(own, "hash")), sizes).drop("n_windows", "size").distinct(), "decontam-found")
    match = candidates(found, own, similarity).join(own, "row").join(found, ["key", "hash"]) \
        .withColumn("shift", F.col("position") - F.col("item_at"))
    match = stored(match.select("key", "row", "n_windows", "shift", "item_at", "item_slots", "slots"), "decontam-matches")
    match = match.withColumn("pairs", F.expr("zip_with(item_slots, slots, (a, b) -> struct(a, b))"))
    cover = match.join(torn_pairs(match), ["key", "row", "shift"], "left") \
        .where(F.col("item_slots").eqNullSafe(F.col("slots")) | F.col("torn").isNull() | ~F.arrays_overlap("pairs", "torn")) \
        .select("key", "row", "n_windows", "item_at").distinct() \
        .groupBy("key", "row", "n_windows").agg((F.count(F.lit(1)) / F.col("n_windows")).alias("share"))
    hit = cover.where(F.col("share") >= similarity - 1e-9).join(items.select("row", "item"), "row")
    return stored(hit.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("item_ids"), F.max("share").alias("containment"))
                  .withColumnRenamed("key", "text_sha256"), "decontam-hits")


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, contaminated, item_ids, containment (0 if not contaminated)."""
    hits = contamination(docs, benchmark, text_col, item_col, item_text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text_or_empty(text_col), 256).alias("text_sha256"))
    return rows.join(hits, "text_sha256", "left").select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.expr("cast(array() as " + hits.schema["item_ids"].dataType.simpleString() + ")")).alias("item_ids"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; all columns unchanged."""
    (key,) = fresh(docs, "sha")
    hits = contamination(docs, benchmark, text_col, item_col, item_text_col).select(F.col("text_sha256").alias(key))
    return docs.withColumn(key, F.sha2(text_or_empty(text_col), 256)).join(hits, key, "left_anti").drop(key)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of the whole ``documents`` table by the whole ``benchmark`` table."""
    return flag_contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
