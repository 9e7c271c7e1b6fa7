"""Packing token ids into fixed windows by non-negative least squares over length combinations.

1. Every text is encoded whole (ids, then the end id) and cut into pieces: full windows from its start and
   one rest.  The pieces are stored with their place in their task, without the ids.
2. The histogram of piece lengths (``window`` rows at most, whatever the input) goes to the driver.
3. Shallow combinations that fill a window exactly (two lengths, three lengths with one from a short grid,
   one length repeated plus a rest) are the columns of a matrix; repeat counts that reproduce the histogram
   are solved by non-negative least squares (coordinate descent), rounded down and applied; what is left
   over is packed greedily, largest first, a pattern as often as it fits.  The plan is a table of at most
   a few entries per combination, so its size depends on the window alone.
4. A piece's rank among the pieces of its length is its place in its task plus the counts of the tasks
   before it; the rank selects sequence and offset from the plan.  No task sees all pieces of a length.

Encoding is exact: the tokenizer never joins text across ASCII white space and is case-insensitive, so ids
are kept per lower-cased word in a bounded cache; new words of Latin letters, which are one run for the
tokenizer, are encoded together and cut at the ends of runs; texts that may hold a special token are encoded whole.

Defined results: a null text is empty and has the end id only; repeated rows and null ids give pieces of
their own; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import bound_batches, load, stored

WINDOW, END_ID = 2048, 1
TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 700_000   # of a generation
WORDS_AT_ONCE, TEXT_AT_ONCE = 512, 4 << 20
RUN_END = "</w>"         # fixed value: ends the last token of a run of characters
GRID = 16            # lengths of the short grid that a combination of three may take its third from
SWEEPS = 25


# --- encoding ----------------------------------------------------------------------------

class WordEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Ids of words are kept in two generations of ``cached_words`` words at most: when the young one is full it becomes the
    old one, and only words that are met again come back from there.
    """

    def __init__(self, tokenizer: str = TOKENIZER, cached_words: int = CACHED_WORDS):
        from tokenizers import Tokenizer
        if not os.path.isabs(tokenizer):
            import public_tokenizers
            tokenizer = public_tokenizers.path(tokenizer)
        self.tokenizer = Tokenizer.from_file(str(tokenizer))
        self.cached_words, self.cache, self.old = cached_words, {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_run = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_run[[i for t, i in vocabulary.items() if t.endswith(RUN_END)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[bytes], runs: list[int]):
        """(word, ids) of words of so many runs, encoded together and cut where their runs end."""
        ids = np.frombuffer(b"".join(self._encode([b" ".join(words[i:i + WORDS_AT_ONCE]).decode()
                                                   for i in range(0, len(words), WORDS_AT_ONCE)])), "<u4")
        ends, last = np.flatnonzero(self.ends_run[ids]) + 1, np.cumsum(runs) - 1
        if not words or len(ends) != last[-1] + 1:  # not cut as expected: each by itself
            return zip(words, self._encode([w.decode() for w in words]))
        cuts, whole = [0, *(4 * ends[last]).tolist()], ids.tobytes()
        return zip(words, [whole[a:b] for a, b in zip(cuts, cuts[1:])])

    def _learn(self, words: list[bytes]) -> None:
        """Words of letters (lower-cased, of Latin scripts), perhaps with a point or comma behind them, are one
        or two runs and encoded together, all others one by one."""
        simple, runs, others = [], [], []
        for w in words:
            if (ids := self.old.get(w)) is not None:
                self.cache[w] = ids
                continue
            stem = w[:-1] if w[-1:] in (b".", b",") else w
            if not stem.isalpha():
                shown = stem.decode()
                if not shown.isalpha() or max(shown) >= "\u0250" or "\u0130" in shown:
                    others.append(w)
                    continue
            simple.append(w)
            runs.append(1 + (stem is not w))
        self.cache.update(self._together(simple, runs))
        self.cache.update(zip(others, self._encode([w.decode() for w in others])))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the words that are new in any of them are learned at once."""
        lows = [t.encode().lower() for t in texts]
        split = [None if b"<|" in low else low.split() for low in lows]
        words = set().union(*filter(None, split))
        new = words.difference(self.cache)
        if new and len(self.cache) + len(new) > self.cached_words:
            self.old, self.cache, new = self.cache, {}, words
        if new:
            self._learn(list(new))
        get = self.cache.__getitem__
        return [self._encode([t])[0] if words is None else b"".join(map(get, words)) for t, words in zip(texts, split)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def in_parts(texts: list[str], size: int = TEXT_AT_ONCE):
    """Runs of texts of ``size`` characters, or a single longer one."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > size:
            yield texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield texts[start:]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer: str) -> WordEncoder:
    """One encoder per Python worker, kept between tasks."""
    if tokenizer not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[tokenizer] = WordEncoder(tokenizer)
    return _ENCODERS[tokenizer]


def pieces(docs: DataFrame, id_col: str, text_col: str, window: int, tokenizer: str) -> DataFrame:
    """Stored pieces: doc_id, start, length, ids_crc32, doc_tokens, part and place (rank within part and length)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "part", "place")])
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches):
        encode, part = encoder(tokenizer).encode_all, TaskContext.get().partitionId()
        placed = np.zeros(window + 1, np.int64)
        for batch in batches:
            source, out = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, ids in enumerate(ids + end for part_of in in_parts(texts) for ids in encode(part_of)):
                n = len(ids) // 4
                for start in range(0, n, window):
                    length = min(window, n - start)
                    source.append(i)
                    out.append((start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), n, part, placed[length]))
                    placed[length] += 1
            columns = zip(*out) if out else [()] * 6
            yield pa.record_batch([batch.column("doc_id").take(pa.array(source, pa.int64())),
                                   *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return stored(rows.mapInArrow(cut, schema), "packing-pieces")


# --- plan --------------------------------------------------------------------------------

def combinations(present: np.ndarray, window: int, grid: int = GRID) -> list[tuple[tuple[int, int], ...]]:
    """Ways to fill a window exactly with a few of the lengths: tuples of (length, times), the longest
    lengths and the fewest pieces first (descent from zero then prefers them among equal solutions)."""
    have = set(int(x) for x in present if 0 < x < window)
    found = set()

    def add(*lengths: int) -> None:
        if sum(lengths) == window and have.issuperset(lengths):
            found.add(tuple(sorted({x: lengths.count(x) for x in lengths}.items())))

    thirds = sorted(have)[::max(1, len(have) // grid)][:grid + 1]
    for a in have:
        add(a, window - a)
        for b in thirds:
            add(a, b, window - a - b)
        times, rest = divmod(window, a)
        if not rest:
            found.add(((a, times),))
        elif rest in have:
            found.add(tuple(sorted(((a, times), (rest, 1)))))
    return sorted(found, key=lambda c: (sum(t for _, t in c), -c[-1][0], c))


def solve(columns: list, histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the columns with the least squared gap to the histogram (coordinate descent)."""
    gap, x = histogram.astype(float).tolist(), [0.0] * len(columns)
    norms = [sum(t * t for _, t in c) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, c in enumerate(columns):
            step = sum(gap[n] * t for n, t in c) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved += abs(step)
                for n, t in c:
                    gap[n] -= step * t
        if moved < 0.5:
            break
    return np.array(x)


def make_plan(histogram: np.ndarray, window: int) -> pd.DataFrame:
    """Plan rows (length, rank, times, sequence, offset): from that rank on, ``times`` pieces of the length go
    into each sequence from ``sequence`` on, at ``offset``."""
    left = histogram.astype(np.int64).copy()
    rank, sequence, rows = np.zeros(window + 1, np.int64), 0, []

    def place(pattern, repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length, times in sorted(pattern, reverse=True):
            rows.append((length, int(rank[length]), times, sequence, offset))
            rank[length] += times * repeats
            left[length] -= times * repeats
            offset += length * times
        sequence += repeats

    if left[window]:
        place(((window, 1),), int(left[window]))
    columns = combinations(np.flatnonzero(left), window)
    for pattern, x in zip(columns, solve(columns, left)):
        repeats = min(int(x), *(int(left[n]) // t for n, t in pattern))
        if repeats > 0:
            place(pattern, repeats)
    lengths = [int(n) for n in np.flatnonzero(left)]
    while lengths:  # greedy: largest first, each pattern as often as it fits
        room, pattern = window, []
        for n in reversed(lengths):
            if times := min(room // n, int(left[n])):
                pattern.append((n, times))
                room -= n * times
        place(pattern, min(int(left[n]) // t for n, t in pattern))
        lengths = [n for n in lengths if left[n]]
    return pd.DataFrame(rows, columns=["length", "rank", "times", "sequence", "offset"], dtype="int64")


def seats(plan: pd.DataFrame, length: np.ndarray, rank: np.ndarray) -> pd.DataFrame:
    """Sequence and offset of the pieces with these lengths and ranks."""
    plan = plan.sort_values(["length", "rank"], ignore_index=True)
    keys = plan["length"].to_numpy() << 48 | plan["rank"].to_numpy()
    at = np.searchsorted(keys, length << 48 | rank, "right") - 1
    row = {c: plan[c].to_numpy()[at] for c in plan.columns}
    turn, slot = np.divmod(rank - row["rank"], row["times"])
    return pd.DataFrame({"sequence_id": row["sequence"] + turn, "offset": row["offset"] + slot * length})


# --- operator ----------------------------------------------------------------------------

def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = pieces(docs, id_col, text_col, window, tokenizer)
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(window + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # window rows at most
        histogram[r.length] = r.n
    plan = make_plan(histogram, window)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")

    @F.pandas_udf("sequence_id long, offset long")
    def seat(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        return seats(plan, length.to_numpy(), rank.to_numpy())

    return cut.join(starts, ["part", "length"]) \
        .withColumn("seat", seat(F.col("length"), F.col("before") + F.col("place"))) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "seat.sequence_id", "seat.offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packing of the whole ``documents`` table into windows of 2048 ids."""
    return pack(load(spark, sf_dir, "documents"))
