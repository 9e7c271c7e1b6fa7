import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tests.conftest import SF_MID
from zonelake.llm import packing as P
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, length string, sequence_id int"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_cached_encoding_equals_the_tokenizer(plain):
    rnd = random.Random(1)
    alphabet = list("abzAZ  \t\n.,'’!?09éÉßΣΑσ‐́  ẞÅ漢字🙂<|>_") + ["'s", "'LL ", "don't", "<|endoftext|>", "<|ENDOFTEXT|>"]
    latin = [chr(c) for c in range(0xA1, 0x250)] + list("abcDEF ,.")
    enc = P.WordEncoder(cached_words=50)
    for text in ("".join(rnd.choices(latin, k=rnd.randint(1, 30))) for _ in range(600)):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == plain(text), text
    for _ in range(600):
        text = "".join(rnd.choices(alphabet, k=rnd.randint(0, 60)))
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == plain(text), text


def check(rows, got, plain, window=P.WINDOW):
    """Every id lies in exactly one piece; sequences are gapless and within the window."""
    want, seen = defaultdict(list), defaultdict(list)
    for doc, text, *_ in rows:
        want[doc].append(tuple(plain(text)) + (1,))
    by_sequence = defaultdict(list)
    for r in got:
        seen[(r.doc_id, r.doc_tokens)].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc, texts in want.items():
        for ids in set(texts):
            own = [r for r in seen[(doc, len(ids))]]
            spans = sorted((r.start, r.length, r.ids_crc32) for r in own)
            expect = sorted((s, min(window, len(t) - s), zlib.crc32(np.array(t[s:s + window], "<u4").tobytes()))
                            for t in texts if len(t) == len(ids) for s in range(0, len(t), window))
            assert spans == expect
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= window
    assert len(got) == sum(-(-len(t) // window) for texts in want.values() for t in texts)
    return sum(r.length for r in got) / (window * max(1, len(by_sequence)))


def test_defined_cases(spark, plain):
    rows = [(1, None, "x", 1), (2, "", None, 2), (3, "Hello, world. " * 3000, None, None), (None, "a b", None, None),
            (4, "same text", None, None), (4, "same text", None, None)]
    check(rows, P.pack(spark.createDataFrame(rows, SCHEMA)).collect(), plain)
    assert P.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_length(spark, plain):
    rows = [(i, "one two three" if i % 3 else "word " * (i % 50), None, None) for i in range(900)]
    fill = check(rows, P.pack(spark.createDataFrame(rows, SCHEMA).repartition(7), window=64).collect(), plain, 64)
    assert fill > 0.97


def best_fit(histogram, window):
    free, bins = np.zeros(window + 1, int), 0
    for n in range(window, 0, -1):
        for _ in range(int(histogram[n])):
            room = np.flatnonzero(free[n:])
            if len(room):
                free[n + room[0]] -= 1
                free[room[0]] += 1
            else:
                bins += 1
                free[window - n] += 1
    return bins


@pytest.mark.parametrize("seed", range(3))
def test_plan_seats_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    window = [32, 100, 257][seed]
    histogram = np.concatenate([[0], rng.integers(0, [5, 300, 40][seed], window)]) * (rng.random(window + 1) < 0.8)
    plan = P.make_plan(histogram, window)
    length = np.repeat(np.arange(window + 1), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram])
    seat = P.seats(plan, length, rank)
    used = defaultdict(list)
    for s, o, n in zip(seat.sequence_id, seat.offset, length):
        used[s].append((o, n))
    assert set(used) == set(range(len(used)))
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= window
    assert len(used) <= 1.04 * best_fit(histogram, window) + 1


def test_least_squares_reproduces_a_histogram_it_can_fill():
    columns = P.combinations(np.array([10, 30, 50, 70, 90, 20]), 100)
    want = np.zeros(101)
    for j, c in enumerate(columns):
        for n, t in c:
            want[n] += t * (j + 3)
    x = P.solve(columns, want, 2000)
    again = np.zeros(101)
    for j, c in enumerate(columns):
        for n, t in c:
            again[n] += t * x[j]
    assert (x >= 0).all() and np.abs(again - want).max() < 1


def test_query_packs_every_id_with_little_padding(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    fill = check(rows, QUERIES["op9_packing"](spark, SF_MID).collect(), plain)
    assert fill > 0.97
