import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from zonelake.llm.divergence import Lookup, _pack, build_shard, divergence, perfect_hash, terms_of, windows, word_hashes

SCHEMA = "doc_id bigint, text string, lang string, source string, value string, g string"
PATTERN = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least_docs, smoothing=5, top=50, scale=10**9):
    docs = [((t or ""), (lg or ""), (s or "")) for _, t, lg, s, *_ in rows]
    frequency = defaultdict(Counter)
    words = defaultdict(Counter)
    for text, lang, source in docs:
        found = [w.translate(LOWER) for w in PATTERN.findall(text)]
        frequency[lang].update(set(found))
        words[lang, source].update(found)
    out = []
    for lang in {k[0] for k in words}:
        kept = sorted(t for t, n in frequency[lang].items() if n >= least_docs)
        sources = [s for lg, s in words if lg == lang]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + scale * (count[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        p = {s: shares(words[lang, s]) for s in sources}
        q = shares(sum((words[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if words[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def made(n, seed=3):
    rng = random.Random(seed)
    base = ["alpha", "Beta", "éa", "ÉA", "gamma's", "x", "日本語", "tail" * 20, "don't", "a-b", "ſ", "İx", "K"] + [f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}" for i in range(40)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "", "ü"])
        text = None if i % 17 == 0 else " ,\n"[i % 3].join(rng.choice(base) for _ in range(rng.randrange(0, 60)))
        rows.append((i % 50, text, lang, source, "clash", "clash"))
    return rows + rows[:7]


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("bounds", [{}, {"head_bytes": 600}, {"head_bytes": 0}, {"shard_keys": 4, "source_block": 2, "term_block": 5}])
def test_matches_brute_force(spark, bounds):
    rows = made(260)
    assert result(divergence(spark.createDataFrame(rows, SCHEMA), least_docs=9, **bounds)) == brute(rows, 9)


def test_no_term_kept_empty_table_and_long_texts(spark):
    rows = made(30)
    assert result(divergence(spark.createDataFrame(rows, SCHEMA), least_docs=1000)) == brute(rows, 1000)
    assert any(r[2] == "pair" and r[4] == 0 for r in brute(rows, 1000))
    assert divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    long = [(1, "ab cd " * 500_000 + "é" * 300_000, "en", "a", "", ""), (2, "cd", "en", "b", "", ""), (2, "cd", "en", "b", "", "")]
    assert result(divergence(spark.createDataFrame(long, SCHEMA), least_docs=1)) == brute(long, 1)


def test_perfect_hash_is_minimal_and_finds_its_keys_only():
    terms = sorted({bytes(random.Random(i).choices(b"abcdef", k=1 + i % 30)) for i in range(4000)})
    h = word_hashes(*_pack(terms))
    assert len(set(h.tolist())) == len(terms)
    assert sorted(perfect_hash(h)[1].tolist()) == list(range(len(terms)))

    class Row:
        def __init__(self, made):
            self.__dict__.update(made, n_shards=2)

    halves = [(h >> np.uint64(40)) % np.uint64(2) == s for s in (0, 1)]
    lookup = Lookup([Row(build_shard("en", s, [t for t, m in zip(terms, half) if m], h[half])) for s, half in enumerate(halves)])
    buffer, starts, lengths = _pack(terms + [b"zz" + t for t in terms])
    zero, two = np.zeros(len(starts), np.int64), np.full(len(starts), 2)
    slots = lookup.slots(buffer, starts, lengths, zero, two)
    assert sorted(slots[:len(terms)].tolist()) == list(range(len(terms))) and (slots[len(terms):] == -1).all()


def test_terms_and_windows():
    text = "Ab-c É日本 \x7f{K}'s z"
    assert [t.decode() for t in terms_of(text)] == [w.translate(LOWER) for w in PATTERN.findall(text)]
    blanked = b"aa bbb  cccccccccc d " * 50
    assert b"".join(windows(blanked, 7)) == blanked
    assert [w for p in windows(blanked, 7) for w in p.split()] == blanked.split()
