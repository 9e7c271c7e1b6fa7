import random
import re

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from zonelake.llm.group_join import jaccard_components, op13_jaccard_join, prefix_length, shingle_set

SCHEMA = "doc_id bigint, text string, n bigint, digest string, prefix string"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def words_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    sets = [words_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def row(i, text):
    return (i, text, 0, "clash", "clash")


def changed(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def made(seed):
    rng = random.Random(seed)
    word = [f"w{i}" for i in range(300)]
    rows, n = [], 0
    for _ in range(25):                                  # families: copies changed by nothing, little, or too much
        base = [rng.choice(word) for _ in range(rng.choice([3, 5, 6, 12, 40, 120]))]
        for _ in range(rng.randrange(1, 9)):
            text = changed(rng, base, rng.choice([0, 0, 1, 1, 2, 4]))
            rows.append(row(n, text if rng.random() < 0.8 else text.upper().replace(" ", "\t\n ")))
            n += 1
    chain = [rng.choice(word) for _ in range(80)]        # every one similar to the next one only
    for _ in range(25):
        rows.append(row(n, " ".join(chain)))
        chain = chain[3:] + [rng.choice(word) for _ in range(3)]
        n += 1
    hot = [rng.choice(word) for _ in range(100)]         # a third of the rows: near copies
    for _ in range(70):
        rows.append(row(n, changed(rng, hot, rng.choice([1, 1, 2, 3]))))
        n += 1
    rows += [row(None, " ".join(hot)), row(None, "alone null id"), row(3, None), row(4, None), row(5, ""), row(6, " \n"), row(7, "Ä b"), row(8, "ä b")]
    rng.shuffle(rows)
    return rows + rows[:6]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = made(seed)
    assert result(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_members_of_a_group_need_not_be_linked(spark):
    rng = random.Random(9)
    common = [f"c{i}" for i in range(30)]
    rows = [row(i, " ".join(common + [f"x{i % 4}y{j}" for j in range(6 if i % 3 else 3)])) for i in range(30)]
    rng.shuffle(rows)
    assert result(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table_and_long_texts(spark):
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rng = random.Random(4)
    long = [f"w{rng.randrange(5000)}" for _ in range(60_000)]
    rows = [row(1, " ".join(long)), row(2, changed(rng, long, 300)), row(3, changed(rng, long, 9000)), row(4, "é" * 500_000), row(5, "é" * 500_000)]
    assert result(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_query_on_the_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert result(op13_jaccard_join(spark, SF_SMALL)) == brute([tuple(r) for r in table])


def test_sets_and_prefix_lengths():
    text = "A b  C d\te f a b c d e " * 3
    assert len(shingle_set(text)) == len(words_set(text))
    assert len(shingle_set("a b c")) == 1 and len(shingle_set("")) == len(shingle_set(None)) == len(shingle_set(" \x0b")) == 0
    assert (np.diff(shingle_set(text).astype(object)) > 0).all()
    for n in range(1, 200):   # two sets of similarity 4/5 share at least ceil(4 n / 5) of n
        assert prefix_length(n) == n - -(-4 * n // 5) + 1


def test_sketches_differ_by_no_more_bits_than_the_sets_by_shingles():
    from zonelake.llm.group_join import SKETCH, sketches
    rng = random.Random(7)
    base = [rng.randrange(2**64) for _ in range(400)]
    sets = [np.unique(np.array(base[k:] + [rng.randrange(2**64) for _ in range(m)], np.uint64)) for k, m in ((0, 0), (0, 1), (30, 0), (60, 50), (400, 0), (400, 9000))]
    made = sketches(np.concatenate(sets), np.array([len(x) for x in sets]))
    assert made.shape == (len(sets), SKETCH // 64)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            bits = np.unpackbits((made[i] ^ made[j]).view(np.uint8)).sum()
            assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2


def test_near_misses_of_a_family_are_not_moved_as_pairs(spark, monkeypatch):
    from zonelake.llm import group_join
    rng = random.Random(3)
    base = [f"f{i}" for i in range(110)]
    rows = [row(i, changed(rng, base, 5)) for i in range(150)]       # most pairs have a similarity of 0.5 to 0.75
    rows += [row(1000 + i, r[1] + " end") for i, r in enumerate(rows[:20])]
    moved = []
    whole = group_join.verified
    monkeypatch.setattr(group_join, "verified", lambda pairs, *a: moved.append(pairs.count()) or whole(pairs, *a))
    assert result(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert sum(moved) < 5 * len(rows), moved


def test_reading_stored_tables_keeps_no_direct_buffers(spark):
    """A column chunk of 16 MB is not held outside the heap by the threads that read it."""
    from pyspark.sql import functions as F

    from zonelake.llm.common import stored
    jvm = spark._jvm
    pools = jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean"))
    direct = lambda: sum(p.getMemoryUsed() for p in pools if p.getName() == "direct")
    table = stored(spark.range(0, 2_000_000, 1, 1).select(F.xxhash64("id").alias("h")), "join-direct")
    before = direct()
    assert table.agg(F.count("h")).first()[0] == 2_000_000
    assert direct() - before < 8 << 20
