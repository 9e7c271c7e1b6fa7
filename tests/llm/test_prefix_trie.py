import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonelake.llm.prefix_trie import RangeMin, op12_prefix_trie, prefix_trie, sequences, share_beginnings

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seq string, node string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).hexdigest()[:32]


def brute_sequences(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, digest(role, text), role, text))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}


def brute_rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members, ends = defaultdict(set), defaultdict(list)
    for c in sorted(convs):
        s = tuple(convs[c])
        for d in range(len(s) + 1):
            members[s[:d]].add(c)
        ends[s].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    out = []

    def below(p):
        yield p
        for q in children[p]:
            yield from below(q)

    for p, m in members.items():
        subtree = list(below(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]),
                    sum(not children[q] for q in subtree), sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in subtree if q),
                    hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()))
    return sorted(out, key=str)


def made(n, seed=5):
    rng = random.Random(seed)
    texts = ["a", "é", "", None, "long " * 20, "b"]
    rows = []
    for c in range(n):
        if c % 11 == 3:
            continue                                     # absent conversations, also among the first of five
        hot = rng.random() < 0.33
        for t in range(3 if hot else rng.randrange(0, 9)):
            if hot:
                rows.append((c, t, "user", "hot", "clash", "clash"))
            else:
                rows.append((c, rng.choice([None, t, t]) if t else t, rng.choice(["user", None, "assistant"]), rng.choice(texts), "x", None))
    return rows + rows[:5] + [(None, 1, "user", "nobody", None, None)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("partition_rows", [32768, 9, 1])
def test_query_matches_brute_force(spark, partition_rows):
    rows = made(150)
    convs = share_beginnings(sequences(spark.createDataFrame(rows, SCHEMA)))
    assert result(prefix_trie(convs, partition_rows)) == brute_trie(brute_rebuilt(brute_sequences(rows)))


@pytest.mark.parametrize("partition_rows", [64, 2])
def test_operator_on_plain_conversations(spark, partition_rows):
    rows = [(c, t, "user", "x" if t < 30 or c != 7 else "y", "", "") for c in (-3, 7, 8, 2**40) for t in range(40)]
    rows += [(c, 0, "user", "one", "", "") for c in range(100, 140)] + [(c, t, "user", "one", "", "") for c in (90, 91) for t in (0, 1)]
    assert result(prefix_trie(sequences(spark.createDataFrame(rows, SCHEMA)), partition_rows)) == brute_trie(brute_sequences(rows))


def test_empty_table_and_very_long_turns(spark):
    assert prefix_trie(sequences(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = [(c, t, "r", "é" * 200_000 + str(t), None, None) for c in range(4) for t in range(3)]
    assert result(prefix_trie(sequences(spark.createDataFrame(rows, SCHEMA)), 1)) == brute_trie(brute_sequences(rows))


def test_query_on_the_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert result(op12_prefix_trie(spark, SF_SMALL)) == brute_trie(brute_rebuilt(brute_sequences([tuple(r) for r in table])))


def test_range_minima():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.integers(0, 6, n)
        table = RangeMin(values)
        at, least = rng.integers(0, n + 1, 200), rng.integers(0, 7, 200)
        expected = [next((j for j in range(a, n) if values[j] < v), n) for a, v in zip(at, least)]
        assert table.right_extent(at, least).tolist() == expected
        at = np.minimum(at, n - 1)
        assert table.left_extent(at, least).tolist() == [next((j for j in range(a, -1, -1) if values[j] < v), -1) for a, v in zip(at, least)]
        right = np.array([rng.integers(a + 1, n + 1) for a in at])
        assert table.of(at, right).tolist() == [values[a:b].min() for a, b in zip(at, right)]
