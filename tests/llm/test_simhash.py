import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonelake.llm import simhash as S
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, component_id string, fp int"


def slow_print(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, radius=3):
    prints = [slow_print(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((r[0], f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


def test_fingerprint_matches_the_definition():
    rnd = random.Random(3)
    texts = [None, "", " \t\n", "One", "one two", "A b c d", "É a B", "x  y\r\nz x y z"]
    texts += [" ".join(rnd.choices(["ab", "C", "dé", "f\x0bg"], k=rnd.randint(1, 60))) for _ in range(40)]
    for t in texts:
        assert S.fingerprint(t) == slow_print(t)
    long = "word " * 200_000
    assert S.fingerprint(long) == slow_print("word word word")


def test_hash_is_sparks_xxhash64(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0] & (2**64 - 1) == xxhash.xxh64_intdigest("a b é".encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_groups_equal_brute_force(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    prints, bucket = [], []
    for b in range(6):
        for _ in range([1, 2, 70, 200, 3, 40][b]):
            x = int(rng.choice(centres))
            for bit in rng.choice(64, rng.integers(0, 9), replace=False):
                x ^= 1 << int(bit)
            prints.append(x)
            bucket.append(b)
    prints, bucket = np.array(prints, np.uint64), np.array(bucket)
    label = S.bucket_groups(prints, bucket, radius, pairs_at_once=256)
    want = np.arange(len(prints))
    for i in range(len(prints)):
        for j in range(i):
            if bucket[i] == bucket[j] and bin(int(prints[i]) ^ int(prints[j])).count("1") <= radius and want[i] != want[j]:
                a, b = min(want[i], want[j]), max(want[i], want[j])
                want[want == b] = a
    assert (label == want).all()


def test_one_block_of_two():
    prints = np.array([5, 7], np.uint64)
    assert S.bucket_groups(prints, np.zeros(2, int), 3).tolist() == [0, 0] and S.bucket_groups(prints[:1], np.zeros(1, int), 3).tolist() == [0]


def near_rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = rnd.choices(words, k=150)
        for _ in range(6):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append((len(rows), " ".join(copy), None, g))
    return rows + [(500, None, "x", 1), (None, "", None, 1), (7, rows[7][1], None, 0), (None, "alone here", None, None)]


@pytest.mark.parametrize("bucket", [S.BUCKET, 3])
def test_groups_equal_brute_force(spark, bucket):
    rows = near_rows()
    got = S.simhash_groups(spark.createDataFrame(rows, SCHEMA), bucket=bucket)
    assert sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()], key=str) == slow_groups(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert S.simhash_groups(none).count() == 0 and S.drop_near_duplicates(none).columns == none.columns


def test_one_row_of_each_group_stays(spark):
    rows = near_rows()
    kept = [r for r in S.drop_near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = {c if c is not None else d for d, _, c in slow_groups(rows)}
    assert len(kept) == len({r.doc_id for r in kept}) and {r.doc_id for r in kept} == want
    assert all(tuple(r) in rows for r in kept)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_simhash_near_dedup"](spark, SF_SMALL).collect()
    assert sorted([tuple(r) for r in got], key=str) == slow_groups(rows)
