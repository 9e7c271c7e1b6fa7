import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_MID
from zonelake.llm import suffix_dedup as D
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, t1 string, n_bytes int"


def slow(rows, threshold):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(hash(t[p:p + threshold]) for t in texts for p in range(len(t) - threshold + 1))
    out = []
    for (doc, *_), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - threshold + 1):
            if seen[hash(t[p:p + threshold])] > 1:
                gone[p:p + threshold] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fast(spark, rows, threshold, gram):
    got = D.dedup_passages(spark.createDataFrame(rows, SCHEMA).repartition(3), threshold=threshold, gram=gram)
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()], key=str)


def planted(seed, threshold):
    rnd = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdefghij é漢"
    make = lambda n: "".join(rnd.choices(alphabet, k=n))
    passages = [make(rnd.choice([threshold // 2, threshold - 1, threshold, threshold + 1, 2 * threshold, 5 * threshold])) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts.append(make(rnd.randint(0, threshold)))
            if rnd.random() < 0.6:
                p = rnd.choice(passages)
                cut = rnd.randint(0, len(p))
                parts.append(rnd.choice([p, p[:cut], p[cut:], p[:cut] + make(1) + p[cut:]]))
        rows.append((i, "".join(parts), None, None))
    rows += [(100, "a" * 10 * threshold, None, None), (101, "ab" * 3 * threshold, None, 1), (102, rows[3][1], "x", None),
             (103, rows[3][1], None, None), (104, None, None, None), (105, "", None, None), (None, rows[5][1], None, None)]
    return rows + [rows[7]]


@pytest.mark.parametrize("seed,threshold,gram,bucket", [(1, 20, 4, 3), (2, 20, 8, 32768), (3, 37, 5, 1), (4, 200, 32, 32768)])
def test_equals_brute_force(spark, monkeypatch, seed, threshold, gram, bucket):
    monkeypatch.setattr(D.repeated_spans, "__defaults__", (*D.repeated_spans.__defaults__[:-1], bucket))
    rows = planted(seed, threshold)
    assert fast(spark, rows, threshold, gram) == slow(rows, threshold)


def test_chunks_of_long_texts(monkeypatch):
    rnd = random.Random(9)
    text = bytes(rnd.choices(b"abc", k=5000))
    texts = [text, b"", text[100:900], bytes(rnd.choices(b"abcd", k=300))]
    monkeypatch.setattr(D, "CHUNK", 512)
    monkeypatch.setattr(D, "_TABLES", [])
    small = {(int(t), int(p)) for b in D.bunches(texts, 8, 40) for t, f, e in zip(b["text"], b["first"], b["last"]) for p in range(f, e + 1)}
    assert small == {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 39)}
    whole = [texts[0][:950], *texts[2:]]
    owner, start, d1, d2 = D.windows(whole, 40)
    by_window = {}
    for t, p, keys in zip(owner, start, zip(d1.tolist(), d2.tolist())):
        assert by_window.setdefault(whole[t][p:p + 40], keys) == keys
    assert len(set(by_window.values())) == len(by_window)
    alone = Counter(whole[t][p:p + 40] for t, p in zip(owner, start))
    assert D.repeated((d1, d2), np.ones(len(d1), int)).tolist() == [alone[whole[t][p:p + 40]] > 1 for t, p in zip(owner, start)]


def test_empty_table_and_bad_parameters(spark):
    assert fast(spark, [], 200, 32) == []
    with pytest.raises(ValueError):
        fast(spark, [], 200, 200)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op8_suffix_dedup"](spark, SF_MID).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == slow(rows, 200)
