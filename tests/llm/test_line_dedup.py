import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from zonelake.llm import line_dedup as D
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, removed string, hash int, line string"


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def slow(docs, min_chars=1, near_chars=4):
    """Texts after line dedup, for distinct (id, text) rows in order of id."""
    firsts, order = {}, sorted({(d is None, d if d is not None else 0, t) for d, t, *_ in docs if t is not None})
    for no_id, d, t in order:
        for k, raw in enumerate(t.split("\n")):
            line = raw.strip(" \t\r")
            if len(line) >= min_chars:
                firsts.setdefault(line, (no_id, d, t, k))
    seen, near = [], set()
    for line in firsts:
        if len(line) >= near_chars:
            if any(within_one(line, x) for x in seen):
                near.add(line)
            seen.append(line)
    out = []
    for d, t, *_ in docs:
        kept, n = [], 0
        for k, raw in enumerate(t.split("\n")) if t is not None else []:
            line = raw.strip(" \t\r")
            gone = len(line) >= min_chars and (line in near or firsts[line] != (d is None, d if d is not None else 0, t, k))
            n += gone
            if not gone:
                kept.append(raw)
        out.append((d, len(t.split("\n")) if t is not None else 0, n, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def same(spark, docs):
    got = D.dedup_lines(spark.createDataFrame(docs, SCHEMA))
    assert sorted([(r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in got.collect()], key=str) == slow(docs)


def test_deletion_variants_find_exactly_the_near_lines(spark):
    rnd = random.Random(4)
    lines = set()
    for size in [20, 21, 33, 64, 65, 100, 400, 1500]:
        for alphabet in ("ab", "aé漢x "):
            base = "".join(rnd.choices(alphabet, k=size)).strip() + "z"
            for _ in range(7):
                x = list(base)
                for _ in range(rnd.randint(0, 2)):
                    at = rnd.randrange(len(x))
                    kind = rnd.randrange(3)
                    x[at:at + (kind != 0)] = [] if kind == 1 else [rnd.choice(alphabet + "Q")]
                lines.add("".join(x).strip())
    docs = [(i, line, None, None, None) for i, line in enumerate(sorted(lines, key=hash))]
    same(spark, docs)


def test_defined_cases(spark):
    base = "the quick brown fox jumps over the lazy dog"
    docs = [(1, None, "x", 1, None), (2, "", None, None, "y"), (3, f"{base}\nshort\n  {base}\t\nshort\n" + base[:9], None, None, None),
            (4, f"{base[:-1]}\r\nunique line number four\n\n", None, None, None), (5, base + "!!", None, None, None),
            (6, base + "!", None, None, None), (7, "a" * 50_000 + "\n" + "a" * 50_001, None, None, None),
            (8, "one two three", None, None, None), (9, "one two threE", None, None, None), (10, "one two three", None, None, None),
            (None, base, None, None, None), (4, f"{base[:-1]}\r\nunique line number four\n\n", None, None, None)]
    same(spark, docs)
    frame = spark.createDataFrame(docs, SCHEMA)
    out = D.drop_duplicate_lines(frame)
    assert out.columns == frame.columns and out.count() == len(docs)
    by = {r.doc_id: r.text for r in out.collect()}
    assert by[1] is None and by[2] == "" and by[3] == f"{base}\nshort\n{base[:9]}" and by[9] == by[10] == ""
    same(spark, [])


def test_lines_of_every_length(spark):
    docs = [(1, "Yes.\nno\n\n\nYes.\nYes!\nno\nna", None, None, None), (2, "これは短い文です。\nYes.", None, None, None),
            (3, "これは短い文です。\nx\nfifteen letters", None, None, None), (4, "x\nfifteen lettars\ny\nabcd\nabc", None, None, None)]
    same(spark, docs)
    by = {r.doc_id: r.text for r in D.drop_duplicate_lines(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert by == {1: "Yes.\nno\n\n\nna", 2: "これは短い文です。", 3: "x\nfifteen letters", 4: "y\nabcd\nabc"}


def test_hot_line_in_a_third_of_the_documents(spark):
    docs = [(i, f"line {i} of its own with number {i * 7919}\n" + ("the very same boilerplate line everywhere" if i % 3 == 0 else "x"), None, None, None)
            for i in range(300)]
    same(spark, docs)


def test_no_python_in_the_plan(spark, monkeypatch):
    plans, keep = [], D.stored
    monkeypatch.setattr(D, "stored", lambda df, name: plans.append(df) or keep(df, name))
    plans.append(QUERIES["op7_line_dedup"](spark, SF_SMALL))
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op7_line_dedup"](spark, SF_SMALL).collect()
    assert sorted([tuple(r) for r in got], key=str) == slow(docs)
