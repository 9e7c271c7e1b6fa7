import random
from collections import Counter

import pytest

from tests.conftest import SF_SMALL
from zonelake.llm import token_counts as C
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, source string, field string, f0 string"


def slow(rows, rule):
    """Section rows by walking over the characters of every token."""
    encoding, out = C.spans_for(C.VOCABULARY).encoding, []
    for doc, text, source, *_ in rows:
        sections = [("source", 0, source or "")] + [("text", k, x) for k, x in enumerate((text or "").split("\n"))]
        whole = "\n".join(s[2] for s in sections)
        owner = []
        for k, s in enumerate(sections):
            owner += [k] * (len(s[2]) + (k < len(sections) - 1))
        characters = [i for i, c in enumerate(whole) for _ in c.encode()]
        counts, crossing, at = Counter(), Counter(), 0
        for token in encoding.encode_ordinary(whole):
            size = len(encoding.decode_single_token_bytes(token))
            held = sorted(set(characters[at:at + size]))
            at += size
            per = Counter(owner[c] for c in held)
            crossing[owner[held[0]]] += len(per) > 1
            if rule == "split":
                for k, n in per.items():
                    counts[k] += n / len(held)
            else:
                counts[{"first": owner[held[0]], "last": owner[held[-1]], "longest": max(per, key=lambda k: (per[k], -k))}[rule]] += 1
        assert at == len(whole.encode())
        start = 0
        for k, (field, number, value) in enumerate(sections):
            end = start + len(value) + (k < len(sections) - 1)
            out.append((doc, field, number, start, end, round(float(counts[k]), 6), crossing[k]))
            start = end
    return sorted(out, key=str)


def fast(frame, rule):
    got = C.token_counts(frame, ["source", "text"], "text", rule=rule).collect()
    return sorted([(r.doc_id, r.field, r.section, r.start_char, r.end_char, round(r.n_tokens, 6), r.n_crossing) for r in got], key=str)


def odd_rows():
    rnd = random.Random(2)
    rows = [(1, None, None, "x", "y"), (2, "", "s", None, None), (3, "\n\n\n", "", None, None), (None, "a\n\n\nb", "s\n", None, None),
            (4, "é漢🙂 \n é\n🙂🙂", "ü", None, None), (4, "é漢🙂 \n é\n🙂🙂", "ü", None, None), (5, "word " * 40_000 + "\n\n end", "s", None, None)]
    return rows + [(i, "".join(rnd.choices("ab \n\né🙂.,", k=rnd.randint(0, 80))), rnd.choice(["src", "a b"]), None, None) for i in range(10, 60)]


@pytest.mark.parametrize("rule", C.RULES)
def test_equals_brute_force(spark, rule):
    assert fast(spark.createDataFrame(odd_rows(), SCHEMA), rule) == slow(odd_rows(), rule)


def test_empty_table_and_unknown_rule(spark):
    assert fast(spark.createDataFrame([], SCHEMA), "first") == []
    with pytest.raises(ValueError):
        fast(spark.createDataFrame([], SCHEMA), "middle")


def test_query_counts_every_token_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = Counter()
    for r in QUERIES["op4_token_counts"](spark, SF_SMALL).collect():
        got[r.doc_id] += r.n_tokens
    encode = C.spans_for(C.VOCABULARY).encoding.encode_ordinary
    assert got == {d.doc_id: len(encode(f"{d.source}\n{d.lang}\n{d.text}")) for d in docs}
