import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from zonelake.llm.components import components
from zonelake.llm.exact_dedup import exact_dedup, heavy_winners, digest_rows, op2_exact_dedup

SCHEMA = "doc_id bigint, text string, kept boolean, group_size string"


def brute(rows):
    groups = {}
    for i, (doc, text, *_) in enumerate(rows):
        groups.setdefault(text or "", []).append((doc is not None, doc or 0, i))
    out = []
    for text, members in groups.items():
        best = max(m[:2] for m in members)
        keep = best[1] if best[0] else None
        out += [((m[1] if m[0] else None), keep, len(members), hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


CASES = {
    "empty": [],
    "nulls": [(1, None, True, "x"), (2, "", None, None), (None, None, False, ""), (3, "a", None, None)],
    "ties": [(1, "a", None, None)] * 3 + [(2, "b", None, None)] * 2 + [(None, "c", None, None)] * 2,
    "long": [(1, "é" * 200_000, None, None), (2, "é" * 200_000, None, None), (3, "é" * 199_999, None, None)],
    "hot": [(i, "hot" if i % 3 else f"t{i}", None, None) for i in range(600)],
}


@pytest.mark.parametrize("case", CASES)
def test_matches_brute_force(spark, case):
    got = exact_dedup(spark.createDataFrame(CASES[case], SCHEMA), heavy_items=8).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == brute(CASES[case])
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_hot_digest_is_a_verified_heavy_winner(spark):
    rows = digest_rows(spark.createDataFrame(CASES["hot"], SCHEMA))
    assert [(r.group_size, r.winner.doc_id) for r in heavy_winners(rows, 8).collect()] == [(400, 599)]


def test_plan_has_no_python(spark):
    plan = op2_exact_dedup(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_components_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
