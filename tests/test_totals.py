import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from zonelake.functions.totals import grouped


def _decimal(x, shown):
    """The number that a double stands for: with four or ten decimals if that reads back as it, else the one it prints as."""
    printed = Decimal(shown)
    if abs(x) < 9e11 and round(x * 10_000) / 10_000 == x:
        return Fraction(round(x * 10_000), 10_000)
    with localcontext() as c:
        c.prec = 60
        ten = printed.quantize(Decimal("1e-10"), ROUND_HALF_UP) if abs(x) < 1e15 else None
    return Fraction(ten if ten is not None and float(ten) == x else printed)


def _exact(pairs):
    """The double nearest to the exact sum of (value, printed value)."""
    known = [v for v, _ in pairs if v is not None]
    if not known:
        return None
    if any(math.isnan(v) or math.isinf(v) for v in known):
        return sum(v for v in known if math.isnan(v) or math.isinf(v))
    return float(sum((_decimal(*p) for p in pairs if p[0] is not None), Fraction(0)))


def _same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


CASES = {
    "small": [1e-11] * 1000,
    "far apart": [1e30, 1.0, -1e30],
    "huge and tiny": [1e30, 1.0],
    "limits": [1.7976931348623157e308, -1.7976931348623157e308, 5e-324],
    "subnormal": [5e-324] * 3 + [2.2250738585072014e-308],
    "cancel": [1e16, 1.0, -1e16, 1e-300],
    "negative": [-0.1, -0.2, -1e-12, -3e22],
    "money": [0.1, 0.2, 1234567.89, -0.3],
    "zeros": [0.0, -0.0],
    "nulls": [None, None],
    "some nulls": [None, 2.5, None],
    "nan": [1.0, float("nan")],
    "inf": [float("inf"), 1e300],
    "both infs": [float("inf"), float("-inf")],
    "edges": [8.9999999999999e11, 9e11, -899999999999.1234, 0.00005, -0.0001, 0.1 + 0.2, 123456789.12345, 999999999999999.9, 1e15, -1e15, 0.1234567891, 0.12345678912],
}


def test_totals_equal_rational_sums(spark):
    rng = random.Random(2)
    cases = dict(CASES)
    for k in range(30):
        cases[f"random {k}"] = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-320, 300) for _ in range(40)]
        cases[f"money {k}"] = [round(rng.uniform(-1e6, 1e6), rng.choice([0, 2, 4, 12])) for _ in range(60)]
    rows = [(k, v) for k, vs in cases.items() for v in vs]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r for r in grouped(df, ["k"], {"t": "v"}, {"n": ("count", F.lit(1)), "m": ("max", "v")}, {"known": "t"}, {"mean": "t"}).collect()}
    printed = {}
    for r in df.select("k", "v", F.col("v").cast("string").alias("s")).collect():
        printed.setdefault(r.k, []).append((r.v, r.s))
    for k, vs in cases.items():
        want = _exact(printed[k])
        assert _same(got[k].t, want), (k, got[k].t, want)
        n = sum(v is not None for v in vs)
        assert got[k].n == len(vs) and got[k].known == n
        assert _same(got[k]["mean"], want / n if n else None)
    assert got["small"].t == 1e-8 and got["huge and tiny"].t == 1e30 and got["far apart"].t == 1.0


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_same_bits_at_any_partitioning(spark, parts):
    df = spark.range(3000).select((F.col("id") % 4).alias("k"), (F.sin("id") * F.pow(F.lit(10.0), F.col("id") % 60 - 30)).alias("v"),
                                  F.cos("id").alias("w"))
    want = {r.k: (r.a, r.b) for r in grouped(df.coalesce(1), ["k"], {"a": "v", "b": "w"}).collect()}
    values = df.select("k", "v", "w", F.col("v").cast("string").alias("vs"), F.col("w").cast("string").alias("ws")).collect()
    assert {r.k: (r.a, r.b) for r in grouped(df.repartition(parts), ["k"], {"a": "v", "b": "w"}).collect()} == want
    assert want == {k: (_exact([(r.v, r.vs) for r in values if r.k == k]), _exact([(r.w, r.ws) for r in values if r.k == k])) for k in range(4)}


def test_no_keys_no_rows_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1.5), (None, 2.0), ("a", None)], "k string, v double")
    assert {r.k: r.t for r in grouped(df, ["k"], {"t": "v"}).collect()} == {None: 3.5, "a": None}
    empty = grouped(df.limit(0), [], {"t": "v"}, {}, {"n": "t"}).collect()
    assert [(r.t, r.n) for r in empty] == [(None, 0)]
    assert grouped(df.limit(0), ["k"], {"t": "v"}).count() == 0
