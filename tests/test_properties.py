"""Property tests: operators against plain-Python brute force on random inputs (hot keys included)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from zonelake.operators import enrich, governance, warehouse
from zonelake.operators.dedup import dedup_keep_first

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 6), st.just(3))          # 3 is a hot key
rows_st = st.lists(st.tuples(keys, st.integers(-5, 5), st.sampled_from(["a", "b", None])), min_size=1, max_size=60)


@SETTINGS
@given(rows_st)
def test_keep_first_matches_python(spark, data):
    df = spark.createDataFrame(data, "k int, seq int, p string").repartition(3)
    got = {r.k: (r.seq, r.p) for r in dedup_keep_first(df, ["k"], ["seq"]).collect()}
    want = {}
    nf = (0, "")   # nulls sort first, as in Spark's ascending order

    def sort_key(r):
        return (r[1], nf if r[2] is None else (1, r[2]))
    for r in sorted(data, key=sort_key):
        want.setdefault(r[0], (r[1], r[2]))
    assert got == want


@SETTINGS
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=200), st.integers(1, 9))
def test_surrogate_keys_are_dense_ranks(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    got = {r.k: r.sk for r in warehouse.assign_surrogate_keys(df, ["k"], "sk", num_partitions=parts).collect()}
    want = {v: i + 1 for i, v in enumerate(sorted(set(values)))}
    assert got == want


pts = st.lists(st.tuples(st.floats(-50, 50), st.floats(-50, 50)), min_size=1, max_size=40)


@SETTINGS
@given(pts, st.lists(st.tuples(st.floats(-50, 50), st.floats(-50, 50)), min_size=1, max_size=12))
def test_nearest_matches_brute_force(spark, points, refs):
    pdf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "pid int, x double, y double")
    rdf = spark.createDataFrame([(j, x, y) for j, (x, y) in enumerate(refs)], "rid int, rx double, ry double")
    got = {r.pid: r.near for r in enrich.assign_nearest(pdf, rdf, "x", "y", "rid", "rx", "ry", "near").collect()}
    for i, (x, y) in enumerate(points):
        best = min(range(len(refs)), key=lambda j: ((x - refs[j][0]) * (x - refs[j][0]) +
                                                    (y - refs[j][1]) * (y - refs[j][1]), j))
        assert got[i] == best


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=25))
def test_lineage_depth_is_shortest_path(spark, edges):
    e = spark.createDataFrame([("b", str(s), "b", str(d)) for s, d in edges],
                              "src_bucket string, src_object string, dst_bucket string, dst_object string")
    starts = spark.createDataFrame([("b", "0")], "bucket string, object string")
    got = {r.object: r.depth for r in governance.lineage_trace(e, starts).collect()}
    # BFS over reversed edges in Python
    parents = {}
    for s, d in edges:
        parents.setdefault(d, set()).add(s)
    want, frontier, depth, seen = {}, {0}, 0, {0}
    while frontier:
        depth += 1
        nxt = {p for n in frontier for p in parents.get(n, ())} - seen
        for p in nxt:
            want[str(p)] = depth
        seen |= nxt
        frontier = nxt
    assert got == want


text = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("ab ',\\\"ñé;-_xyz0")), max_size=12))


@SETTINGS
@given(st.lists(st.tuples(text, st.one_of(st.none(), st.integers(-10**6, 10**6)), st.booleans()),
                min_size=1, max_size=30))
def test_sql_dump_roundtrip_adversarial_strings(spark, data):
    import tempfile

    from zonelake.sources import read_sql_dump, write_sql_dump
    rows_in = [(i, s, n, b) for i, (s, n, b) in enumerate(data)]
    df = spark.createDataFrame(rows_in, "id int, s string, n bigint, b boolean")
    path = tempfile.mkdtemp(prefix="zonelake-prop-dump-") + "/d"
    write_sql_dump(df, path, "t")
    back = read_sql_dump(spark, path, {"t": df.schema})["t"].drop("_file", "_ord", "_pos")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows_in)


cells = st.one_of(st.none(), st.integers(0, 4))


@SETTINGS
@given(st.lists(st.tuples(cells, cells), min_size=1, max_size=50))
def test_quality_counts_match_pandas(spark, data):
    import pandas as pd

    from zonelake.operators import quality as Q
    df = spark.createDataFrame(data, "a int, b int")
    got = {(r.check_type, r.column): r.bad_count
           for r in Q.run_checks(df, "t", Q.no_nulls("a", "b") + Q.unique("a", "b")).collect()}
    pdf = pd.DataFrame(data, columns=["a", "b"])
    for c in ("a", "b"):
        assert got[("no_nulls", c)] == int(pdf[c].isnull().sum())
        assert got[("unique", c)] == len(pdf) - int(pdf[c].nunique())


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5), st.just(2), st.just(2)), st.integers(0, 9)),
                min_size=1, max_size=80),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["p", "q"])), max_size=8),
       st.sampled_from(["inner", "left"]), st.integers(2, 5))
def test_salted_join_equals_plain_join(spark, big, small, how, buckets):
    from zonelake.operators.joins import salted_join
    b = spark.createDataFrame(big, "k int, v int")
    s = spark.createDataFrame(small, "k int, w string") if small else spark.createDataFrame([], "k int, w string")
    def order(t):
        return tuple((x is None, "" if x is None else x) for x in t)
    got = sorted((tuple(r) for r in salted_join(b, s, ["k"], how, buckets).collect()), key=order)
    want = sorted((tuple(r) for r in b.join(s, ["k"], how).collect()), key=order)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 50)),
                          st.sampled_from(["Baja", "Alta", "Otro", None])), min_size=1, max_size=40))
def test_hourly_profile_matches_pandas(spark, data):
    import datetime as dt

    import pandas as pd
    rows_in = [(None if h is None else dt.datetime(2024, 12, 1, h), n, lvl) for h, n, lvl in data]
    df = spark.createDataFrame(rows_in, "ts timestamp, n int, lvl string")
    prof = {r.hora: r for r in enrich.hourly_profile(df, "ts", ["n"], [], "lvl", {"Baja": 1, "Alta": 3}).collect()}
    pdf = pd.DataFrame(rows_in, columns=["ts", "n", "lvl"])
    pdf["lvl"] = pdf["lvl"].map({"Baja": 1, "Alta": 3})
    pdf["ts"] = pd.to_datetime(pdf["ts"])
    pdf["hora"] = pdf["ts"].dt.strftime("%H:%M:%S")
    want = pdf.dropna(subset=["ts"]).groupby("hora").agg({"n": "sum", "lvl": "mean"})
    assert set(prof) == set(want.index)
    for h, r in want.iterrows():
        assert prof[h].n == int(r["n"])
        assert (prof[h].lvl is None) if pd.isna(r["lvl"]) else abs(prof[h].lvl - r["lvl"]) < 1e-12
