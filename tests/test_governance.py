import datetime as dt

from pyspark.sql import functions as F

from zonelake.operators import governance as G

from tests.conftest import rows


def _edges(spark, pairs):
    return spark.createDataFrame([("z", s, "z", d) for s, d in pairs],
                                 "src_bucket string, src_object string, dst_bucket string, dst_object string")


def test_lineage_chain_branching_and_cycle(spark):
    # raw -> clean -> access ; other -> clean (branch) ; loop: access -> raw (cycle)
    e = _edges(spark, [("raw", "clean"), ("clean", "access"), ("other", "clean"), ("access", "raw")])
    starts = spark.createDataFrame([("z", "access")], "bucket string, object string")
    out = rows(G.lineage_trace(e, starts).select("object", "depth"), "depth", "object")
    assert out == [("clean", 1), ("other", 2), ("raw", 2)]


def test_lineage_of_a_long_chain_and_no_parents(spark):
    e = _edges(spark, [(f"n{i}", f"n{i+1}") for i in range(70)])
    starts = spark.createDataFrame([("z", "n70"), ("z", "n0")], "bucket string, object string")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = G.lineage_trace(e, starts)
        assert rows(out.select("start_object", "object", "depth"), "depth") == [("n70", f"n{70 - d}", d) for d in range(1, 71)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_lineage_edges_latest(spark):
    lin = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), ("a", "x"), ("b", "y"), "old"), (dt.datetime(2024, 2, 1), ("a", "x"), ("b", "y"), "new")],
        G.LINEAGE_SCHEMA)
    assert [r.transformation for r in G.lineage_edges(lin).collect()] == ["new"]


def test_metadata_catalog_latest_and_unknown(spark):
    recs = spark.createDataFrame([("b", "o", dt.datetime(2024, 1, 1), 10), ("b", "o", dt.datetime(2024, 3, 1), 12),
                                  (None, "p", dt.datetime(2024, 1, 1), 1)],
                                 "source_bucket string, object_name string, uploaded_at timestamp, rows int")
    assert rows(G.metadata_catalog(recs), "object_name") == [("b", "o", dt.datetime(2024, 3, 1), 12),
                                                             ("unknown", "p", dt.datetime(2024, 1, 1), 1)]


def test_profile_tables_counts_empty(spark):
    a = spark.range(5)
    b = spark.range(0).select("id", F.lit(1).alias("x"))
    got = rows(G.profile_tables({"a": a, "b": b}, "zone").select("object_name", "rows", "n_columns"), "object_name")
    assert got == [("a", 5, 1), ("b", 0, 2)]


def test_policy_tables(spark):
    grants = G.policy_grants(spark)
    assert grants.count() == 8 + 7 + 8 + 6 + 6
    assert rows(grants.where("zone = 'raw-ingestion-zone' AND action = 'delete'").select("role")) == [("admin",)]
    cls = G.classification_policy(spark)
    assert cls.where("classification = 'restricted'").count() == 3
    assert cls.where("classification = 'public'").first().mask_field is None
    assert G.role_members(spark).count() == 15
    z = {r.zone: (r.retention_days, r.retention_months) for r in G.zone_policy(spark).collect()}
    assert z["raw-ingestion-zone"] == (90, None) and z["govern-zone-security"] == (None, 60)
    assert z["govern-zone-metadata"] == (None, None)


def test_retention_report(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 5, 1),), (None,)], "ts timestamp")
    r = G.retention_report(df, "ts", "d", "raw-ingestion-zone", dt.datetime(2024, 6, 1)).first()
    assert (r.retention_policy, r.total_rows, r.expired_rows) == ("90 days", 3, 1)
    p = G.retention_report(df, "ts", "d", "govern-zone-metadata", dt.datetime(2030, 1, 1)).first()
    assert p.expired_rows == 0 and p.retention_policy == "permanent"
    y = G.retention_report(df, "ts", "d", "govern-zone-security", dt.datetime(2029, 3, 1)).first()
    assert y.expired_rows == 1                       # 5 years back from 2029-03-01 is 2024-03-01


def test_table_grants_literal_lookup(spark):
    t = spark.createDataFrame([("orders", "access-zone"), ("x", "nowhere")], "object_name string, zone string")
    g = G.table_grants(t)
    assert g.count() == 8 and g.where("role = 'business_user'").count() == 1


def test_mask_columns(spark):
    import hashlib
    df = spark.createDataFrame([("ana@x.es", "Ana"), (None, "Bo")], "email string, name string")
    out = G.mask_columns(df, ["email", "phone"]).collect()
    assert out[0].email == hashlib.sha256(b"ana@x.es").hexdigest() and out[0].name == "Ana"
    assert out[1].email is None


# --- history of a dataset ---------------------------------------------------------------------

def _records(spark, recs):
    """(source, target, minute, transformation); a source None means several sources."""
    made = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), ("multiple", None) if s is None else ("z", s), ("z", t), x)
            for s, t, m, x in recs]
    return spark.createDataFrame(made, G.LINEAGE_SCHEMA)


def _history(recs, start):
    """One start walked by hand: (seq, source, target, note) from the oldest record on."""
    picked = {}
    for s, t, m, x in recs:
        key = (m, "multiple" if s is None else "z", s is not None, s or "", x)
        if t not in picked or key < picked[t][0]:
            picked[t] = (key, s)
    out, seen = [], set()
    while start in picked and start not in seen:
        seen.add(start)
        source = picked[start][1]
        out.append((source, start, None))
        if source is None:
            out.append((None, None, G.MULTIPLE_NOTE))
        start = source
    return [(i + 1, *row) for i, row in enumerate(reversed(out))]


def _traced(spark, recs, starts):
    frame = spark.createDataFrame([("z", s) for s in starts], "bucket string, object string")
    out = {}
    for r in G.lineage_history(_records(spark, recs), frame).orderBy("start_object", "seq").collect():
        out.setdefault(r.start_object, []).append((r.seq, r.source_object, r.target_object, r.note))
    return out


def test_history_order_ties_note_and_missing_records(spark):
    recs = [("raw", "clean", 5, "later"), ("other", "clean", 1, "first"), ("b", "other", 2, "x"), ("a", "other", 2, "x"),
            (None, "a", 0, "merge"), ("clean", "access", 9, "publish"), ("nowhere", "island", 1, "y")]
    starts = ["access", "clean", "a", "island", "unknown", "access"]
    assert _traced(spark, recs, starts) == {s: _history(recs, s) for s in set(starts) - {"unknown"}}
    full = G.lineage_history(_records(spark, recs), spark.createDataFrame([("z", "access")], "bucket string, object string")).orderBy("seq").collect()
    assert [(r.transformation, r.note) for r in full] == [("merge", G.MULTIPLE_NOTE), ("merge", None), ("x", None), ("first", None), ("publish", None)]
    assert full[1].source_bucket == "multiple" and full[0].timestamp == full[1].timestamp


def test_history_of_cycles(spark):
    recs = [(f"c{i}", f"c{(i + 1) % 5}", i, "ring") for i in range(5)] + [("c2", "t1", 1, "in"), ("t1", "t2", 1, "in"), ("self", "self", 1, "loop"),
                                                                        ("self", "after", 2, "x"), ("p", "q", 1, "chain")]
    starts = ["c0", "c3", "t2", "t1", "self", "after", "q"]
    assert _traced(spark, recs, starts) == {s: _history(recs, s) for s in starts}


def test_history_of_a_long_chain_takes_few_jobs(spark):
    recs = [(f"n{i}", f"n{i + 1}", 0, "step") for i in range(500)] + [("loop", "loop", 0, "x")]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lineage-history", "chain")
    got = _traced(spark, recs[:-1], ["n500", "n250", "n0"])
    writes = [j for j in tracker.getJobIdsForGroup("lineage-history")]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {s: _history(recs, s) for s in ("n500", "n250")}
    assert len(got["n500"]) == 500 and writes


def test_history_empty_tables_and_null_names(spark):
    empty = spark.createDataFrame([], G.LINEAGE_SCHEMA)
    start = spark.createDataFrame([("z", "a")], "bucket string, object string")
    assert G.lineage_history(empty, start).count() == 0
    assert G.lineage_history(_records(spark, [("a", "b", 1, "x")]), start.limit(0)).count() == 0
    recs = spark.createDataFrame([(None, (None, "src"), ("z", "a"), None), (None, None, (None, "src"), "t")], G.LINEAGE_SCHEMA)
    got = G.lineage_history(recs, start).orderBy("seq").collect()
    assert [(r.target_object, r.note) for r in got] == [(None, G.MULTIPLE_NOTE), ("src", None), ("a", None)]
