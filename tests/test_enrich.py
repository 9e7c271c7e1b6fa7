import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonelake.operators import enrich

from tests.conftest import rows


def test_left_enrich_no_fanout_and_null_keys(spark):
    usage = spark.createDataFrame([(1, 10), (2, 20), (None, 30), (9, 40)], "aparcamiento_id int, v int")
    info = spark.createDataFrame([(1, "A", 1), (1, "A-dup", 2), (2, "B", 1), (None, "N", 1)],
                                 "aparcamiento_id int, nombre string, seq int")
    out = enrich.left_enrich(usage, info, ["aparcamiento_id"], ["seq"])
    assert out.count() == 4
    got = {r.v: r.nombre for r in out.collect()}
    assert got == {10: "A", 20: "B", 30: None, 40: None}


def test_hourly_profile_pandas_semantics(spark):
    ts = [dt.datetime(2024, 12, 1, 8, 0), dt.datetime(2024, 12, 1, 8, 0), dt.datetime(2024, 12, 1, 9, 0), None]
    df = spark.createDataFrame([(ts[0], 10, None, 50, "Baja"), (ts[1], 20, None, None, "Alta"),
                                (ts[2], 5, None, 30, "Desconocida"), (ts[3], 100, 1, 10, "Baja")],
                               "fecha_hora timestamp, total int, motos int, vel int, nivel string")
    prof = enrich.hourly_profile(df, "fecha_hora", ["total", "motos"], ["vel"], "nivel",
                                 {"Baja": 1, "Moderada": 2, "Alta": 3, "Muy Alta": 4})
    assert rows(prof) == [("08:00:00", 30, 0, 50.0, 2.0), ("09:00:00", 5, 0, 30.0, None)]


def test_top_hours_ties_by_time(spark):
    prof = spark.createDataFrame([("10:00:00", 2.0, 5, 1, 4), ("08:00:00", 2.0, 7, 3, 3), ("09:00:00", None, 1, 1, 0),
                                  ("11:00:00", 3.0, 9, 0, 9)], "hora string, nivel double, total int, coches int, buses int")
    out = rows(enrich.top_hours(prof, "nivel", "total", ["coches", "buses"], n=3))
    assert out == [("11:00:00", 3.0, 9, "buses"), ("08:00:00", 2.0, 7, "coches"), ("10:00:00", 2.0, 5, "buses")]


def _brute(points, refs):
    out = {}
    for pid, x, y in points:
        if x is None or y is None or x != x or abs(y) == float("inf"):
            out[pid] = None
            continue
        out[pid] = min((r for r in refs if r[1] == r[1]), key=lambda r: ((x - r[1]) * (x - r[1]) + (y - r[2]) * (y - r[2]), r[0]))[0]
    return out


@pytest.mark.parametrize("n_refs,skewed", [(1, False), (5, False), (60, False), (40, True)])
def test_nearest_reference_matches_brute_force(spark, n_refs, skewed):
    rnd = random.Random(n_refs)
    refs = []
    for i in range(n_refs):
        if skewed and i < n_refs // 2:          # half the references packed in one tiny spot
            refs.append((i, 40.4 + rnd.random() * 1e-4, -3.7 + rnd.random() * 1e-4))
        else:
            refs.append((i, 40.3 + rnd.random() * 0.2, -3.8 + rnd.random() * 0.2))
    pts = [(j, 40.2 + rnd.random() * 0.4, -3.9 + rnd.random() * 0.4) for j in range(400)]
    pts += [(1000, refs[0][1], refs[0][2]), (1001, None, -3.7), (1002, 45.0, 1.0), (1004, float("nan"), 5.0), (1005, 40.0, float("inf"))]
    refs += [(900 + i, refs[0][1], refs[0][2]) for i in range(200)] + [(2000, float("nan"), 1.0)]   # one place, many ids   # exact hit, null, far away
    if n_refs > 1:                                                                  # equidistant point: lowest id
        a, b = refs[0], refs[1]
        pts.append((1003, (a[1] + b[1]) / 2, (a[2] + b[2]) / 2))
    pdf = spark.createDataFrame(pts, "pid int, lat double, lon double")
    rdf = spark.createDataFrame(refs, "rid int, rlat double, rlon double")
    out = enrich.assign_nearest(pdf, rdf, "lat", "lon", "rid", "rlat", "rlon", "distrito_id")
    got = {r.pid: r.distrito_id for r in out.collect()}
    want = _brute(pts, refs)
    mism = [k for k in want if got[k] != want[k]]
    # the midpoint may be off by one ulp in either engine; everything else must be exact
    assert [k for k in mism if k != 1003] == []
    assert out.count() == len(pts)


def test_nearest_reference_has_no_cartesian_product(spark):
    pdf = spark.range(50).select(F.col("id").alias("pid"), (F.col("id") / 10).alias("x"), (F.col("id") % 7).alias("y"))
    rdf = spark.range(5).select(F.col("id").alias("rid"), F.col("id").cast("double").alias("rx"),
                                F.col("id").cast("double").alias("ry"))
    out = enrich.nearest_reference(pdf, rdf, "x", "y", "rid", "rx", "ry")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_drop_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert enrich.drop_lenient(df, "a", "zz").columns == ["b"]
    with pytest.raises(KeyError):
        enrich.drop_strict(df, "zz")
    assert enrich.with_weekday(spark.createDataFrame([(dt.date(2024, 12, 1),)], "fecha date"), "fecha") \
        .first().dia_semana == "Sunday"


def test_nearest_reference_dense_cluster_refines_cells(spark):
    rnd = random.Random(11)
    refs = [(i, 40.0 + rnd.random() * 1e-6, -3.0 + rnd.random() * 1e-6) for i in range(200)]   # one dense spot
    refs += [(1000 + i, 40.0 + rnd.random(), -3.0 + rnd.random()) for i in range(20)]          # sparse rest
    pts = [(j, 40.0 + rnd.random(), -3.0 + rnd.random()) for j in range(300)]
    pts += [(900 + j, 40.0 + rnd.random() * 2e-6, -3.0 + rnd.random() * 2e-6) for j in range(30)]  # inside the spot
    pdf = spark.createDataFrame(pts, "pid int, x double, y double")
    rdf = spark.createDataFrame(refs, "rid int, rx double, ry double")
    out = enrich.assign_nearest(pdf, rdf, "x", "y", "rid", "rx", "ry", "near")
    got = {r.pid: r.near for r in out.collect()}
    assert got == _brute(pts, refs)


def test_hot_key_join_is_salted(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        usage = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997)
                                      .cast("int").alias("aparcamiento_id"), F.col("id").alias("v"))
        info = spark.range(997).select(F.col("id").cast("int").alias("aparcamiento_id"),
                                       F.concat(F.lit("lot-"), F.col("id").cast("string")).alias("nombre"))
        out = enrich.left_enrich(usage, info, ["aparcamiento_id"])
        got = out.groupBy("nombre").count().where("nombre = 'lot-7'").first()["count"]
        assert got == n // 3 + len([i for i in range(n) if i % 3 and i % 997 == 7])
        assert out.count() == n
        # the hot key is spread over the salt buckets: no task of the join holds all its rows
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "_salt" in plan and "monotonically_increasing_id" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_nearest_with_hot_location(spark):
    pts = [(i, 40.5, -3.5) for i in range(300)] + [(1000 + i, 40.0 + i / 100, -3.0) for i in range(50)]
    refs = [(1, 40.4, -3.4), (2, 40.0, -3.0), (3, 40.9, -3.1)]
    pdf = spark.createDataFrame(pts, "pid int, x double, y double")
    rdf = spark.createDataFrame(refs, "rid int, rx double, ry double")
    out = enrich.assign_nearest(pdf, rdf, "x", "y", "rid", "rx", "ry", "near")
    assert out.count() == len(pts)
    assert {r.pid: r.near for r in out.collect()} == _brute(pts, refs)
