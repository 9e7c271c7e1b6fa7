import datetime as dt

from pyspark.sql import functions as F

from zonelake.operators.clean import CITY_SPECS, CleanSpec, clean, clean_and_check
from zonelake.operators.dedup import dedup_full, dedup_keep_first
from zonelake.schemas import TRIPS, all_text

from tests.conftest import rows


def test_dedup_full_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "a"), (2, "b")], "k int, v string")
    assert rows(dedup_full(df), "k", "v") == [(1, None), (2, "a"), (2, "b")]


def test_keep_first_uses_order_columns_not_scheduling(spark):
    df = spark.createDataFrame([(1, 3, "late"), (1, 1, "early"), (1, 2, "mid"), (2, 5, "x"), (None, 1, "n1"),
                                (None, 0, "n0")], "k int, seq int, payload string").repartition(4)
    out = dedup_keep_first(df, ["k"], ["seq"])
    assert out.columns == ["k", "seq", "payload"]
    assert rows(out, "k") == [(None, 0, "n0"), (1, 1, "early"), (2, 5, "x")]


def test_keep_first_hot_key_is_pre_aggregated(spark):
    hot = spark.range(0, 20000).select(F.lit(7).alias("k"), F.col("id").alias("seq"))
    cold = spark.range(0, 100).select(F.col("id").cast("int").alias("k"), F.lit(-1).cast("long").alias("seq"))
    out = dedup_keep_first(hot.union(cold), ["k"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan or "partial_" in plan
    assert dict((r.k, r.seq) for r in out.collect())[7] == -1


def test_clean_trips_injected_defects(spark):
    raw = [("1", "10", "Anual", "5", "6", "2024-12-01 08:00:00", "2024-12-01 08:10:00", "600", "1.5", "40", "90"),
           ("1", "10", "Anual", "5", "6", "2024-12-01 08:00:00", "2024-12-01 08:10:00", "600", "1.5", "40", "90"),
           ("2", None, "Ocasional", "5", "7", "31/12/2024", "2024-12-01 09:10:00", "abc", "x", "40", "90")]
    df = spark.createDataFrame(raw, all_text(TRIPS))
    spec = CleanSpec("trips_clean", timestamps={"fecha_hora_inicio": "yyyy-MM-dd HH:mm:ss",
                                                  "fecha_hora_fin": "yyyy-MM-dd HH:mm:ss"},
                     numerics={"usuario_id": "int", "duracion_segundos": "int", "distancia_km": "double"},
                     dedup="full", no_nulls=CITY_SPECS["trips"].no_nulls)
    cleaned, checks = clean_and_check(df, spec)
    got = rows(cleaned, "id")
    assert len(got) == 2
    bad = [r for r in got if r[0] == "2"][0]
    assert bad[1] is None and bad[5] is None and bad[7] is None and bad[8] is None
    c = {r["column"]: (r["passed"], r["details"]) for r in checks.collect()}
    assert c["usuario_id"] == (False, "1 null values found")
    assert c["estacion_origen"] == (True, "0 null values found")


def test_clean_booleans_and_keyed_dedup(spark):
    df = spark.createDataFrame([(1, "P", 1, "2024-08-01", 1.0), (1, "P", 1, "2024-08-01", 2.0),
                                (2, "Q", 0, "bad", None), (3, "R", None, "2024-08-02", 3.0)],
                               "edificio_id int, nombre string, flag int, fecha string, kwh double")
    spec = CleanSpec("t", dates={"fecha": "yyyy-MM-dd"}, booleans=("flag",), dedup=("edificio_id", "fecha"),
                     order_by=("kwh",))
    out = rows(clean(df, spec), "edificio_id")
    assert out[0] == (1, "P", True, dt.date(2024, 8, 1), 1.0)
    assert out[1][2] is False and out[1][3] is None
    assert out[2][2] is None


def test_clean_json_field(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "x"}'), (3, "not json")], "id int, props string")
    spec = CleanSpec("e", json_fields={"k": ("props", "$.k", "int")})
    assert [r.k for r in clean(df, spec).orderBy("id").collect()] == [5, None, None]


def test_keep_first_of_one_value_is_aggregated_by_hash(spark):
    rows_in = [(1, 2, 5.0), (1, 2, 3.0), (1, 3, 4.0), (None, 2, 7.0), (None, 2, 6.0), (2, 2, None), (2, 2, -1.0), (3, 3, float("nan")), (3, 3, 9.0)]
    df = spark.createDataFrame(rows_in, "a int, `k.b` int, v double")
    for order in (None, ["v"], ["a", "v"]):
        got = dedup_keep_first(df, ["a", "k.b"], order) if order != ["a", "v"] else dedup_keep_first(df.withColumnRenamed("k.b", "b"), ["a", "b"], order)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 2, 3.0), (1, 3, 4.0), (None, 2, 6.0), (2, 2, None), (3, 3, 9.0)], key=str)
