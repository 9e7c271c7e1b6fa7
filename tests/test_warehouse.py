import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from zonelake.operators import warehouse as W

from tests.conftest import rows


def test_surrogate_keys_equal_row_number(spark):
    rnd = random.Random(3)
    vals = [(rnd.randint(0, 5000), rnd.choice("abc")) for _ in range(3000)] + [(None, "a")]
    df = spark.createDataFrame(vals, "k int, t string")
    got = W.assign_surrogate_keys(df, ["k", "t"], "sk", num_partitions=7)
    want = df.where("k IS NOT NULL").select("k", "t").distinct() \
        .withColumn("sk", F.row_number().over(Window.orderBy("k", "t")))
    assert rows(got, "sk") == [tuple(r) for r in want.orderBy("sk").collect()]


def test_extend_dimension_keeps_existing_keys(spark):
    existing = spark.createDataFrame([(1, 10), (2, 30)], "estacion_sk long, estacion_id int")
    cand = spark.createDataFrame([(30,), (20,), (40,), (20,)], "estacion_id int")
    new = W.extend_dimension(existing, cand, ["estacion_id"], "estacion_sk")
    assert rows(new.select("estacion_id", "estacion_sk"), "estacion_id") == [(20, 3), (40, 4)]


def test_user_with_two_types_keeps_earliest(spark):
    st = spark.createDataFrame([(7, "Ocasional", dt.datetime(2024, 1, 2)), (7, "Anual", dt.datetime(2024, 1, 1)),
                                (3, "Anual", dt.datetime(2024, 1, 5))], "usuario_id int, tipo_usuario string, t timestamp")
    assert rows(W.user_dimension(st, "usuario_id", "tipo_usuario", "t"), "usuario_sk") == \
        [(1, 3, "Anual"), (2, 7, "Anual")]


def test_trip_fact_role_playing_and_unmatched(spark):
    st = spark.createDataFrame([(1, "A", 10, 20, "1.50"), (1, "A", 20, 10, "2.50"), (2, "B", 10, 99, "0.10"),
                                (None, "A", 10, 20, "1.00")], "u int, tipo string, o int, d int, km string") \
        .withColumn("m", F.col("km").cast("decimal(8,2)") * 1000)
    users = spark.createDataFrame([(1, 1), (2, 2)], "usuario_sk long, u int")
    stations = spark.createDataFrame([(1, 10), (2, 20)], "estacion_sk long, estacion_id int")
    f = W.trip_fact(st, users, stations, user_col="u", origin_col="o", dest_col="d", measures={"distancia_m": "m"})
    assert rows(f, "distancia_m") == [(1, 1, 2, 1500), (1, 2, 1, 2500)]


def test_insert_if_absent_is_idempotent(spark, tmp_dir):
    path = tmp_dir + "/fact"
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "id int, v string")
    assert W.append_new_rows(path, batch, ["id"], ["v"]) == 2
    assert W.append_new_rows(path, batch, ["id"], ["v"]) == 0           # second run adds nothing
    more = spark.createDataFrame([(2, "zz"), (3, "c")], "id int, v string")
    assert W.append_new_rows(path, more, ["id"]) == 1
    assert rows(spark.read.parquet(path), "id") == [(1, "a"), (2, "b"), (3, "c")]


def test_incremental_merge(spark):
    ex = spark.createDataFrame([(1, "a")], "id int, v string")
    cand = spark.createDataFrame([(1, "x"), (2, "b")], "id int, v string")
    assert rows(W.incremental_merge(ex, cand, ["id"]), "id") == [(1, "a"), (2, "b")]


def test_decimal_columns(spark):
    df = spark.createDataFrame([(1.234, "x")], "t double, s string")
    out = W.decimal_columns(df, {"t": "decimal(4,2)"})
    assert str(out.schema["t"].dataType) == "DecimalType(4,2)" and out.first().t == __import__("decimal").Decimal("1.23")


def test_null_keys_are_kept_apart_and_loaded_once(spark, tmp_dir):
    path = tmp_dir + "/fact"
    batch = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id int, v string")
    assert [W.append_new_rows(path, batch, ["id"]) for _ in range(3)] == [3, 0, 0]
    assert sorted(rows(spark.read.parquet(path)), key=str) == [(1, "c"), (None, "a"), (None, "b")]


def test_an_unreadable_table_is_not_a_first_load(spark, tmp_dir):
    import os
    import pytest
    path = tmp_dir + "/fact"
    os.makedirs(path)
    with open(path + "/part-0.parquet", "w") as f:
        f.write("not parquet")
    batch = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(Exception):
        W.append_new_rows(path, batch, ["id"])
    assert os.listdir(path) == ["part-0.parquet"]


def test_salted_join_spreads_equal_rows(spark):
    from zonelake.operators.joins import hot_keys, salted_join
    big = spark.range(10_000).select(F.lit(7).alias("k")).union(spark.range(200).select(F.col("id").cast("int").alias("k")))
    assert rows(hot_keys(big, ["k"], 8)) == [(7, 8)]
    small = spark.createDataFrame([(7, "x"), (8, "y")], "k int, w string")
    assert salted_join(big, small, ["k"], "inner", 8).count() == 10_002
