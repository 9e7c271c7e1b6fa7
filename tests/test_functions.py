import datetime as dt

from pyspark.sql import functions as F

from zonelake.functions import (grouped, ordinal, ratio, round_half_up_int, route_label, row_argmax,
                                rounded_mean, safe_cast, safe_timestamp, sum_or_zero, time_of_day, to_bool,
                                weekday_name)


def test_safe_casts_coerce_bad_values_to_null(spark):
    df = spark.createDataFrame([("12", "2024-12-01 10:30:00"), ("x1", "not a date"), (None, None)], "n string, t string")
    out = df.select(safe_cast("n", "int").alias("n"), safe_timestamp("t").alias("t")).collect()
    assert out[0]["n"] == 12 and out[0]["t"] == dt.datetime(2024, 12, 1, 10, 30)
    assert out[1]["n"] is None and out[1]["t"] is None
    assert out[2]["n"] is None and out[2]["t"] is None


def test_to_bool_keeps_null(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "b int")
    assert [r[0] for r in df.select(to_bool("b")).collect()] == [False, True, True, None]


def test_ordinal_unmapped_is_null(spark):
    df = spark.createDataFrame([("Baja",), ("Muy Alta",), ("Desconocida",), (None,)], "c string")
    m = {"Baja": 1, "Moderada": 2, "Alta": 3, "Muy Alta": 4}
    assert [r[0] for r in df.select(ordinal("c", m)).collect()] == [1, 4, None, None]


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 1, 7, 5, 9),)], "ts timestamp")
    r = df.select(weekday_name("ts"), time_of_day("ts"), F.hour("ts")).first()
    assert tuple(r) == ("Sunday", "07:05:09", 7)


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("2.5",), ("-2.5",), ("2.49",), ("1500.5",)], "v string")
    vals = [r[0] for r in df.select(round_half_up_int(F.col("v").cast("decimal(8,2)"))).collect()]
    assert vals == [3, -3, 2, 1501]


def test_row_argmax_first_wins_and_all_null(spark):
    df = spark.createDataFrame([(5, 9, 9, 1), (3, 3, 1, 0), (None, None, None, None), (None, 2, None, 1)],
                               "coches int, motos int, camiones int, buses int")
    names = ["coches", "motos", "camiones", "buses"]
    assert [r[0] for r in df.select(row_argmax(names)).collect()] == ["motos", "coches", None, "motos"]


def test_route_label_null_propagates(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "o int, d int")
    assert [r[0] for r in df.select(route_label("o", "d")).collect()] == ["1 → 2", None]


def test_ratio_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(10, 4), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [2.5, None]


def test_aggregates_exact_and_pandas_like(spark):
    df = spark.createDataFrame([("a", 0.1, 1, None), ("a", 0.2, 2, None), ("b", 0.25, 0, None)],
                               "g string, v double, i int, n int")
    out = {r["g"]: r for r in df.groupBy("g").agg(rounded_mean("i", 1).alias("r"), sum_or_zero("n").alias("z")).collect()}
    sums = {r["g"]: r for r in grouped(df, ["g"], {"s": "v"}, means={"m": "s"}).collect()}
    assert sums["a"]["s"] == 0.3 and sums["a"]["m"] == 0.15
    assert out["a"]["r"] == 1.5 and out["b"]["z"] == 0
