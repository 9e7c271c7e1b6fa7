import datetime as dt

import pytest

from pyspark.sql import functions as F

from zonelake.operators import reports as R

from tests.conftest import rows


def _trips(spark):
    data = [("Anual", 1, 2)] * 3 + [("Anual", 2, 1)] * 2 + [("Anual", 3, 1)] * 2 + [("Ocasional", 1, 2)] + \
           [("Ocasional", 5, 6)]
    return spark.createDataFrame(data, "tipo string, o int, d int")


def test_top_routes_tie_break(spark):
    assert rows(R.top_routes(_trips(spark), "o", "d", 3)) == [("1 → 2", 4), ("2 → 1", 2), ("3 → 1", 2)]
    assert rows(R.top_routes(_trips(spark), "o", "d", 2)) == [("1 → 2", 4), ("2 → 1", 2)]


def test_top_routes_by_group(spark):
    out = rows(R.top_routes_by_group(_trips(spark), "tipo", "o", "d", 1))
    assert out == [("Anual", "1 → 2", 3), ("Ocasional", "1 → 2", 1)]


def test_group_stats_rounding(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 2)], "g string, v int")   # avg 1.75 -> 1.8
    assert rows(R.group_stats(df, "g", {"m": "v"})) == [("a", 4, 1.8)]


def test_share_of_total_and_zero(spark):
    df = spark.createDataFrame([("x", 1, 0.0), ("y", 3, 0.0)], "k string, n long, amount double")
    out = {r.k: (r.pn, r.pa) for r in R.with_share_of_total(df, {"pn": "n", "pa": "amount"}).collect()}
    assert out == {"x": (25.0, None), "y": (75.0, None)}


def test_pivot_sums_duplicates_and_fills_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), "A", 1.0), (dt.datetime(2024, 1, 6), "A", 2.5),
                                (dt.datetime(2024, 2, 1), "B", 4.0)], "ts timestamp, cat string, v double")
    assert rows(R.monthly_pivot(df, "ts", "cat", "v", ["A", "B"])) == [("2024-01", 3.5, 0.0), ("2024-02", 0.0, 4.0)]


def test_segments_and_recommendations(spark):
    from decimal import Decimal as D
    cs = spark.createDataFrame([(1, "gold", "R1", D("100.00"), 50.0, 2), (2, "gold", "R1", D("50.00"), 50.0, 1),
                                (3, "basic", "R2", D("150.00"), 15.0, 10)],
                               "customer_id int, customer_segment string, rfm_segment string, total_spend decimal(18,2), "
                               "average_spend double, transaction_count int")
    sv = {r.customer_segment: r for r in R.segment_value(cs).collect()}
    assert sv["gold"].avg_customer_value == 75.0 and sv["gold"].avg_transaction_value == 50.0
    ss = {r.customer_segment: r for r in R.segment_share(cs).collect()}
    assert ss["gold"].percent_of_revenue == 50.0 and abs(ss["gold"].percent_of_customers - 200 / 3) < 1e-12
    top = R.rfm_top(cs, 1).collect()
    assert len(top) == 1 and top[0].rfm_segment == "R1"   # tie 150 vs 150 -> smaller label
    pp = spark.createDataFrame([(1, "A", 5, D("10.00")), (2, "B", 1, D("10.00")), (3, "B", 1, D("0.00"))],
                               "product_id int, category string, sales_count int, total_revenue decimal(18,2)")
    ce = R.category_efficiency(pp)
    rec = R.recommendations(ce, R.segment_value(cs)).first()
    assert (rec.top_category, rec.valuable_segment, rec.efficient_category) == ("A", "basic", "A")


def test_density_keeps_empty_areas(spark):
    areas = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    st = spark.createDataFrame([(1,), (1,)], "d int")
    out = rows(R.density_vs_coverage(areas, "id", st, "d", "stations", st.limit(0), "d", "other"), "id")
    assert out == [(1, "a", 2, 0), (2, "b", 0, 0)]


def test_period_summary_and_methods(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), "card", 10.10), (dt.datetime(2024, 1, 9), "cash", 0.2),
                                (dt.datetime(2024, 3, 1), "card", 5.0)], "ts timestamp, m string, a double")
    assert rows(R.period_summary(df, "ts", "a")) == [(2024, 1, 2, 10.3, 5.15), (2024, 3, 1, 5.0, 5.0)]
    assert rows(R.method_totals(df, "m", "a")) == [("card", 2, 15.1, 7.55), ("cash", 1, 0.2, 0.2)]


def test_reports_keep_small_and_large_values(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), "a", 1e-11)] * 1000 + [(dt.datetime(2024, 1, 5), "b", 1e30), (dt.datetime(2024, 2, 5), "b", 1.0)],
                               "ts timestamp, m string, a double").repartition(7)
    assert rows(R.method_totals(df, "m", "a")) == [("b", 2, 1e30, 5e29), ("a", 1000, 1e-8, 1e-8 / 1000)]
    assert rows(R.monthly_pivot(df, "ts", "m", "a")) == [("2024-01", 1e-8, 1e30), ("2024-02", 0.0, 1.0)]
    shares = R.with_share_of_total(R.method_totals(df, "m", "a"), {"share": "total_sales"})
    assert rows(shares.select("m", "share"), "m") == [("a", 1e-36), ("b", 100.0)]


def test_a_pivot_that_is_too_wide_is_an_error(spark):
    df = spark.range(R.PIVOT_COLUMNS + 1).select(F.lit(dt.datetime(2024, 1, 1)).alias("ts"), F.col("id").cast("string").alias("cat"), F.lit(1.0).alias("v"))
    with pytest.raises(ValueError, match="categories"):
        R.monthly_pivot(df, "ts", "cat", "v")
    assert R.category_months(df, "ts", "cat", "v").count() == R.PIVOT_COLUMNS + 1


def test_pivot_keeps_unlisted_and_null_categories(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "A", 1.0), (dt.datetime(2024, 1, 2), "NEW", 99.0),
                                (dt.datetime(2024, 1, 3), None, 0.5)], "ts timestamp, cat string, v double")
    out = R.monthly_pivot(df, "ts", "cat", "v", ["A", "B"])
    assert out.columns == ["month_year", "A", "B", "NEW", "null"] and rows(out) == [("2024-01", 1.0, 0.0, 99.0, 0.5)]
