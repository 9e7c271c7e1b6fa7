"""Reporting operators: route rankings, per-group statistics, shares, segments, pivots.

Shares of a grand total are a window over the grouped rows (one row per group), never
over the detail rows.  Rankings aggregate on the keys first and
only then build labels, so the shuffle carries groups, not detail rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonelake.functions.aggregates import rounded_mean
from zonelake.functions.scalar import ratio, route_label
from zonelake.functions.totals import grouped, parts, total


def with_share_of_total(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Add ``out = 100 * col / sum(col)`` for each ``out -> col`` of ``shares``.

    ``df`` is a small aggregate: the totals are a window over its few grouped rows, so
    the detail rows below it are read and aggregated once.
    """
    cols = [F.col(c) for c in df.columns]
    for out, c in shares.items():
        whole = total(F.collect_list(parts(c)).over(Window.partitionBy()))
        cols.append((F.try_divide(F.col(c).cast("double"), whole) * F.lit(100.0)).alias(out))
    return df.select(*cols)


def route_counts(fact: DataFrame, origin: str, dest: str, group: Sequence[str] = (),
                 label_col: str = "ruta", count_col: str = "total_viajes", weight: str | None = None) -> DataFrame:
    """Trips per (group..., origin, destination), labelled ``origin → destination``.

    ``weight`` names a column of pre-aggregated trip counts (summed instead of counting rows).
    """
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    agg = fact.groupBy(*group, origin, dest).agg(n.alias(count_col))
    return agg.select(*group, route_label(origin, dest).alias(label_col), count_col)


def top_routes(fact: DataFrame, origin: str, dest: str, n: int = 10,
               label_col: str = "ruta", count_col: str = "total_viajes", weight: str | None = None) -> DataFrame:
    """Global top-n routes by trip count; ties broken by the route label."""
    return (route_counts(fact, origin, dest, (), label_col, count_col, weight)
            .orderBy(F.col(count_col).desc(), F.col(label_col).asc()).limit(n))


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int,
                    rank_col: str = "rnk") -> DataFrame:
    """Rows ranked 1..n inside each group (``ROW_NUMBER`` + filter; Spark prunes before the shuffle)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top_routes_by_group(fact: DataFrame, group: str, origin: str, dest: str, n: int = 10,
                        label_col: str = "ruta", count_col: str = "total_viajes",
                        weight: str | None = None) -> DataFrame:
    counts = route_counts(fact, origin, dest, (group,), label_col, count_col, weight)
    ranked = top_n_per_group(counts, group, [F.col(count_col).desc(), F.col(label_col).asc()], n)
    return ranked.select(group, label_col, count_col).orderBy(group, F.col(count_col).desc(), label_col)


def group_stats(fact: DataFrame, group: str, means: Mapping[str, str], count_col: str = "total_viajes",
                digits: int = 1) -> DataFrame:
    """Count plus ``ROUND(AVG(col), digits)`` per group, ordered by count descending."""
    aggs = [F.count(F.lit(1)).alias(count_col)]
    aggs += [rounded_mean(src, digits).alias(out) for out, src in means.items()]
    return fact.groupBy(group).agg(*aggs).orderBy(F.col(count_col).desc(), group)


# --- customer / product analytics ------------------------------------------------------

def segment_share(customers: DataFrame, segment: str = "customer_segment", id_col: str = "customer_id",
                  spend: str = "total_spend", avg_spend: str = "average_spend",
                  tx: str = "transaction_count") -> DataFrame:
    """Per segment: customers, revenue, mean of average spend, transactions, % of customers, % of revenue."""
    agg = grouped(customers, [segment], {"total_spend": spend},
                  {"customer_count": ("count", id_col), "_mean": ("avg", avg_spend), "transaction_count": ("sum", tx)})
    agg = agg.select(segment, "customer_count", "total_spend", F.round(F.col("_mean").cast("decimal(38,10)"), 2).cast("double").alias("average_spend"),
                     F.col("transaction_count").cast("long").alias("transaction_count"))
    return with_share_of_total(agg, {"percent_of_customers": "customer_count",
                                     "percent_of_revenue": "total_spend"})


def segment_value(customers: DataFrame, segment: str = "customer_segment", id_col: str = "customer_id",
                  spend: str = "total_spend", tx: str = "transaction_count") -> DataFrame:
    """Customer lifetime value by segment; avg_transaction_value = revenue / (n * avg transactions)."""
    agg = grouped(customers, [segment], {"total_revenue": spend}, {"customer_count": ("count", id_col), "avg_transactions": ("avg", tx)},
                  means={"avg_customer_value": "total_revenue"}) \
        .select(segment, "customer_count", "total_revenue", "avg_customer_value", "avg_transactions")
    return agg.withColumn("avg_transaction_value",
                          ratio("total_revenue", F.col("customer_count") * F.col("avg_transactions")))


def category_efficiency(products: DataFrame, category: str = "category", id_col: str = "product_id",
                        sales: str = "sales_count", revenue: str = "total_revenue") -> DataFrame:
    agg = grouped(products, [category], {"total_revenue": revenue}, {"total_sales": ("sum", sales), "product_count": ("count", id_col)}) \
        .select(category, F.col("total_sales").cast("long").alias("total_sales"), "total_revenue", "product_count")
    return (agg.withColumn("revenue_per_product", ratio("total_revenue", "product_count"))
               .withColumn("sales_per_product", ratio("total_sales", "product_count"))
               .orderBy(F.col("revenue_per_product").desc(), category))


def rfm_top(customers: DataFrame, n: int = 5, rfm: str = "rfm_segment", id_col: str = "customer_id",
            spend: str = "total_spend", tx: str = "transaction_count") -> DataFrame:
    agg = grouped(customers, [rfm], {"total_revenue": spend}, {"customer_count": ("count", id_col), "transaction_count": ("sum", tx)}) \
        .select(rfm, "customer_count", "total_revenue", F.col("transaction_count").cast("long").alias("transaction_count"))
    shared = with_share_of_total(agg, {"percent_customers": "customer_count",
                                       "percent_revenue": "total_revenue"})
    return shared.orderBy(F.col("total_revenue").desc(), rfm).limit(n)


def top_by(df: DataFrame, value: str, n: int, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.col(value).desc(), *tie).limit(n)


def argmax_label(df: DataFrame, label: str, value: str) -> Column:
    """Label of the row with the largest value; ties go to the smallest label."""
    return F.min_by(F.col(label), F.struct((-F.col(value)).alias("v"), F.col(label).alias("l")))


def recommendations(category_perf: DataFrame, segment_val: DataFrame, category: str = "category",
                    segment: str = "customer_segment") -> DataFrame:
    """Top category by revenue, most valuable segment, most efficient category (one row)."""
    cat = category_perf.agg(argmax_label(category_perf, category, "total_revenue").alias("top_category"),
                            argmax_label(category_perf, category, "revenue_per_product").alias("efficient_category"))
    seg = segment_val.select(argmax_label(segment_val, segment, "avg_customer_value")).scalar()
    return cat.select("top_category", seg.alias("valuable_segment"), "efficient_category")


def method_totals(df: DataFrame, method: str, amount: str) -> DataFrame:
    """Count, exact sum and mean per payment method, ordered by total descending."""
    agg = grouped(df, [method], {"total_sales": amount}, {"transaction_count": ("count", F.lit(1))}, means={"average_sale": "total_sales"})
    return agg.select(method, "transaction_count", "total_sales", "average_sale").orderBy(F.col("total_sales").desc(), method)


def two_level_segmentation(customers: DataFrame, transactions: DataFrame, cust_key: str, tx_key: str,
                           tx_id: str, amount: str, region: str, segment: str) -> DataFrame:
    """Per customer (count, spend), then per (region, segment): customers, revenue, mean spend.

    Transactions are aggregated per customer key before the join, so the join sees
    one row per customer and a customer with a huge share of transactions is
    collapsed by the map-side partial aggregation instead of skewing the join.
    """
    per_key = grouped(transactions, {"_ck": tx_key}, {"total_spend": amount}, {"transaction_count": ("count", tx_id)})
    per_customer = customers.join(per_key, customers[cust_key] == per_key["_ck"]) \
        .select(cust_key, region, segment, "transaction_count", "total_spend")
    agg = grouped(per_customer, [region, segment], {"total_revenue": "total_spend"}, {"customer_count": ("count", F.lit(1))},
                  means={"avg_customer_spend": "total_revenue"})
    return agg.select(region, segment, "customer_count", "total_revenue", "avg_customer_spend") \
        .orderBy(region, F.col("total_revenue").desc(), segment)


def period_summary(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Year / month summary: count, exact total and mean (the CTAS of a monthly table)."""
    agg = grouped(df, {"year": F.year(ts), "month": F.month(ts)}, {"total_amount": amount}, {"order_count": ("count", F.lit(1))},
                  means={"avg_amount": "total_amount"})
    return agg.select("year", "month", "order_count", "total_amount", "avg_amount").orderBy("year", "month")


PIVOT_COLUMNS = 1000     # a wider pivot is an error


def category_months(df: DataFrame, ts: str, category: str, value: str, month_col: str = "month_year", out_col: str = "total") -> DataFrame:
    """Month and category totals as rows, whatever the number of categories (a null one is named ``null``)."""
    name = F.coalesce(F.col(category).cast("string"), F.lit("null"))
    return grouped(df, {month_col: F.date_format(ts, "yyyy-MM"), category: name}, {out_col: value})


def _pivoted(cells: DataFrame, month_col: str, category: str, always: Sequence[str]) -> DataFrame:
    """Month x category, empty cells 0.

    The columns are ``always`` and every category found in the data, so the cells of a month add up to its total
    whatever categories turn up; more than ``PIVOT_COLUMNS`` are an error (``category_months`` gives them as rows).
    """
    found = [r[0] for r in cells.select(category).distinct().orderBy(category).limit(PIVOT_COLUMNS + 1).collect()]
    columns = [*always, *(c for c in found if c not in set(always))]
    if len(columns) > PIVOT_COLUMNS:
        raise ValueError(f"more than {PIVOT_COLUMNS} categories: take category_months")
    out = cells.groupBy(month_col).pivot(category, columns).agg(F.first("total", ignorenulls=True))
    return out.na.fill(0.0, subset=columns).orderBy(month_col)


def monthly_pivot(df: DataFrame, ts: str, category: str, value: str, categories: Sequence[str] = (),
                  month_col: str = "month_year") -> DataFrame:
    """Month x category sums, one column per listed category and per further one in the data, empty cells 0.

    Duplicate (month, category) cells are summed.
    """
    return _pivoted(category_months(df, ts, category, value, month_col), month_col, category, categories)


def monthly_pivot_by_key(facts: DataFrame, dims: DataFrame, fact_key: str, dim_key: str, ts: str, category: str,
                         value: str, categories: Sequence[str] = (), month_col: str = "month_year") -> DataFrame:
    """``monthly_pivot`` where the category lives in a dimension: facts are first summed per
    (key, month), so the join carries one row per key and month instead of every fact."""
    per = grouped(facts, {"_k": fact_key, month_col: F.date_format(ts, "yyyy-MM")}, {"_v": value})
    j = per.join(dims.select(F.col(dim_key).alias("_k"), F.coalesce(F.col(category).cast("string"), F.lit("null")).alias(category)), "_k")
    return _pivoted(grouped(j, [month_col, category], {"total": "_v"}), month_col, category, categories)


def density_vs_coverage(areas: DataFrame, area_key: str, left: DataFrame, left_key: str, left_out: str,
                        right: DataFrame, right_key: str, right_out: str) -> DataFrame:
    """Per area: counts from two child tables (aggregated first), zeros kept for empty areas."""
    lc = left.groupBy(F.col(left_key).alias(area_key)).agg(F.count(F.lit(1)).alias(left_out))
    rc = right.groupBy(F.col(right_key).alias(area_key)).agg(F.count(F.lit(1)).alias(right_out))
    out = areas.join(lc, area_key, "left").join(rc, area_key, "left")
    return out.na.fill(0, subset=[left_out, right_out])
