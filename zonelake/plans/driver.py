"""The operators of the lakehouse bound to the driver's TPC-H-style tables.

Each public ``q_*`` function takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole tables.  The city concepts map as follows: a lineitem is a trip
(supplier nation -> customer nation is the route, the customer is the user, the
customer's market segment is the user type), orders are sales transactions,
events are the hourly sensor stream, embeddings are located points, conversations
are lineage chains (turn n is derived from turn n-1).
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.scalar import round_half_up_int, safe_cast, safe_timestamp, to_bool, weekday_name
from zonelake.functions.totals import grouped
from zonelake.operators import enrich, governance, loads, quality as Q, reports, warehouse
from zonelake.operators.clean import CleanSpec, clean, clean_and_check
from zonelake.operators.dedup import dedup_full, dedup_keep_first
from zonelake.session import apply_core_conf, data_path, scratch_path, stored_table
from zonelake.sources.io import read_dataset, write_dataset
from zonelake.sources.sqldump import read_sql_dump, write_sql_dump
from zonelake.sources.binary import file_manifest

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Zone of each driver table in the policy query: raw landings, derived facts, dimensions, governance records.
TABLE_ZONES = {
    "events": "raw-ingestion-zone", "documents": "raw-ingestion-zone", "pages": "raw-ingestion-zone",
    "conversations": "raw-ingestion-zone", "orders": "process-zone", "lineitem": "process-zone",
    "embeddings": "process-zone", "region": "access-zone", "nation": "access-zone", "customer": "access-zone",
    "supplier": "access-zone", "part": "access-zone", "labels": "govern-zone-metadata",
    "benchmark": "govern-zone-security"}

# Fixed values used by the bindings (the oracle SQL repeats them literally).
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EVENT_LEVELS = {"view": 1, "click": 2, "signup": 3, "purchase": 4}
EVENT_TYPES = ("view", "click", "signup", "purchase", "error")
RFM_MIN_ORDERS = 10
RFM_MIN_SPEND = Decimal("2465000.00")
LOADED_BEFORE = _dt.datetime(1996, 1, 1)
RFM_RECENT_FROM = _dt.datetime(2000, 6, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame, read anew by each query."""
    apply_core_conf(spark)
    return spark.read.parquet(data_path(sf_dir, name))


# --- shared derived frames ---------------------------------------------------------------

def trip_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging of trips: one row per lineitem with user, type, route ends and decimal measures."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # orders meet customers first (both smaller than lineitem), so when nothing can be broadcast the
    # lineitem-sized rows are shuffled twice (order key, supplier key) rather than three times
    oc = o.join(c, o.o_custkey == c.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey).join(s, li.l_suppkey == s.s_suppkey)
    return j.select(
        F.col("o_custkey").alias("usuario_id"), F.col("c_mktsegment").alias("tipo_usuario"),
        F.col("s_nationkey").alias("estacion_origen"), F.col("c_nationkey").alias("estacion_destino"),
        round_half_up_int("l_quantity").alias("duracion_segundos"),
        (F.col("l_discount").cast("decimal(8,2)") + F.col("l_tax").cast("decimal(8,2)")).alias("distancia_km"),
        (F.col("l_quantity").cast("decimal(8,2)") * F.lit(Decimal("1.5"))).alias("calorias_estimadas"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.lit(Decimal("0.01"))).alias("co2_evitado_gramos"),
        F.col("o_orderdate").alias("fecha_hora_inicio"), F.col("l_shipdate").alias("fecha_hora_fin"))


TRIP_MEASURES = {"distancia_m": "_dist_m", "calorias": "calorias_estimadas", "co2_evitado_g": "co2_evitado_gramos"}


def trip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with integer measures, keyed by natural ids (for the route reports)."""
    st = trip_staging(spark, sf_dir)
    return st.select("usuario_id", "tipo_usuario", "estacion_origen", "estacion_destino", "duracion_segundos",
                     round_half_up_int(F.col("distancia_km") * 1000).alias("distancia_m"),
                     round_half_up_int("calorias_estimadas").alias("calorias"),
                     round_half_up_int("co2_evitado_gramos").alias("co2_evitado_g"))


def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, customer_segment, rfm_segment, total_spend, average_spend, transaction_count."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    per = grouped(o, ["o_custkey"], {"total_spend": "o_totalprice"}, {"transaction_count": ("count", F.lit(1)), "last_order": ("max", "o_orderdate")})
    j = per.join(c, per.o_custkey == c.c_custkey)
    rfm = F.concat(F.lit("R"), F.when(F.col("last_order") >= F.lit(RFM_RECENT_FROM), "H").otherwise("L"),
                   F.lit("F"), F.when(F.col("transaction_count") >= RFM_MIN_ORDERS, "H").otherwise("L"),
                   F.lit("M"), F.when(F.col("total_spend") >= F.lit(float(RFM_MIN_SPEND)), "H").otherwise("L"))
    return j.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_segment"),
                    rfm.alias("rfm_segment"), F.col("total_spend"),
                    (F.col("total_spend") / F.col("transaction_count")).alias("average_spend"),
                    "transaction_count")


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, product_name, category, sales_count, total_revenue, average_price."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    per = grouped(li, ["l_partkey"], {"total_revenue": "l_extendedprice"}, {"sales_count": ("count", F.lit(1))})
    j = per.join(p, per.l_partkey == p.p_partkey)
    return j.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"), "sales_count", "total_revenue",
                    (F.col("total_revenue") / F.col("sales_count")).alias("average_price"))


def event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    counted = ev.select("ts", "event_type", "value", F.lit(1).alias("total_events"),
                        *[(F.col("event_type") == t).cast("int").alias(f"n_{t}") for t in EVENT_TYPES])
    prof = enrich.hourly_profile(counted, "ts", ["total_events"] + [f"n_{t}" for t in EVENT_TYPES],
                                 mean_cols=["value"], level_col="event_type", level_map=EVENT_LEVELS,
                                 bucket="hour", out_col="hora", level_out="nivel", exact_means=True)
    return prof


# --- queries ------------------------------------------------------------------------------

def q_hourly_profile(spark, sf_dir):
    return event_profile(spark, sf_dir)


def q_top_hours(spark, sf_dir):
    return enrich.top_hours(event_profile(spark, sf_dir), "nivel", "total_events",
                            [f"n_{t}" for t in EVENT_TYPES], n=5, argmax_col="tipo_predominante")


def q_weekday_profile(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return reports.method_totals(o.withColumn("dia_semana", weekday_name("o_orderdate")), "dia_semana",
                                 "o_totalprice")


def q_safe_casts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    good = F.concat(F.lit("2024-01-"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"),
                    F.lit(" 12:00:00"))
    flag = F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_custkey") % 2)
    return c.select(
        "c_custkey",
        safe_cast(F.substring("c_name", 10, 100), "bigint").alias("name_number"),
        safe_cast("c_mktsegment", "double").alias("segment_number"),
        safe_timestamp(good).cast("timestamp_ntz").alias("good_ts"),
        safe_timestamp(F.concat("c_mktsegment", F.lit(" 12:00:00"))).cast("timestamp_ntz").alias("bad_ts"),
        to_bool(flag).alias("flag"))


def q_dedup_full(spark, sf_dir):
    return dedup_full(table(spark, sf_dir, "events").select("user_id", "event_type"))


def q_dedup_keep_first(spark, sf_dir):
    return dedup_keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


EVENTS_SPEC = CleanSpec("events_clean", timestamps={"ts": "yyyy-MM-dd HH:mm:ss"},
                        json_fields={"k": ("props", "$.k", "int")}, dedup="full",
                        no_nulls=("ts", "user_id", "event_type"), unique=("event_id",))


def q_clean_spec(spark, sf_dir):
    return clean(table(spark, sf_dir, "events"), EVENTS_SPEC)


def q_clean_checks(spark, sf_dir):
    _, checks = clean_and_check(table(spark, sf_dir, "events"), EVENTS_SPEC)
    return checks.select(*CHECK_COLS)


def q_trip_publish(spark, sf_dir):
    return enrich.drop_lenient(table(spark, sf_dir, "orders"), "o_orderkey", "Unnamed: 0")


def q_left_enrich(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return enrich.left_enrich(docs, table(spark, sf_dir, "labels"), ["doc_id"])


def _embedding_points(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"),
                    F.col("embedding")[1].cast("double").alias("y"))


def _label_refs(points: DataFrame) -> DataFrame:
    """Reference point of each label: its lowest vec_id."""
    first = points.groupBy("label").agg(F.min_by(F.struct("x", "y"), F.col("vec_id")).alias("p"))
    return first.select("label", F.col("p.x").alias("rx"), F.col("p.y").alias("ry"))


def q_nearest_reference(spark, sf_dir):
    pts = _embedding_points(spark, sf_dir)
    out = enrich.assign_nearest(pts, _label_refs(pts), "x", "y", "label", "rx", "ry", "nearest_label")
    return out.select("vec_id", "nearest_label")


def q_parking_enriched(spark, sf_dir):
    pts = _embedding_points(spark, sf_dir)
    e = table(spark, sf_dir, "embeddings")
    base = e.withColumn("fecha", F.date_add(F.lit(_dt.date(2024, 1, 1)), F.col("vec_id").cast("int")))
    base = enrich.with_weekday(enrich.drop_strict(base, "embedding"), "fecha")
    near = enrich.assign_nearest(pts, _label_refs(pts), "x", "y", "label", "rx", "ry", "nearest_label") \
        .select("vec_id", "nearest_label")
    return base.join(near, "vec_id", "left").select("vec_id", "label", "fecha", "dia_semana", "nearest_label")


# quality -----------------------------------------------------------------------------------

def quality_rule_sets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    lineitem = table(spark, sf_dir, "lineitem").withColumn("l_discount_nz", F.nullif("l_discount", F.lit(0.0)))
    return [
        (orders, "orders", Q.no_nulls("o_orderkey", "o_custkey", "o_orderdate") + Q.unique("o_orderkey")),
        (customer, "customer", Q.unique("c_custkey", "c_name") + Q.no_nulls("c_mktsegment")),
        (lineitem, "lineitem", Q.unique("l_orderkey") + Q.no_nulls("l_shipdate", "l_discount_nz", "l_missing")),
    ]


CHECK_COLS = ["dataset", "row_count", "rule_idx", "check_type", "column", "passed", "bad_count", "details"]


def _all_checks(spark, sf_dir):
    parts = [Q.run_checks(df, name, rules) for df, name, rules in quality_rule_sets(spark, sf_dir)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_quality_checks(spark, sf_dir):
    return _all_checks(spark, sf_dir).select(*CHECK_COLS)


def q_quality_summary(spark, sf_dir):
    return Q.quality_summary(_all_checks(spark, sf_dir))


def q_failed_checks(spark, sf_dir):
    return Q.failed_checks(_all_checks(spark, sf_dir)).select(*CHECK_COLS)


def q_quality_report(spark, sf_dir):
    """Checks nested into one record per dataset run, then flattened back (the report of the records)."""
    return Q.quality_report(Q.to_records(_all_checks(spark, sf_dir))).drop("timestamp")


def q_accepted_values_check(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return Q.run_checks(o, "orders", [Q.accepted_values("o_orderstatus", ["F", "O"])]).select(*CHECK_COLS)


def q_referential_check(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return Q.run_checks(docs, "documents", [Q.references("doc_id", table(spark, sf_dir, "labels"), "doc_id")]) \
        .select(*CHECK_COLS)


def q_range_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return Q.run_checks(li, "lineitem", [Q.in_range("l_discount", 0.0, 0.05)]).select(*CHECK_COLS)


# warehouse ----------------------------------------------------------------------------------

def _user_staging(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("usuario_id"), F.col("c_mktsegment").alias("tipo_usuario"),
        F.col("o_orderdate").alias("fecha_hora_inicio"))


def q_dim_user(spark, sf_dir):
    return warehouse.user_dimension(_user_staging(spark, sf_dir), "usuario_id", "tipo_usuario",
                                    "fecha_hora_inicio")


def _station_staging(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("estacion_origen"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("estacion_destino"))
    return s, c


def q_dim_station(spark, sf_dir):
    s, c = _station_staging(spark, sf_dir)
    stations = s.select(F.col("estacion_origen").alias("estacion_id")).union(
        c.select(F.col("estacion_destino").alias("estacion_id"))).distinct()
    return warehouse.assign_surrogate_keys(stations, ["estacion_id"], "estacion_sk") \
        .select("estacion_sk", "estacion_id")


def q_fact_trip(spark, sf_dir):
    return trip_star(spark, sf_dir)[0]


def trip_star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Trip fact, user and station dimension.  The staging joins run once; both dimensions and the fact read it."""
    st = stored_table(trip_staging(spark, sf_dir).withColumn("_dist_m", F.col("distancia_km") * 1000), "trip-staging")
    users = warehouse.user_dimension(st, "usuario_id", "tipo_usuario", "fecha_hora_inicio")
    stations = warehouse.station_dimension(st, "estacion_origen", "estacion_destino")
    fact = warehouse.trip_fact(st, users, stations, user_col="usuario_id", origin_col="estacion_origen",
                               dest_col="estacion_destino", measures=TRIP_MEASURES,
                               passthrough=["duracion_segundos", "fecha_hora_inicio", "fecha_hora_fin"])
    return fact, users, stations


def q_dim_parking(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    dim = s.select(F.col("s_suppkey").alias("aparcamiento_id"), F.col("s_name").alias("nombre"),
                   F.col("s_nationkey").alias("capacidad_total"), F.col("s_acctbal").alias("tarifa_hora_euros"))
    dim = dedup_keep_first(dim, ["aparcamiento_id"])
    return warehouse.decimal_columns(dim, {"tarifa_hora_euros": "decimal(10,2)"})


def q_dim_district(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    c = table(spark, sf_dir, "customer")
    pop = c.groupBy(F.col("c_nationkey").alias("distrito_id")).agg(F.count(F.lit(1)).alias("poblacion"))
    d = n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("distrito_id"), F.col("n_name").alias("nombre"), F.col("r_name").alias("region"))
    return d.join(pop, "distrito_id", "left").na.fill(0, subset=["poblacion"])


def q_fact_parking(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    f = li.join(s, li.l_suppkey == s.s_suppkey)
    return f.select(F.col("l_suppkey").alias("aparcamiento_id"), F.col("l_shipdate").cast("date").alias("fecha"),
                    F.hour("l_shipdate").alias("hora"),
                    (F.col("l_discount") * 100).cast("decimal(5,2)").alias("porcentaje_ocupacion"),
                    F.col("s_nationkey").alias("distrito_id"))


def q_incremental_load(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    existing = ev.where(F.col("ts") < F.lit(_dt.datetime(2024, 1, 20)))
    candidates = ev.where(F.col("ts") >= F.lit(_dt.datetime(2024, 1, 10)))
    return warehouse.incremental_merge(existing, candidates, ["event_id"], ["ts"])


def q_atomic_load(spark, sf_dir):
    """Orders and lineitems loaded together: the old ones, all of them in a load that dies before it is published, all
    of them again, and the same load once more; what is visible then, by table and month."""
    root = scratch_path(spark, "loads")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")

    def batches(old: bool):
        first = F.lit(LOADED_BEFORE)
        return {"orders": loads.Batch(orders.where(F.col("o_orderdate") < first) if old else orders, ["o_orderkey", "o_orderdate"], "o_orderdate", monthly=False),
                "lines": loads.Batch(lines.where(F.col("l_shipdate") < first) if old else lines,
                                     ["l_orderkey", "l_linenumber", "l_shipdate"], "l_shipdate", ["l_extendedprice"], monthly=False)}

    loads.load(spark, root, "old", batches(True))
    loads.write_aside(root, batches(False))  # killed before it is published
    loads.load(spark, root, "all", batches(False))
    loads.load(spark, root, "all", batches(False))
    loads.load(spark, root, "again", batches(False))
    out = []
    for name, rows, day, amount in (("orders", orders, "o_orderdate", "o_totalprice"), ("lines", lines, "l_shipdate", "l_extendedprice")):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        out.append(loads.read_loaded(spark, root, name, columns).groupBy(F.lit(name).alias("loaded"), (F.year(day) * 100 + F.month(day)).alias("period"))
                   .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.round(F.col(amount) * 100).cast("decimal(20,0)")).cast("long").alias("cents")))
    return out[0].unionByName(out[1])


# reports ------------------------------------------------------------------------------------

def q_top_routes(spark, sf_dir):
    return reports.top_routes(trip_rows(spark, sf_dir), "estacion_origen", "estacion_destino", 10)


# The star query as a SQL string: pairs of surrogate keys are counted first, then named.
TOP_ROUTES_SQL = """
WITH pairs AS (SELECT origen_sk, destino_sk, count(*) AS n FROM zl_fact GROUP BY origen_sk, destino_sk)
SELECT concat_ws(' → ', a.estacion_id, b.estacion_id) AS ruta, n AS total_viajes
FROM pairs JOIN zl_station a ON a.estacion_sk = origen_sk JOIN zl_station b ON b.estacion_sk = destino_sk
ORDER BY n DESC, ruta LIMIT 10
"""


def sql_over_views(spark: SparkSession, sql: str, views: dict[str, DataFrame]) -> DataFrame:
    """Run a SQL string over DataFrames registered as temporary views (same plan as the DataFrame API)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def q_top_routes_sql(spark, sf_dir):
    fact, _, stations = trip_star(spark, sf_dir)
    return sql_over_views(spark, TOP_ROUTES_SQL, {"zl_fact": fact, "zl_station": stations})


def q_top_routes_by_type(spark, sf_dir):
    return reports.top_routes_by_group(trip_rows(spark, sf_dir), "tipo_usuario", "estacion_origen",
                                       "estacion_destino", 10)


def q_stats_by_type(spark, sf_dir):
    return reports.group_stats(trip_rows(spark, sf_dir), "tipo_usuario", {
        "duracion_media_segundos": "duracion_segundos", "distancia_media_metros": "distancia_m",
        "calorias_media": "calorias", "co2_evitado_medio_g": "co2_evitado_g"})


def q_segment_share(spark, sf_dir):
    return reports.segment_share(customer_summary(spark, sf_dir))


def q_segment_value(spark, sf_dir):
    return reports.segment_value(customer_summary(spark, sf_dir))


def q_category_efficiency(spark, sf_dir):
    return reports.category_efficiency(product_performance(spark, sf_dir))


def q_rfm_top5(spark, sf_dir):
    return reports.rfm_top(customer_summary(spark, sf_dir), 5)


def q_top_products(spark, sf_dir):
    return reports.top_by(product_performance(spark, sf_dir), "total_revenue", 10, ["product_id"])


def q_recommendations(spark, sf_dir):
    return reports.recommendations(reports.category_efficiency(product_performance(spark, sf_dir)),
                                   reports.segment_value(customer_summary(spark, sf_dir)))


def q_method_totals(spark, sf_dir):
    return reports.method_totals(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


def _customers_with_region(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey) \
        .select("c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("customer_segment"))


def q_customer_segmentation_cte(spark, sf_dir):
    return reports.two_level_segmentation(_customers_with_region(spark, sf_dir), table(spark, sf_dir, "orders"),
                                          "c_custkey", "o_custkey", "o_orderkey", "o_totalprice", "region",
                                          "customer_segment")


def q_monthly_summary(spark, sf_dir):
    return reports.period_summary(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


def q_monthly_pivot(spark, sf_dir):
    return reports.monthly_pivot_by_key(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
                                        "o_custkey", "c_custkey", "o_orderdate", "c_mktsegment", "o_totalprice",
                                        SEGMENTS)


def q_fact_dim_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_name", "l_extendedprice") \
        .orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 "p_name").limit(20)


def q_density_vs_transport(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = reports.density_vs_coverage(n, "n_nationkey", table(spark, sf_dir, "supplier"), "s_nationkey",
                                      "n_suppliers", table(spark, sf_dir, "customer"), "c_nationkey", "n_customers")
    return out.withColumn("customers_per_supplier", F.try_divide(F.col("n_customers").cast("double"),
                                                                 F.col("n_suppliers").cast("double")))


# governance ---------------------------------------------------------------------------------

def _node(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def conversation_lineage(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    a, b = conv.alias("a"), conv.alias("b")
    edges = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") + 1)) \
        .select(_node("conv-", "a.conv_id").alias("src_bucket"), _node("turn-", "a.turn").alias("src_object"),
                _node("conv-", "b.conv_id").alias("dst_bucket"), _node("turn-", "b.turn").alias("dst_object"))
    starts = conv.groupBy("conv_id").agg(F.max("turn").alias("turn")) \
        .select(_node("conv-", "conv_id").alias("bucket"), _node("turn-", "turn").alias("object"))
    return edges, starts


def q_lineage_trace(spark, sf_dir):
    edges, starts = conversation_lineage(spark, sf_dir)
    return governance.lineage_trace(edges, starts)


def conversation_records(spark, sf_dir):
    """Lineage records of the conversations: a turn comes from the one before it, a first turn from the last turn of
    the conversation before, from several sources (every seventh) or from its own last turn (a cycle, every thirtieth).
    Every third turn has a later record, every fifth one of the same time with another source."""
    conv = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null") \
        .select("conv_id", "turn", "role").distinct()
    ends = conv.groupBy("conv_id").agg(F.max("turn").alias("last"))
    rows = conv.join(ends, "conv_id").join(ends.select((F.col("conv_id") + 1).alias("conv_id"), F.col("last").alias("before")), "conv_id", "left")
    node = lambda c, t: F.struct(F.concat(F.lit("conv-"), c.cast("string")).alias("bucket"), F.concat(F.lit("turn-"), t.cast("string")).alias("object"))
    c, t = F.col("conv_id"), F.col("turn")
    source = F.when(t > 0, node(c, t - 1)).when(c % 30 == 0, node(c, F.col("last"))).when(c % 7 == 0, F.struct(
        F.lit(governance.MULTIPLE).alias("bucket"), F.lit(None).cast("string").alias("object"))) \
        .when(F.col("before").isNotNull(), node(c - 1, F.col("before")))
    minute = F.timestamp_add("MINUTE", (c * 100 + t).cast("int"), F.lit(_dt.datetime(2024, 1, 1)))
    made = rows.where(source.isNotNull()).select(
        minute.alias("timestamp"), source.alias("source"), node(c, t).alias("target"), F.col("role").alias("transformation"), "conv_id", "turn")
    later = made.where("turn % 3 = 0").withColumn("timestamp", F.timestamp_add("HOUR", F.lit(1), F.col("timestamp"))) \
        .withColumn("source", node(c, t + 1))
    same = made.where("turn % 5 = 0").withColumn("source", F.struct(F.lit("zone").alias("bucket"), F.lit("other").alias("object")))
    starts = ends.select(node(c, F.col("last")).alias("n")).select("n.*")
    return made.unionByName(later).unionByName(same).drop("conv_id", "turn"), starts


def q_lineage_history(spark, sf_dir):
    out = governance.lineage_history(*conversation_records(spark, sf_dir))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _profiles(spark, sf_dir):
    return governance.profile_tables({t: table(spark, sf_dir, t) for t in DRIVER_TABLES}, "access-zone")


def q_metadata_catalog(spark, sf_dir):
    records = _profiles(spark, sf_dir).withColumn("uploaded_at", F.lit(_dt.datetime(2024, 1, 1)))
    return governance.metadata_catalog(records).select("source_bucket", "object_name", "format", "rows",
                                                       "n_columns")


def q_policy_grants(spark, sf_dir):
    zone = F.element_at(F.create_map(*[F.lit(x) for pair in TABLE_ZONES.items() for x in pair]), F.col("object_name"))
    tables = _profiles(spark, sf_dir).where(F.col("rows") > 0).select("object_name", zone.alias("zone"))
    return governance.table_grants(tables).select("object_name", "zone", "action", "role")


def q_retention_report(spark, sf_dir):
    parts = [
        governance.retention_report(table(spark, sf_dir, "orders"), "o_orderdate", "orders",
                                    "raw-ingestion-zone", _dt.datetime(1999, 1, 1)),
        governance.retention_report(table(spark, sf_dir, "lineitem"), "l_shipdate", "lineitem",
                                    "process-zone", _dt.datetime(1999, 1, 1)),
        governance.retention_report(table(spark, sf_dir, "events"), "ts", "events",
                                    "access-zone", _dt.datetime(2025, 1, 10)),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_masked_customers(spark, sf_dir):
    return governance.mask_columns(table(spark, sf_dir, "customer"), ["c_name", "email", "phone", "address"])


def q_file_manifest(spark, sf_dir):
    apply_core_conf(spark)
    m = file_manifest(spark, sf_dir, "raw-ingestion-zone", glob="*.parquet")
    return m.select("source_bucket", "object_name", "file_hash", "file_size")


# round trips (write the documents table, read it back with its schema) ---------------------

def q_csv_roundtrip(spark, sf_dir):
    path, docs = scratch_path(spark, "csv"), table(spark, sf_dir, "documents")
    write_dataset(docs, path, "csv")
    return read_dataset(spark, path, "csv", docs.schema, multiline=True)


def q_json_roundtrip(spark, sf_dir):
    path, docs = scratch_path(spark, "json"), table(spark, sf_dir, "documents")
    write_dataset(docs, path, "json")
    return read_dataset(spark, path, "json", docs.schema)


def q_sql_dump_roundtrip(spark, sf_dir):
    path, docs = scratch_path(spark, "dump"), table(spark, sf_dir, "documents")
    write_sql_dump(docs, path, "documents")
    return read_sql_dump(spark, path, {"documents": docs.schema})["documents"].drop("_file", "_ord", "_pos")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}
