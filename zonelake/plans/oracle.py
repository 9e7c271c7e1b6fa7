"""Independent DuckDB SQL for every query of ``plans.driver`` (same column names and types).

Money is summed as DECIMAL and cast to DOUBLE, means are exact sum / count, so the
values do not depend on summation order in either engine.
"""

from __future__ import annotations

_TYPES = ("view", "click", "signup", "purchase", "error")

_PROFILE = """
SELECT strftime(date_trunc('hour', ts), '%H:%M:%S') AS hora,
       CAST(COUNT(*) AS BIGINT) AS total_events,
       {type_sums},
       CAST(SUM(CAST(value AS DECIMAL(38,4))) AS DOUBLE) / COUNT(value) AS value,
       AVG(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3
                           WHEN 'purchase' THEN 4 END) AS nivel
FROM events WHERE ts IS NOT NULL GROUP BY 1
""".format(type_sums=",\n       ".join(
    f"CAST(SUM(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{t}" for t in _TYPES))

_ARGMAX = "CASE " + " ".join(
    f"WHEN n_{t} = greatest({', '.join('n_' + u for u in _TYPES)}) THEN 'n_{t}'" for t in _TYPES) + " END"

_TRIP_STAGING = """
stg AS (
  SELECT o.o_custkey AS usuario_id, c.c_mktsegment AS tipo_usuario,
         s.s_nationkey AS estacion_origen, c.c_nationkey AS estacion_destino,
         CAST(ROUND(l.l_quantity) AS INTEGER) AS duracion_segundos,
         CAST(l.l_discount AS DECIMAL(8,2)) + CAST(l.l_tax AS DECIMAL(8,2)) AS distancia_km,
         CAST(l.l_quantity AS DECIMAL(8,2)) * CAST(1.5 AS DECIMAL(2,1)) AS calorias_estimadas,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(2,2)) AS co2_evitado_gramos,
         o.o_orderdate AS fecha_hora_inicio, l.l_shipdate AS fecha_hora_fin
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN customer c ON o.o_custkey = c.c_custkey
),
trips AS (
  SELECT usuario_id, tipo_usuario, estacion_origen, estacion_destino, duracion_segundos,
         CAST(ROUND(distancia_km * 1000) AS INTEGER) AS distancia_m,
         CAST(ROUND(calorias_estimadas) AS INTEGER) AS calorias,
         CAST(ROUND(co2_evitado_gramos) AS INTEGER) AS co2_evitado_g,
         fecha_hora_inicio, fecha_hora_fin
  FROM stg
)"""

_CUSTOMER_SUMMARY = """
cs AS (
  SELECT c.c_custkey AS customer_id, c.c_mktsegment AS customer_segment,
         'R' || CASE WHEN p.last_order >= TIMESTAMP '2000-06-01' THEN 'H' ELSE 'L' END ||
         'F' || CASE WHEN p.transaction_count >= 10 THEN 'H' ELSE 'L' END ||
         'M' || CASE WHEN p.total_spend >= 2465000.00 THEN 'H' ELSE 'L' END AS rfm_segment,
         p.total_spend, CAST(p.total_spend AS DOUBLE) / p.transaction_count AS average_spend,
         p.transaction_count
  FROM (SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS transaction_count,
               SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS total_spend, MAX(o_orderdate) AS last_order
        FROM orders GROUP BY o_custkey) p
  JOIN customer c ON p.o_custkey = c.c_custkey
)"""

_PRODUCT_PERF = """
pp AS (
  SELECT p.p_partkey AS product_id, p.p_name AS product_name, p.p_type AS category,
         x.sales_count, x.total_revenue, CAST(x.total_revenue AS DOUBLE) / x.sales_count AS average_price
  FROM (SELECT l_partkey, CAST(COUNT(*) AS BIGINT) AS sales_count,
               SUM(CAST(l_extendedprice AS DECIMAL(38,4))) AS total_revenue
        FROM lineitem GROUP BY l_partkey) x
  JOIN part p ON x.l_partkey = p.p_partkey
)"""

_SEGMENT_VALUE = """
sv AS (
  SELECT customer_segment, customer_count, total_revenue, avg_customer_value, avg_transactions,
         total_revenue / (customer_count * avg_transactions) AS avg_transaction_value
  FROM (SELECT customer_segment, CAST(COUNT(customer_id) AS BIGINT) AS customer_count,
               CAST(SUM(CAST(total_spend AS DECIMAL(38,4))) AS DOUBLE) AS total_revenue,
               CAST(SUM(CAST(total_spend AS DECIMAL(38,4))) AS DOUBLE) / COUNT(total_spend) AS avg_customer_value,
               AVG(transaction_count) AS avg_transactions
        FROM cs GROUP BY customer_segment)
)"""

_CATEGORY_EFF = """
ce AS (
  SELECT category, total_sales, total_revenue, product_count,
         total_revenue / CAST(product_count AS DOUBLE) AS revenue_per_product,
         CAST(total_sales AS DOUBLE) / CAST(product_count AS DOUBLE) AS sales_per_product
  FROM (SELECT category, CAST(SUM(sales_count) AS BIGINT) AS total_sales,
               CAST(SUM(CAST(total_revenue AS DECIMAL(38,4))) AS DOUBLE) AS total_revenue,
               CAST(COUNT(product_id) AS BIGINT) AS product_count
        FROM pp GROUP BY category)
)"""


def _checks_sql(dataset: str, source: str, rules: list[tuple[int, str, str]]) -> list[str]:
    out = []
    for idx, kind, col in rules:
        if kind == "no_nulls":
            bad = f"COUNT(*) - COUNT({col})"
            if col == "l_discount_nz":
                bad = f"COUNT_IF({col} IS NULL OR isnan({col}))"
            suffix = " null values found"
        else:
            bad = f"COUNT(*) - COUNT(DISTINCT {col})"
            suffix = " duplicate values found"
        out.append(
            f"SELECT '{dataset}' AS dataset, CAST(COUNT(*) AS BIGINT) AS row_count, CAST({idx} AS INTEGER) AS rule_idx, "
            f"'{kind}' AS check_type, '{col}' AS \"column\", ({bad}) = 0 AS passed, "
            f"CAST({bad} AS BIGINT) AS bad_count, CAST({bad} AS VARCHAR) || '{suffix}' AS details FROM {source}")
    return out


_CHECKS = " UNION ALL ".join(
    _checks_sql("orders", "orders", [(0, "no_nulls", "o_orderkey"), (1, "no_nulls", "o_custkey"),
                                     (2, "no_nulls", "o_orderdate"), (3, "unique", "o_orderkey")])
    + _checks_sql("customer", "customer", [(0, "unique", "c_custkey"), (1, "unique", "c_name"),
                                           (2, "no_nulls", "c_mktsegment")])
    + _checks_sql("lineitem", "(SELECT *, NULLIF(l_discount, 0.0) AS l_discount_nz FROM lineitem)",
                  [(0, "unique", "l_orderkey"), (1, "no_nulls", "l_shipdate"), (2, "no_nulls", "l_discount_nz")]))


def _single_check(dataset, source, idx, kind, col, bad, suffix):
    return (f"SELECT '{dataset}' AS dataset, CAST(COUNT(*) AS BIGINT) AS row_count, CAST({idx} AS INTEGER) AS rule_idx, "
            f"'{kind}' AS check_type, '{col}' AS \"column\", ({bad}) = 0 AS passed, "
            f"CAST({bad} AS BIGINT) AS bad_count, CAST({bad} AS VARCHAR) || '{suffix}' AS details FROM {source}")


_GRANTS = """(VALUES
  ('raw-ingestion-zone', 'read', ['data_engineer', 'data_scientist', 'admin']),
  ('raw-ingestion-zone', 'write', ['data_engineer', 'admin', 'system_integrator']),
  ('process-zone', 'read', ['data_engineer', 'data_scientist', 'data_analyst', 'admin']),
  ('process-zone', 'write', ['data_engineer', 'admin']),
  ('access-zone', 'read', ['data_engineer', 'data_scientist', 'data_analyst', 'business_user', 'admin']),
  ('access-zone', 'write', ['data_engineer', 'admin']),
  ('govern-zone-metadata', 'read', ['data_engineer', 'admin', 'governance_team']),
  ('govern-zone-metadata', 'write', ['data_engineer', 'admin', 'system']),
  ('govern-zone-security', 'read', ['admin', 'security_team', 'compliance_officer']),
  ('govern-zone-security', 'write', ['admin', 'system']),
  ('raw-ingestion-zone', 'delete', ['admin']), ('process-zone', 'delete', ['admin']), ('access-zone', 'delete', ['admin']),
  ('govern-zone-metadata', 'delete', ['admin']), ('govern-zone-security', 'delete', ['admin'])) g(zone, action, roles)"""

_ZONE_OF = """CASE WHEN object_name IN ('events', 'documents', 'pages', 'conversations') THEN 'raw-ingestion-zone'
  WHEN object_name IN ('orders', 'lineitem', 'embeddings') THEN 'process-zone'
  WHEN object_name = 'labels' THEN 'govern-zone-metadata' WHEN object_name = 'benchmark' THEN 'govern-zone-security'
  ELSE 'access-zone' END"""

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
           "embeddings", "pages", "benchmark", "labels", "conversations")
_NCOLS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
          "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3,
          "conversations": 4}
_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT 'access-zone' AS source_bucket, '{t}' AS object_name, 'parquet' AS format, "
    f"CAST(COUNT(*) AS BIGINT) AS rows, {_NCOLS[t]} AS n_columns FROM {t}" for t in _TABLES)

_EMB_POINTS = """
pts AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
refs AS (SELECT label AS rlabel, x AS rx, y AS ry FROM pts
         WHERE vec_id IN (SELECT MIN(vec_id) FROM embeddings GROUP BY label)),
near AS (
  SELECT vec_id, rlabel AS nearest_label FROM (
    SELECT p.vec_id, r.rlabel, ROW_NUMBER() OVER (PARTITION BY p.vec_id
           ORDER BY (p.x - r.rx) * (p.x - r.rx) + (p.y - r.ry) * (p.y - r.ry), r.rlabel) AS rn
    FROM pts p, refs r WHERE p.x IS NOT NULL AND p.y IS NOT NULL) WHERE rn = 1
)"""

_ROUND1 = "CAST(ROUND(CAST(AVG({c}) AS DECIMAL(38,10)), 1) AS DOUBLE)"

_CLEAN_EVENTS = "(SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events)"
_CLEAN_CHECKS = " UNION ALL ".join(
    _checks_sql("events_clean", _CLEAN_EVENTS, [(0, "no_nulls", "ts"), (1, "no_nulls", "user_id"),
                                                (2, "no_nulls", "event_type"), (3, "unique", "event_id")]))

ORACLE_SQL: dict[str, str] = {
    "hourly_profile": _PROFILE,
    "top_hours": f"""
SELECT hora, nivel, total_events, {_ARGMAX} AS tipo_predominante
FROM ({_PROFILE}) ORDER BY nivel DESC NULLS LAST, hora LIMIT 5""",
    "weekday_profile": """
SELECT dayname(o_orderdate) AS dia_semana, CAST(COUNT(*) AS BIGINT) AS transaction_count,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS total_sales,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) / COUNT(o_totalprice) AS average_sale
FROM orders GROUP BY 1""",
    "safe_casts": """
SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS BIGINT) AS name_number,
       TRY_CAST(c_mktsegment AS DOUBLE) AS segment_number,
       TRY_STRPTIME('2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || ' 12:00:00',
                    '%Y-%m-%d %H:%M:%S') AS good_ts,
       TRY_STRPTIME(c_mktsegment || ' 12:00:00', '%Y-%m-%d %H:%M:%S') AS bad_ts,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (c_custkey % 2) <> 0 END AS flag
FROM customer""",
    "dedup_full": "SELECT DISTINCT user_id, event_type FROM events",
    "dedup_keep_first": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                 l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
    "clean_spec": """
SELECT DISTINCT event_id, ts, user_id, event_type, value, props,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events""",
    "trip_publish": "SELECT o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "left_enrich": """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN (
  SELECT doc_id, quality, toxic FROM labels
  QUALIFY ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY quality, toxic) = 1) l ON d.doc_id = l.doc_id""",
    "nearest_reference": f"WITH {_EMB_POINTS} SELECT vec_id, nearest_label FROM near",
    "parking_enriched": f"""
WITH {_EMB_POINTS}
SELECT e.vec_id, e.label, CAST(DATE '2024-01-01' + CAST(e.vec_id AS INTEGER) AS DATE) AS fecha,
       dayname(DATE '2024-01-01' + CAST(e.vec_id AS INTEGER)) AS dia_semana, n.nearest_label
FROM embeddings e LEFT JOIN near n ON e.vec_id = n.vec_id""",
    "quality_checks": _CHECKS,
    "clean_checks": _CLEAN_CHECKS,
    "quality_report": f"SELECT dataset, check_type, \"column\", passed, details FROM ({_CHECKS})",
    "quality_summary": f"""
SELECT dataset, check_type, CAST(SUM(CAST(passed AS INTEGER)) AS BIGINT) AS passed_count,
       CAST(COUNT(*) AS BIGINT) AS total_count,
       CAST(SUM(CAST(passed AS INTEGER)) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE) AS pass_rate
FROM ({_CHECKS}) GROUP BY dataset, check_type""",
    "failed_checks": f"SELECT * FROM ({_CHECKS}) WHERE NOT passed",
    "accepted_values_check": _single_check("orders", "orders", 0, "accepted_values", "o_orderstatus",
                                           "COUNT_IF(o_orderstatus NOT IN ('F', 'O'))",
                                           " values outside the accepted list"),
    "referential_check": _single_check(
        "documents", "documents o LEFT JOIN (SELECT DISTINCT doc_id AS parent FROM labels) p ON o.doc_id = p.parent",
        0, "references", "doc_id", "COUNT_IF(o.doc_id IS NOT NULL AND p.parent IS NULL)", " orphan keys found"),
    "range_check": _single_check("lineitem", "lineitem", 0, "range", "l_discount",
                                 "COUNT_IF(l_discount < 0.0 OR l_discount > 0.05)", " values out of range"),
    "dim_user": """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY usuario_id) AS BIGINT) AS usuario_sk, usuario_id, tipo_usuario
FROM (SELECT usuario_id, tipo_usuario FROM (
        SELECT o_custkey AS usuario_id, c_mktsegment AS tipo_usuario,
               ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, c_mktsegment) AS rn
        FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1)""",
    "dim_station": """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY estacion_id) AS BIGINT) AS estacion_sk, estacion_id
FROM (SELECT s_nationkey AS estacion_id FROM supplier UNION SELECT c_nationkey FROM customer)
WHERE estacion_id IS NOT NULL""",
    "fact_trip": f"""
WITH {_TRIP_STAGING},
du AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY usuario_id) AS BIGINT) AS usuario_sk, usuario_id
       FROM (SELECT DISTINCT usuario_id FROM stg WHERE usuario_id IS NOT NULL)),
ds AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY estacion_id) AS BIGINT) AS estacion_sk, estacion_id
       FROM (SELECT estacion_origen AS estacion_id FROM stg UNION SELECT estacion_destino FROM stg)
       WHERE estacion_id IS NOT NULL)
SELECT u.usuario_sk, o.estacion_sk AS origen_sk, d.estacion_sk AS destino_sk,
       t.distancia_m, t.calorias, t.co2_evitado_g, t.duracion_segundos, t.fecha_hora_inicio, t.fecha_hora_fin
FROM trips t JOIN du u ON t.usuario_id = u.usuario_id
     JOIN ds o ON t.estacion_origen = o.estacion_id
     JOIN ds d ON t.estacion_destino = d.estacion_id""",
    "dim_parking": """
SELECT aparcamiento_id, nombre, capacidad_total, CAST(tarifa_hora_euros AS DECIMAL(10,2)) AS tarifa_hora_euros
FROM (SELECT s_suppkey AS aparcamiento_id, s_name AS nombre, s_nationkey AS capacidad_total,
             s_acctbal AS tarifa_hora_euros,
             ROW_NUMBER() OVER (PARTITION BY s_suppkey ORDER BY s_name, s_nationkey, s_acctbal) AS rn
      FROM supplier) WHERE rn = 1""",
    "dim_district": """
SELECT n.n_nationkey AS distrito_id, n.n_name AS nombre, r.r_name AS region,
       CAST(COALESCE(p.poblacion, 0) AS BIGINT) AS poblacion
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT c_nationkey, COUNT(*) AS poblacion FROM customer GROUP BY c_nationkey) p
  ON n.n_nationkey = p.c_nationkey""",
    "fact_parking": """
SELECT l.l_suppkey AS aparcamiento_id, CAST(l.l_shipdate AS DATE) AS fecha,
       CAST(hour(l.l_shipdate) AS INTEGER) AS hora,
       CAST(l.l_discount * 100 AS DECIMAL(5,2)) AS porcentaje_ocupacion, s.s_nationkey AS distrito_id
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "incremental_load": """
WITH existing AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'),
cand AS (SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id
                 ORDER BY ts, user_id, event_type, value, props) AS rn
          FROM events WHERE ts >= TIMESTAMP '2024-01-10') WHERE rn = 1)
SELECT * FROM existing
UNION ALL
SELECT * FROM cand WHERE event_id NOT IN (SELECT event_id FROM existing)""",
    "atomic_load": """
WITH loaded AS (
  SELECT 'orders' AS loaded, o_orderdate AS day, o_totalprice AS amount FROM orders
  UNION ALL
  SELECT 'lines', l_shipdate, min(l_extendedprice) FROM lineitem GROUP BY l_orderkey, l_linenumber, l_shipdate)
SELECT loaded, CAST(year(day) * 100 + month(day) AS INTEGER) AS period, count(*) AS n_rows,
       CAST(sum(round(amount * 100)) AS BIGINT) AS cents
FROM loaded GROUP BY loaded, period""",
    "top_routes": f"""
WITH {_TRIP_STAGING}
SELECT estacion_origen || ' → ' || estacion_destino AS ruta, CAST(COUNT(*) AS BIGINT) AS total_viajes
FROM trips GROUP BY estacion_origen, estacion_destino ORDER BY total_viajes DESC, ruta LIMIT 10""",
    "top_routes_sql": f"""
WITH {_TRIP_STAGING}
SELECT estacion_origen || ' → ' || estacion_destino AS ruta, CAST(COUNT(*) AS BIGINT) AS total_viajes
FROM trips GROUP BY estacion_origen, estacion_destino ORDER BY total_viajes DESC, ruta LIMIT 10""",
    "top_routes_by_type": f"""
WITH {_TRIP_STAGING},
counts AS (SELECT tipo_usuario, estacion_origen || ' → ' || estacion_destino AS ruta,
                  CAST(COUNT(*) AS BIGINT) AS total_viajes
           FROM trips GROUP BY tipo_usuario, estacion_origen, estacion_destino)
SELECT tipo_usuario, ruta, total_viajes FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tipo_usuario ORDER BY total_viajes DESC, ruta) AS rnk FROM counts)
WHERE rnk <= 10""",
    "stats_by_type": f"""
WITH {_TRIP_STAGING}
SELECT tipo_usuario, CAST(COUNT(*) AS BIGINT) AS total_viajes,
       {_ROUND1.format(c='duracion_segundos')} AS duracion_media_segundos,
       {_ROUND1.format(c='distancia_m')} AS distancia_media_metros,
       {_ROUND1.format(c='calorias')} AS calorias_media,
       {_ROUND1.format(c='co2_evitado_g')} AS co2_evitado_medio_g
FROM trips GROUP BY tipo_usuario""",
    "segment_share": f"""
WITH {_CUSTOMER_SUMMARY},
seg AS (SELECT customer_segment, CAST(COUNT(customer_id) AS BIGINT) AS customer_count,
               CAST(SUM(CAST(total_spend AS DECIMAL(38,4))) AS DOUBLE) AS total_spend,
               CAST(ROUND(CAST(AVG(average_spend) AS DECIMAL(38,10)), 2) AS DOUBLE) AS average_spend,
               CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
        FROM cs GROUP BY customer_segment)
SELECT *, CAST(customer_count AS DOUBLE) / (SELECT CAST(SUM(CAST(customer_count AS DECIMAL(38,4))) AS DOUBLE) FROM seg) * CAST(100 AS DOUBLE)
            AS percent_of_customers,
          total_spend / (SELECT CAST(SUM(CAST(total_spend AS DECIMAL(38,4))) AS DOUBLE) FROM seg) * CAST(100 AS DOUBLE) AS percent_of_revenue
FROM seg""",
    "segment_value": f"WITH {_CUSTOMER_SUMMARY}, {_SEGMENT_VALUE} SELECT * FROM sv",
    "category_efficiency": f"WITH {_PRODUCT_PERF}, {_CATEGORY_EFF} SELECT * FROM ce",
    "rfm_top5": f"""
WITH {_CUSTOMER_SUMMARY},
r AS (SELECT rfm_segment, CAST(COUNT(customer_id) AS BIGINT) AS customer_count,
             CAST(SUM(CAST(total_spend AS DECIMAL(38,4))) AS DOUBLE) AS total_revenue,
             CAST(SUM(transaction_count) AS BIGINT) AS transaction_count
      FROM cs GROUP BY rfm_segment)
SELECT *, CAST(customer_count AS DOUBLE) / (SELECT CAST(SUM(CAST(customer_count AS DECIMAL(38,4))) AS DOUBLE) FROM r) * CAST(100 AS DOUBLE)
            AS percent_customers,
          total_revenue / (SELECT CAST(SUM(CAST(total_revenue AS DECIMAL(38,4))) AS DOUBLE) FROM r) * CAST(100 AS DOUBLE) AS percent_revenue
FROM r ORDER BY total_revenue DESC, rfm_segment LIMIT 5""",
    "top_products": f"""
WITH {_PRODUCT_PERF}
SELECT product_id, product_name, category, sales_count, CAST(total_revenue AS DOUBLE) AS total_revenue, average_price
FROM pp ORDER BY total_revenue DESC, product_id LIMIT 10""",
    "recommendations": f"""
WITH {_CUSTOMER_SUMMARY}, {_SEGMENT_VALUE}, {_PRODUCT_PERF}, {_CATEGORY_EFF}
SELECT (SELECT category FROM ce ORDER BY total_revenue DESC, category LIMIT 1) AS top_category,
       (SELECT customer_segment FROM sv ORDER BY avg_customer_value DESC, customer_segment LIMIT 1) AS valuable_segment,
       (SELECT category FROM ce ORDER BY revenue_per_product DESC, category LIMIT 1) AS efficient_category""",
    "method_totals": """
SELECT o_orderpriority, CAST(COUNT(*) AS BIGINT) AS transaction_count,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS total_sales,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) / COUNT(o_totalprice) AS average_sale
FROM orders GROUP BY o_orderpriority""",
    "customer_segmentation_cte": """
WITH ct AS (
  SELECT c.c_custkey, r.r_name AS region, c.c_mktsegment AS customer_segment,
         COUNT(o.o_orderkey) AS transaction_count, SUM(CAST(o.o_totalprice AS DECIMAL(38,4))) AS total_spend
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN orders o ON c.c_custkey = o.o_custkey
  GROUP BY c.c_custkey, r.r_name, c.c_mktsegment)
SELECT region, customer_segment, CAST(COUNT(*) AS BIGINT) AS customer_count,
       CAST(SUM(total_spend) AS DOUBLE) AS total_revenue,
       CAST(SUM(total_spend) AS DOUBLE) / COUNT(total_spend) AS avg_customer_spend
FROM ct GROUP BY region, customer_segment""",
    "monthly_summary": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(COUNT(*) AS BIGINT) AS order_count,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS total_amount,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) / COUNT(o_totalprice) AS avg_amount
FROM orders GROUP BY 1, 2""",
    "monthly_pivot": "SELECT strftime(o_orderdate, '%Y-%m') AS month_year, " + ", ".join(
        f"COALESCE(CAST(SUM(CASE WHEN c_mktsegment = '{s}' THEN CAST(o_totalprice AS DECIMAL(38,4)) END) AS DOUBLE), "
        f"0.0) AS {s}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
    "fact_dim_join": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.p_name, l.l_extendedprice
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
ORDER BY l.l_extendedprice DESC, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.p_name LIMIT 20""",
    "density_vs_transport": """
SELECT n.n_nationkey, n.n_name, CAST(COALESCE(s.n, 0) AS BIGINT) AS n_suppliers,
       CAST(COALESCE(c.n, 0) AS BIGINT) AS n_customers,
       CASE WHEN COALESCE(s.n, 0) = 0 THEN NULL
            ELSE CAST(COALESCE(c.n, 0) AS DOUBLE) / CAST(s.n AS DOUBLE) END AS customers_per_supplier
FROM nation n
LEFT JOIN (SELECT s_nationkey, COUNT(*) AS n FROM supplier GROUP BY 1) s ON n.n_nationkey = s.s_nationkey
LEFT JOIN (SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1) c ON n.n_nationkey = c.c_nationkey""",
    "lineage_trace": """
WITH RECURSIVE e AS (
  SELECT DISTINCT 'conv-' || CAST(a.conv_id AS VARCHAR) AS src_b, 'turn-' || CAST(a.turn AS VARCHAR) AS src_o,
         'conv-' || CAST(b.conv_id AS VARCHAR) AS dst_b, 'turn-' || CAST(b.turn AS VARCHAR) AS dst_o
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
starts AS (SELECT 'conv-' || CAST(conv_id AS VARCHAR) AS b, 'turn-' || CAST(MAX(turn) AS VARCHAR) AS o
           FROM conversations GROUP BY conv_id),
walk(sb, so, b, o, depth) AS (
  SELECT b, o, b, o, 0 FROM starts
  UNION ALL
  SELECT w.sb, w.so, e.src_b, e.src_o, w.depth + 1 FROM walk w JOIN e ON e.dst_b = w.b AND e.dst_o = w.o)
SELECT sb AS start_bucket, so AS start_object, b AS bucket, o AS object, CAST(MIN(depth) AS INTEGER) AS depth
FROM walk WHERE depth > 0 AND NOT (b = sb AND o = so) GROUP BY sb, so, b, o""",
    "lineage_history": """
WITH RECURSIVE conv AS (SELECT DISTINCT conv_id, turn, role FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
ends AS (SELECT conv_id, max(turn) AS last FROM conv GROUP BY conv_id),
base AS (
  SELECT TIMESTAMP '2024-01-01' + (conv_id * 100 + turn) * INTERVAL 1 MINUTE AS ts, conv_id, turn, role,
         CASE WHEN turn > 0 THEN 'conv-' || conv_id WHEN conv_id % 30 = 0 THEN 'conv-' || conv_id
              WHEN conv_id % 7 = 0 THEN 'multiple' WHEN b.last IS NOT NULL THEN 'conv-' || (conv_id - 1) END AS sb,
         CASE WHEN turn > 0 THEN 'turn-' || (turn - 1) WHEN conv_id % 30 = 0 THEN 'turn-' || e.last
              WHEN conv_id % 7 = 0 THEN NULL WHEN b.last IS NOT NULL THEN 'turn-' || b.last END AS so
  FROM conv JOIN ends e USING (conv_id) LEFT JOIN (SELECT conv_id + 1 AS conv_id, last FROM ends) b USING (conv_id)
), made AS (SELECT ts, sb, so, 'conv-' || conv_id AS tb, 'turn-' || turn AS tob, role, conv_id, turn FROM base WHERE sb IS NOT NULL),
rec AS (
  SELECT ts, sb, so, tb, tob, role FROM made
  UNION ALL SELECT ts + INTERVAL 1 HOUR, 'conv-' || conv_id, 'turn-' || (turn + 1), tb, tob, role FROM made WHERE turn % 3 = 0
  UNION ALL SELECT ts, 'zone', 'other', tb, tob, role FROM made WHERE turn % 5 = 0
), pick AS (
  SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY tb, tob ORDER BY ts, sb NULLS FIRST, so NULLS FIRST, role NULLS FIRST) = 1
), walk AS (
  SELECT tb AS start_b, tob AS start_o, 0 AS pos, pick.*, [tb || '/' || tob] AS seen
  FROM pick JOIN ends ON tb = 'conv-' || conv_id AND tob = 'turn-' || last
  UNION ALL
  SELECT w.start_b, w.start_o, w.pos + 1, p.ts, p.sb, p.so, p.tb, p.tob, p.role, list_append(w.seen, p.tb || '/' || p.tob)
  FROM walk w JOIN pick p ON p.tb = w.sb AND p.tob = w.so WHERE NOT list_contains(w.seen, p.tb || '/' || p.tob)
), rows AS (
  SELECT start_b, start_o, ts, sb, so, tb, tob, role, CAST(NULL AS VARCHAR) AS note, pos AS place FROM walk
  UNION ALL SELECT start_b, start_o, ts, NULL, NULL, NULL, NULL, role, 'Built from several source datasets.', pos + 1 FROM walk WHERE sb = 'multiple'
)
SELECT start_b AS start_bucket, start_o AS start_object,
       CAST(row_number() OVER (PARTITION BY start_b, start_o ORDER BY place DESC) AS INTEGER) AS seq, ts AS "timestamp",
       sb AS source_bucket, so AS source_object, tb AS target_bucket, tob AS target_object, role AS transformation, note FROM rows""",
    "metadata_catalog": _PROFILE_SQL,
    "policy_grants": f"""
SELECT t.object_name, t.zone, g.action, unnest(g.roles) AS role
FROM (SELECT object_name, {_ZONE_OF} AS zone FROM ({_PROFILE_SQL}) WHERE rows > 0) t JOIN {_GRANTS} ON g.zone = t.zone""",
    "retention_report": """
SELECT 'orders' AS dataset, 'raw-ingestion-zone' AS zone, '90 days' AS retention_policy,
       CAST(COUNT(*) AS BIGINT) AS total_rows,
       CAST(COUNT_IF(o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 90 DAY) AS BIGINT) AS expired_rows,
       MIN(o_orderdate) AS oldest, MAX(o_orderdate) AS newest FROM orders
UNION ALL
SELECT 'lineitem', 'process-zone', '180 days', CAST(COUNT(*) AS BIGINT),
       CAST(COUNT_IF(l_shipdate < TIMESTAMP '1999-01-01' - INTERVAL 180 DAY) AS BIGINT),
       MIN(l_shipdate), MAX(l_shipdate) FROM lineitem
UNION ALL
SELECT 'events', 'access-zone', '365 days', CAST(COUNT(*) AS BIGINT),
       CAST(COUNT_IF(ts < TIMESTAMP '2025-01-10' - INTERVAL 365 DAY) AS BIGINT), MIN(ts), MAX(ts) FROM events""",
    "masked_customers": "SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "csv_roundtrip": "SELECT * FROM documents",
    "json_roundtrip": "SELECT * FROM documents",
    "sql_dump_roundtrip": "SELECT * FROM documents",
}
