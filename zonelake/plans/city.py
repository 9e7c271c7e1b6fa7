"""The city-data flow as Spark jobs: raw -> clean -> access -> star schema -> reports.

Paths are parameters: ``raw`` maps a dataset name to its raw file, ``root`` is the
lake root (a shared file system on a cluster) under which every zone is a folder.
Governance tables (quality checks, lineage, dataset metadata) are appended under
``root/govern-zone-metadata``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake import schemas
from zonelake.operators import enrich, quality as Q, reports, warehouse
from zonelake.operators.clean import CITY_SPECS, clean
from zonelake.operators.governance import LINEAGE_SCHEMA
from zonelake.session import read_if_there, stored_table
from zonelake.sources.binary import file_manifest
from zonelake.sources.io import publish, publish_observed, read_dataset, utc
from zonelake.sources.sqldump import read_sql_dump

# Ordinal of the congestion levels, vehicle count columns, star-schema decimal types.
CONGESTION_LEVELS = {"Baja": 1, "Moderada": 2, "Alta": 3, "Muy Alta": 4}
VEHICLE_COUNTS = ["total_vehiculos", "coches", "motos", "camiones", "buses"]
DIM_PARKING_TYPES = {"tarifa_hora_euros": "decimal(4,2)", "latitud": "decimal(9,6)", "longitud": "decimal(9,6)"}
DIM_DISTRICT_TYPES = {"superficie_km2": "decimal(6,2)", "densidad_poblacion": "decimal(10,2)",
                      "latitud": "decimal(9,6)", "longitud": "decimal(9,6)"}

# Keys, columns that must be filled, and foreign keys (column, table, column) of the clean and star tables.
CLEAN_FOREIGN_KEYS = {"buildings": (("distrito_id", "districts", "id"),), "energy": (("edificio_id", "buildings", "id"),),
                      "green_zones": (("distrito_id", "districts", "id"),),
                      "stations": (("linea_id", "lines", "id"), ("distrito_id", "districts", "id"))}
STAR_KEYS = {"dim_usuario": ("usuario_sk", "usuario_id"), "dim_estacion": ("estacion_sk", "estacion_id"),
             "dim_aparcamiento": ("aparcamiento_id",), "dim_distrito": ("distrito_id",)}
STAR_FILLED = {"dim_usuario": ("usuario_sk", "usuario_id", "tipo_usuario"), "dim_estacion": ("estacion_sk", "estacion_id"),
               "fact_viaje": ("usuario_sk", "origen_sk", "destino_sk", "duracion_segundos"),
               "dim_aparcamiento": ("aparcamiento_id",), "dim_distrito": ("distrito_id",),
               "fact_parking_ocupacion": ("aparcamiento_id", "fecha", "hora", "porcentaje_ocupacion", "distrito_id")}
STAR_FOREIGN_KEYS = {"fact_viaje": (("usuario_sk", "dim_usuario", "usuario_sk"), ("origen_sk", "dim_estacion", "estacion_sk"),
                                    ("destino_sk", "dim_estacion", "estacion_sk")),
                     "fact_parking_ocupacion": (("aparcamiento_id", "dim_aparcamiento", "aparcamiento_id"),
                                                ("distrito_id", "dim_distrito", "distrito_id"))}

DUMP_DATASETS = {"distritos": "districts", "edificios_publicos": "buildings", "lineas_transporte": "lines",
                 "estaciones_transporte": "stations", "zonas_verdes": "green_zones",
                 "consumo_energetico": "energy"}


def zone(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _lineage(spark: SparkSession, rows: list[tuple], now: _dt.datetime) -> DataFrame:
    data = [(now, (sb, so), (tb, to), t) for sb, so, tb, to, t in rows]
    return spark.createDataFrame(data, LINEAGE_SCHEMA)


def ingest(spark: SparkSession, raw_dir: str, root: str) -> DataFrame:
    """File manifest of the raw landing folder (hash, size), appended to the govern zone."""
    m = file_manifest(spark, raw_dir, "raw-ingestion-zone")
    _append(m, zone(root, "govern-zone-metadata/file_manifest"))
    return m


def _read_sources(spark: SparkSession, raw: Mapping[str, str]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Typed-as-text frames of every raw source; a source that cannot be read is reported, not fatal."""
    def raw_csv(name, schema):
        return read_dataset(spark, raw[name], "csv", schemas.all_text(schema), multiline=True, placed=True)

    readers = {
        "traffic": lambda: {"traffic": raw_csv("traffic", schemas.TRAFFIC)},
        "trips": lambda: {"trips": raw_csv("trips", schemas.TRIPS)},
        "parking_usage": lambda: {"parking": enrich.left_enrich(
            raw_csv("parking_usage", schemas.PARKING_USAGE),
            raw_csv("parking_info", schemas.PARKING_INFO).withColumnsRenamed({"_file": "_info_file", "_ord": "_info_ord"}),
            ["aparcamiento_id"], ["_info_file", "_info_ord"]).drop("_info_file", "_info_ord")},
        "dump": lambda: {DUMP_DATASETS[t]: df for t, df in read_sql_dump(spark, raw["dump"], schemas.DUMP_TABLES).items()},
        "citizen_reports": lambda: {"citizen_reports": read_dataset(
            spark, raw["citizen_reports"], "json", schemas.CITIZEN_REPORTS, multiline=True, placed=True)},
    }
    frames, failures = {}, {}
    for name, read in readers.items():
        if name not in raw or (name == "parking_usage" and "parking_info" not in raw):
            continue
        try:
            got = read()
            for df in got.values():
                df.schema  # noqa: B018 - resolve now: a missing path or bad file fails here
            frames.update(got)
        except Exception as exc:  # noqa: BLE001 - one bad source must not stop the others
            failures[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"
    return frames, failures


def clean_zone(spark: SparkSession, raw: Mapping[str, str], root: str,
               now: _dt.datetime | None = None, failures: dict | None = None) -> dict[str, str]:
    """Read, clean, check and publish every raw dataset present in ``raw``.

    ``raw`` keys: traffic, trips, parking_usage, parking_info (CSV), dump (SQL dump),
    citizen_reports (JSON array).  Returns dataset -> clean path.  Sources fail
    independently: a source that cannot be read or cleaned is recorded in
    ``failures`` (when given) and the others are still processed.
    """
    now = utc(now)
    frames, failed = _read_sources(spark, raw)
    typed = _typed_casts()
    out, checks, lineage, metas = {}, [], [], []
    for name, df in frames.items():
        spec = CITY_SPECS[name]
        try:
            df = df.select(*[typed[name][c].alias(c) if c in typed[name] else F.col(f"`{c}`") for c in df.columns])
            path = zone(root, f"clean-zone/{name}")
            # the raw file is read once: row rules are counted by the write, the others read what was written
            cleaned = clean(df, spec)
            meta, metrics = publish_observed(cleaned, path, "clean-zone", name, Q.observed(cleaned, spec.rules()),
                                             properties={"spec": spec.name}, uploaded_at=now)
            chk = Q.run_checks(spark.read.schema(cleaned.schema).parquet(path), spec.name, spec.rules(), now, metrics)
            metas.append(meta)
        except Exception as exc:  # noqa: BLE001 - keep going with the other datasets
            failed[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:300]}"
            continue
        checks.append(chk)
        lineage.append(("raw-ingestion-zone", name, "clean-zone", name, f"clean spec {spec.name}"))
        out[name] = path
    if failures is not None:
        failures.update(failed)
    gov = zone(root, "govern-zone-metadata")
    for c in checks:
        _append(c, f"{gov}/quality_checks")
    for m in metas:
        _append(m, f"{gov}/dataset_metadata")
    if lineage:
        _append(_lineage(spark, lineage, now), f"{gov}/lineage")
    return out


def _typed_casts() -> dict[str, dict]:
    """Safe casts of the raw text columns to the declared types (bad values -> null)."""
    def casts(schema, skip=()):
        return {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields
                if f.name not in skip and f.dataType.simpleString() not in ("string", "timestamp", "date")}
    return {
        "traffic": casts(schemas.TRAFFIC), "trips": casts(schemas.TRIPS),
        "parking": {**casts(schemas.PARKING_USAGE), **casts(schemas.PARKING_INFO)},
        "districts": {}, "buildings": {}, "lines": {}, "stations": {}, "green_zones": {}, "energy": {},
        "citizen_reports": {},
    }


def access_zone(spark: SparkSession, clean: Mapping[str, str], root: str,
                now: _dt.datetime | None = None) -> dict[str, str]:
    """Hourly congestion profile, trip publish, parking with weekday and nearest district."""
    now = utc(now)
    out, lineage = {}, []
    gov = zone(root, "govern-zone-metadata")
    if "traffic" in clean:
        t = spark.read.parquet(clean["traffic"])
        prof = enrich.hourly_profile(t, "fecha_hora", VEHICLE_COUNTS, ["velocidad_media_kmh"], "nivel_congestion",
                                     CONGESTION_LEVELS)
        out["traffic_hourly"] = zone(root, "access-zone/traffic_hourly")
        _append(publish(prof, out["traffic_hourly"], "access-zone", "traffic_hourly", uploaded_at=now),
                f"{gov}/dataset_metadata")
        lineage.append(("clean-zone", "traffic", "access-zone", "traffic_hourly", "hourly aggregation"))
    if "trips" in clean:
        trips = enrich.drop_lenient(spark.read.parquet(clean["trips"]), "id", "Unnamed: 0")
        out["trips"] = zone(root, "access-zone/trips")
        _append(publish(trips, out["trips"], "access-zone", "trips", uploaded_at=now), f"{gov}/dataset_metadata")
        lineage.append(("clean-zone", "trips", "access-zone", "trips", "drop technical id"))
    if "parking" in clean and "districts" in clean:
        p = spark.read.parquet(clean["parking"])
        d = spark.read.parquet(clean["districts"])
        p = enrich.drop_strict(enrich.with_weekday(p, "fecha"), "plazas_ocupadas", "plazas_libres")
        p = enrich.assign_nearest(p, d, "latitud", "longitud", "id", "latitud", "longitud", "distrito_id")
        out["parking"] = zone(root, "access-zone/parking")
        _append(publish(p, out["parking"], "access-zone", "parking", uploaded_at=now), f"{gov}/dataset_metadata")
        lineage.append(("clean-zone", "parking", "access-zone", "parking", "weekday + nearest district"))
    if lineage:
        _append(_lineage(spark, lineage, now), f"{gov}/lineage")
    return out


def load_warehouse(spark: SparkSession, access: Mapping[str, str], clean: Mapping[str, str], root: str) -> dict:
    """Star schema load; dimensions keep their keys and facts are insert-if-absent, so a re-run adds nothing."""
    wh = zone(root, "warehouse")
    paths = {n: f"{wh}/{n}" for n in ("dim_usuario", "dim_estacion", "fact_viaje", "dim_aparcamiento",
                                      "dim_distrito", "fact_parking_ocupacion")}

    def existing(name):
        return read_if_there(spark, paths[name])

    counts = {}
    if "trips" in access:
        st = spark.read.parquet(access["trips"])
        users_old = existing("dim_usuario")
        attrs = st.groupBy("usuario_id").agg(F.min_by(F.col("tipo_usuario"), F.struct(
            F.col("fecha_hora_inicio"), F.col("tipo_usuario"))).alias("tipo_usuario"))
        new_users = warehouse.extend_dimension(users_old, attrs, ["usuario_id"], "usuario_sk", attrs)
        new_users.select("usuario_sk", "usuario_id", "tipo_usuario").write.mode("append").parquet(paths["dim_usuario"])
        stations = st.select(F.col("estacion_origen").alias("estacion_id")).union(
            st.select(F.col("estacion_destino").alias("estacion_id")))
        new_st = warehouse.extend_dimension(existing("dim_estacion"), stations, ["estacion_id"], "estacion_sk")
        new_st.select("estacion_sk", "estacion_id").write.mode("append").parquet(paths["dim_estacion"])
        staged = st.withColumn("_dist_m", F.col("distancia_km").cast("decimal(8,2)") * 1000) \
            .withColumn("_cal", F.col("calorias_estimadas").cast("decimal(8,2)")) \
            .withColumn("_co2", F.col("co2_evitado_gramos").cast("decimal(8,2)"))
        fact = warehouse.trip_fact(staged, spark.read.parquet(paths["dim_usuario"]),
                                   spark.read.parquet(paths["dim_estacion"]), user_col="usuario_id",
                                   origin_col="estacion_origen", dest_col="estacion_destino",
                                   measures={"distancia_m": "_dist_m", "calorias": "_cal", "co2_evitado_g": "_co2"},
                                   passthrough=["duracion_segundos", "fecha_hora_inicio", "fecha_hora_fin"])
        counts["fact_viaje"] = warehouse.append_new_rows(
            paths["fact_viaje"], fact, ["usuario_sk", "origen_sk", "destino_sk", "fecha_hora_inicio", "fecha_hora_fin"])
    if "parking" in access:
        p = spark.read.parquet(access["parking"])
        dim_p = warehouse.decimal_columns(
            p.select("aparcamiento_id", "nombre", "direccion", "capacidad_total", "plazas_movilidad_reducida",
                     "plazas_vehiculos_electricos", "tarifa_hora_euros", "horario", "latitud", "longitud"),
            DIM_PARKING_TYPES)
        counts["dim_aparcamiento"] = warehouse.append_new_rows(paths["dim_aparcamiento"], dim_p, ["aparcamiento_id"])
        fact_p = p.select("aparcamiento_id", F.col("fecha").cast("date").alias("fecha"), "hora",
                          F.col("porcentaje_ocupacion").cast("decimal(5,2)").alias("porcentaje_ocupacion"),
                          "distrito_id")
        counts["fact_parking_ocupacion"] = warehouse.append_new_rows(
            paths["fact_parking_ocupacion"], fact_p, ["aparcamiento_id", "fecha", "hora"], partition_by=["fecha"])
    if "districts" in clean:
        d = spark.read.parquet(clean["districts"])
        dim_d = warehouse.decimal_columns(
            d.select(F.col("id").alias("distrito_id"), "nombre", "poblacion", "superficie_km2",
                     "densidad_poblacion", F.col("codigo_postal_principal").alias("codigo_postal"), "latitud",
                     "longitud"), DIM_DISTRICT_TYPES)
        counts["dim_distrito"] = warehouse.append_new_rows(paths["dim_distrito"], dim_d, ["distrito_id"])
    return {"paths": paths, "appended": counts}


def _references(spark: SparkSession, tables: Mapping[str, DataFrame], keys: tuple) -> list:
    return [Q.references(column, tables[parent], parent_column) for column, parent, parent_column in keys if parent in tables]


def foreign_key_checks(spark: SparkSession, clean: Mapping[str, str], root: str, now: _dt.datetime | None = None) -> DataFrame | None:
    """Foreign keys between the published clean tables, appended to the quality checks; None if no two related ones are there."""
    tables = {name: spark.read.parquet(path) for name, path in clean.items()}
    found = [Q.run_checks(tables[name], f"{name}_clean", rules, utc(now)) for name, keys in CLEAN_FOREIGN_KEYS.items()
             if name in tables and (rules := _references(spark, tables, keys))]
    return _record_checks(found, root)


def star_checks(spark: SparkSession, paths: Mapping[str, str], root: str, now: _dt.datetime | None = None) -> DataFrame | None:
    """Keys, filled columns and foreign keys of the warehouse tables that exist, appended to the quality checks."""
    tables = {name: df for name, path in paths.items() if (df := read_if_there(spark, path)) is not None}
    found = [Q.run_checks(df, name, Q.no_nulls(*STAR_FILLED.get(name, ())) + Q.unique(*STAR_KEYS.get(name, ()))
                          + _references(spark, tables, STAR_FOREIGN_KEYS.get(name, ())), utc(now)) for name, df in tables.items()]
    return _record_checks(found, root)


def _record_checks(found: list[DataFrame], root: str) -> DataFrame | None:
    if not found:
        return None
    checks = stored_table(reduce(DataFrame.unionByName, found), "city-checks")
    _append(checks, zone(root, "govern-zone-metadata/quality_checks"))
    return checks


def trip_reports(spark: SparkSession, warehouse_paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The three star-schema reports: top-10 routes, top-10 per user type, statistics per user type."""
    f = spark.read.parquet(warehouse_paths["fact_viaje"])
    u = spark.read.parquet(warehouse_paths["dim_usuario"])
    s = spark.read.parquet(warehouse_paths["dim_estacion"])
    o = s.select(F.col("estacion_sk").alias("origen_sk"), F.col("estacion_id").alias("o"))
    d = s.select(F.col("estacion_sk").alias("destino_sk"), F.col("estacion_id").alias("d"))
    stats = f.join(u, "usuario_sk")

    def routes(trips, *group):
        # aggregate on the surrogate keys first, then attach the station ids (labels)
        pairs = trips.groupBy(*group, "origen_sk", "destino_sk").agg(F.count(F.lit(1)).alias("_n"))
        return pairs.join(o, "origen_sk").join(d, "destino_sk")

    return {
        "top_routes": reports.top_routes(routes(f), "o", "d", 10, weight="_n"),
        "top_routes_by_type": reports.top_routes_by_group(routes(stats, "tipo_usuario"), "tipo_usuario", "o", "d", 10,
                                                          weight="_n"),
        "stats_by_type": reports.group_stats(stats, "tipo_usuario", {
            "duracion_media_segundos": "duracion_segundos", "distancia_media_metros": "distancia_m",
            "calorias_media": "calorias", "co2_evitado_medio_g": "co2_evitado_g"}),
    }


def run_all(spark: SparkSession, raw: Mapping[str, str], raw_dir: str | None, root: str) -> dict[str, DataFrame]:
    """Every stage in order; returns the three trip reports (lazy)."""
    if raw_dir:
        ingest(spark, raw_dir, root)
    clean = clean_zone(spark, raw, root)
    access = access_zone(spark, clean, root)
    foreign_key_checks(spark, clean, root)
    wh = load_warehouse(spark, access, clean, root)
    star_checks(spark, wh["paths"], root)
    return trip_reports(spark, wh["paths"]) if "fact_viaje" in wh["appended"] else {}


def main(argv: list[str] | None = None) -> None:
    """``python -m zonelake.plans.city --root LAKE --traffic f.csv --trips f.csv ... --dump f.sql``."""
    import argparse

    from zonelake.session import build_session

    ap = argparse.ArgumentParser(description="city data: raw files -> lake zones -> star schema -> reports")
    ap.add_argument("--root", required=True, help="lake root (shared file system on a cluster)")
    ap.add_argument("--raw-dir", help="landing folder to hash into the file manifest")
    for name in ("traffic", "trips", "parking_usage", "parking_info", "dump", "citizen_reports"):
        ap.add_argument(f"--{name.replace('_', '-')}", dest=name)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    raw = {k: v for k, v in vars(args).items()
           if k in ("traffic", "trips", "parking_usage", "parking_info", "dump", "citizen_reports") and v}
    spark = build_session(args.master)
    for name, df in run_all(spark, raw, args.raw_dir, args.root).items():
        print(f"== {name}")
        df.show(20, truncate=False)


if __name__ == "__main__":
    main()
