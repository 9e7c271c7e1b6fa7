"""End-to-end city flow on small raw files in the shape of the source data (with injected defects)."""

import datetime as dt
import json
import os

from zonelake.plans import city

from tests.test_sources import DUMP

TRAFFIC = ["sensor_id,fecha_hora,total_vehiculos,coches,motos,camiones,buses,velocidad_media_kmh,nivel_congestion"]
for h in range(3):
    for sensor in (1, 2):
        TRAFFIC.append(f"{sensor},2024-12-01 {h:02d}:00:00,{100 + h},{80 + h},10,5,{5 + sensor},40,"
                       f"{['Baja', 'Moderada', 'Muy Alta'][h]}")
TRAFFIC.append(TRAFFIC[1])                                           # duplicate row
TRAFFIC.append("3,not-a-date,12,10,1,1,0,30,Alta")                   # unparsable timestamp

TRIPS = ["id,usuario_id,tipo_usuario,estacion_origen,estacion_destino,fecha_hora_inicio,fecha_hora_fin,"
         "duracion_segundos,distancia_km,calorias_estimadas,co2_evitado_gramos"]
TRIPS += ["1,10,Anual,1,2,2024-12-01 08:00:00,2024-12-01 08:10:00,600,2.35,60,300",
          "2,11,Ocasional,1,2,2024-12-01 09:00:00,2024-12-01 09:20:00,1200,4.5,120,700",
          "3,10,Anual,2,3,2024-12-01 10:00:00,2024-12-01 10:05:00,300,1.05,30,150",
          "4,12,Anual,1,2,2024-12-01 11:00:00,2024-12-01 11:10:00,600,abc,60,300"]

USAGE = ["aparcamiento_id,fecha,hora,plazas_ocupadas,plazas_libres,porcentaje_ocupacion"]
USAGE += [f"{p},2024-12-01,{h},{10 * h},{100 - 10 * h},{10.0 * h}" for p in (1, 2) for h in (8, 9)]
INFO = ["aparcamiento_id,nombre,direccion,capacidad_total,plazas_movilidad_reducida,plazas_vehiculos_electricos,"
        "tarifa_hora_euros,horario,latitud,longitud",
        "1,Plaza Mayor,Calle A 1,300,5,4,2.95,24 horas,40.4155,-3.7074",
        "2,Colon,Calle B 2,400,6,8,3.10,07:00 - 23:00,40.4250,-3.6900"]


def _write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_city_flow_end_to_end_and_idempotent(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    paths = {"traffic": _write(f"{raw}/traffic.csv", TRAFFIC), "trips": _write(f"{raw}/trips.csv", TRIPS),
             "parking_usage": _write(f"{raw}/usage.csv", USAGE), "parking_info": _write(f"{raw}/info.csv", INFO),
             "dump": _write(f"{raw}/dump.sql", [DUMP])}
    with open(f"{raw}/reports.json", "w") as f:
        json.dump([{"id": 1, "categoria": "Limpieza", "descripcion": "x", "fecha_reporte": "2024-12-01 10:00:00",
                    "fecha_resolucion": None, "latitud": 40.41, "longitud": -3.70}], f)
    paths["citizen_reports"] = f"{raw}/reports.json"
    root = os.path.join(tmp_dir, "lake")
    now = dt.datetime(2024, 12, 2)

    manifest = city.ingest(spark, raw, root)
    assert manifest.count() == 6
    failures = {}
    clean = city.clean_zone(spark, {**paths, "citizen_reports": paths["citizen_reports"]}, root, now, failures)
    assert set(clean) >= {"traffic", "trips", "parking", "districts", "green_zones", "citizen_reports"}
    assert failures == {}
    traffic = spark.read.parquet(clean["traffic"])
    assert traffic.count() == 7                                   # duplicate removed, bad date kept as null
    checks = spark.read.parquet(f"{root}/govern-zone-metadata/quality_checks")
    failed = {(r.dataset, r.column) for r in checks.where("NOT passed").collect()}
    assert ("traffic_clean", "fecha_hora") in failed

    access = city.access_zone(spark, clean, root, now)
    prof = {r.hora: r for r in spark.read.parquet(access["traffic_hourly"]).collect()}
    assert prof["00:00:00"].total_vehiculos == 200 and prof["02:00:00"].nivel_congestion == 4.0
    parking = spark.read.parquet(access["parking"])
    assert {r.distrito_id for r in parking.collect()} == {72}     # both lots are nearest to district 72
    assert "plazas_ocupadas" not in parking.columns and parking.first().dia_semana == "Sunday"

    first = city.load_warehouse(spark, access, clean, root)
    again = city.load_warehouse(spark, access, clean, root)
    assert first["appended"]["fact_viaje"] == 4                   # the trip with a bad distance loads with null
    assert all(v == 0 for v in again["appended"].values())        # a second load adds nothing
    p = first["paths"]
    assert spark.read.parquet(p["dim_usuario"]).count() == 3
    assert spark.read.parquet(p["dim_estacion"]).count() == 3
    rep = city.trip_reports(spark, p)
    assert [tuple(r) for r in rep["top_routes"].collect()] == [("1 → 2", 3), ("2 → 3", 1)]
    stats = {r.tipo_usuario: r for r in rep["stats_by_type"].collect()}
    assert stats["Anual"].total_viajes == 3 and stats["Ocasional"].distancia_media_metros == 4500.0
    lineage = spark.read.parquet(f"{root}/govern-zone-metadata/lineage")
    assert lineage.where("target.bucket = 'access-zone'").count() == 3


def test_sources_fail_independently(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    paths = {"traffic": _write(f"{raw}/t.csv", TRAFFIC), "citizen_reports": f"{raw}/missing.json"}
    failures = {}
    clean = city.clean_zone(spark, paths, os.path.join(tmp_dir, "lake"), dt.datetime(2024, 12, 2), failures)
    assert set(clean) == {"traffic"} and set(failures) == {"citizen_reports"}


def test_city_run_all_cli(spark, tmp_dir, capsys):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    args = ["--root", os.path.join(tmp_dir, "lake"),
            "--traffic", _write(f"{raw}/t.csv", TRAFFIC), "--trips", _write(f"{raw}/v.csv", TRIPS),
            "--parking-usage", _write(f"{raw}/u.csv", USAGE), "--parking-info", _write(f"{raw}/i.csv", INFO),
            "--dump", _write(f"{raw}/d.sql", [DUMP])]
    city.main(args)
    out = capsys.readouterr().out
    assert "== top_routes" in out and "1 → 2" in out and "== stats_by_type" in out


def test_keep_first_follows_the_file_and_every_rule_is_checked(spark, tmp_dir):
    dump = "\n".join([
        "INSERT INTO distritos (id, nombre, poblacion, superficie_km2, densidad_poblacion, latitud, longitud, codigo_postal_principal) VALUES",
        "(1, 'Zeta first', -5, 1.0, 2.0, 95.0, -3.0, 1),", "(1, 'Alfa second', 10, 1.0, 2.0, 40.0, -3.0, 1);",
        "INSERT INTO lineas_transporte (id, nombre, tipo, longitud_km, num_paradas, frecuencia_media_min, año_inauguracion) VALUES",
        "(1, 'L1', 'Globo', -1.0, 3, 4.0, 1990);"])
    usage = ["aparcamiento_id,fecha,hora,plazas_ocupadas,plazas_libres,porcentaje_ocupacion", "1,2024-12-01,25,5,5,150.0", "1,2024-12-01,25,1,9,10.0"]
    info = ["aparcamiento_id,nombre,direccion,capacidad_total,plazas_movilidad_reducida,plazas_vehiculos_electricos,tarifa_hora_euros,horario,latitud,longitud",
            "1,Zoco,calle,10,1,1,2.0,24h,40.0,-3.0", "1,Alto,calle,10,1,1,2.0,24h,40.0,-3.0"]
    raw = {"dump": _write(os.path.join(tmp_dir, "d.sql"), [dump]), "parking_usage": _write(os.path.join(tmp_dir, "u.csv"), usage),
           "parking_info": _write(os.path.join(tmp_dir, "i.csv"), info)}
    root, failures = os.path.join(tmp_dir, "lake"), {}
    clean = city.clean_zone(spark, raw, root, dt.datetime(2024, 12, 2), failures)
    assert failures == {}
    districts = spark.read.parquet(clean["districts"])
    assert [r.nombre for r in districts.collect()] == ["Zeta first"] and "_ord" not in districts.columns
    assert [(r.nombre, r.porcentaje_ocupacion) for r in spark.read.parquet(clean["parking"]).collect()] == [("Zoco", 150.0)]
    checks = spark.read.parquet(f"{root}/govern-zone-metadata/quality_checks").where("not passed")
    failed = {(r.dataset, r.check_type, r.column) for r in checks.collect()}
    assert {("districts_clean", "range", "latitud"), ("districts_clean", "range", "poblacion"), ("lines_clean", "accepted_values", "tipo"),
            ("lines_clean", "range", "longitud_km"), ("parking_clean", "range", "hora"), ("parking_clean", "range", "porcentaje_ocupacion")} <= failed
    assert checks.first().timestamp == dt.datetime(2024, 12, 2)


def test_star_and_foreign_keys_are_checked(spark, tmp_dir):
    root, wh = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "wh")
    tables = {
        "dim_usuario": spark.createDataFrame([(1, 10, "a"), (2, 10, None)], "usuario_sk long, usuario_id int, tipo_usuario string"),
        "dim_estacion": spark.createDataFrame([(1, 5), (1, 6)], "estacion_sk long, estacion_id int"),
        "fact_viaje": spark.createDataFrame([(1, 1, 9, 60), (3, 1, 1, None)], "usuario_sk long, origen_sk long, destino_sk long, duracion_segundos int"),
        "dim_distrito": spark.createDataFrame([(1,), (None,)], "distrito_id int")}
    for name, df in tables.items():
        df.write.parquet(f"{wh}/{name}")
    paths = {n: f"{wh}/{n}" for n in (*tables, "dim_aparcamiento", "fact_parking_ocupacion")}
    checks = city.star_checks(spark, paths, root, dt.datetime(2024, 12, 2))
    failed = {(r.dataset, r.check_type, r.column): r.bad_count for r in checks.where("not passed").collect()}
    assert failed == {("dim_usuario", "unique", "usuario_id"): 1, ("dim_usuario", "no_nulls", "tipo_usuario"): 1,
                      ("dim_estacion", "unique", "estacion_sk"): 1, ("fact_viaje", "no_nulls", "duracion_segundos"): 1,
                      ("fact_viaje", "references", "usuario_sk"): 1, ("fact_viaje", "references", "destino_sk"): 1,
                      ("dim_distrito", "unique", "distrito_id"): 1, ("dim_distrito", "no_nulls", "distrito_id"): 1}
    clean = {}
    for name, rows_ in (("districts", [(1, None)]), ("buildings", [(7, 1), (8, 2)]), ("energy", [(1, 7), (2, 99)])):
        clean[name] = f"{wh}/clean-{name}"
        spark.createDataFrame(rows_, "id int, ref int").withColumnRenamed("ref", "edificio_id" if name == "energy" else "distrito_id").write.parquet(clean[name])
    failed = {(r.dataset, r.column, r.bad_count) for r in city.foreign_key_checks(spark, clean, root).where("not passed").collect()}
    assert failed == {("buildings_clean", "distrito_id", 1), ("energy_clean", "edificio_id", 1)}
    assert spark.read.parquet(f"{root}/govern-zone-metadata/quality_checks").count() == checks.count() + 2
