"""Declared schemas of the city datasets (read as text first, then safe-cast by the clean specs)."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
          "timestamp": T.TimestampType(), "date": T.DateType(), "boolean": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ]))
    return T.StructType(fields)


def all_text(schema: T.StructType) -> T.StructType:
    """Same column names, every column a string: the raw read of a CSV."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


# Column names and types of the source datasets (must match the source files).
TRAFFIC = _struct("sensor_id int, fecha_hora timestamp, total_vehiculos int, coches int, motos int, "
                  "camiones int, buses int, velocidad_media_kmh int, nivel_congestion string")
TRIPS = _struct("id int, usuario_id int, tipo_usuario string, estacion_origen int, estacion_destino int, "
                "fecha_hora_inicio timestamp, fecha_hora_fin timestamp, duracion_segundos int, "
                "distancia_km double, calorias_estimadas int, co2_evitado_gramos int")
PARKING_USAGE = _struct("aparcamiento_id int, fecha date, hora int, plazas_ocupadas int, plazas_libres int, "
                        "porcentaje_ocupacion double")
PARKING_INFO = _struct("aparcamiento_id int, nombre string, direccion string, capacidad_total int, "
                       "plazas_movilidad_reducida int, plazas_vehiculos_electricos int, tarifa_hora_euros double, "
                       "horario string, latitud double, longitud double")
DISTRICTS = _struct("id int, nombre string, poblacion int, superficie_km2 double, densidad_poblacion double, "
                    "latitud double, longitud double, codigo_postal_principal int")
PUBLIC_BUILDINGS = _struct("id int, nombre string, tipo string, distrito_id int, direccion string, latitud double, "
                           "longitud double, superficie_m2 int, año_construccion int, ultimo_renovado int, "
                           "accesibilidad string, certificacion_energetica string")
TRANSIT_LINES = _struct("id int, nombre string, tipo string, longitud_km double, num_paradas int, "
                        "frecuencia_media_min double, año_inauguracion int")
TRANSIT_STATIONS = _struct("id int, nombre string, linea_id int, tipo string, distrito_id int, latitud double, "
                           "longitud double, accesibilidad string, correspondencia boolean, año_inauguracion int")
GREEN_ZONES = _struct("id int, nombre string, tipo string, distrito_id int, superficie_m2 int, latitud double, "
                      "longitud double, año_creacion int, num_especies_vegetales int, tiene_area_infantil boolean, "
                      "tiene_area_deportiva boolean, tiene_area_canina boolean")
ENERGY = _struct("id int, edificio_id int, fecha date, consumo_electrico_kwh double, consumo_gas_m3 double, "
                 "consumo_agua_m3 double, emisiones_co2_kg double, coste_total_euros double")
CITIZEN_REPORTS = _struct("id int, categoria string, descripcion string, fecha_reporte string, "
                          "fecha_resolucion string, latitud double, longitud double")

# Table names inside the municipal SQL dump.
DUMP_TABLES = {
    "distritos": DISTRICTS,
    "edificios_publicos": PUBLIC_BUILDINGS,
    "lineas_transporte": TRANSIT_LINES,
    "estaciones_transporte": TRANSIT_STATIONS,
    "zonas_verdes": GREEN_ZONES,
    "consumo_energetico": ENERGY,
}
