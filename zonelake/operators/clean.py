"""Declarative cleaning: one engine, one spec per dataset.

A spec lists safe casts (bad values become null), the deduplication (full row or
keep-first on a key) and the observe-only quality rules.  ``clean`` is one
``select`` of cast expressions followed by the dedup: a single narrow stage plus
one aggregation shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.functions.scalar import safe_cast, safe_timestamp, to_bool
from zonelake.operators import quality as Q
from zonelake.operators.dedup import dedup_full, dedup_keep_first


FILE_COLUMNS = ("_file", "_ord", "_pos")


@dataclass(frozen=True)
class CleanSpec:
    name: str
    timestamps: Mapping[str, str | None] = field(default_factory=dict)   # column -> format
    dates: Mapping[str, str | None] = field(default_factory=dict)        # column -> format
    numerics: Mapping[str, str] = field(default_factory=dict)            # column -> Spark type
    booleans: tuple[str, ...] = ()
    json_fields: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)  # out -> (col, path, type)
    dedup: str | tuple[str, ...] | None = None                           # "full", key tuple, or None
    order_by: tuple[str, ...] = ()                                       # "first" for keyed dedup
    no_nulls: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    extra_rules: tuple = ()

    def rules(self) -> list[Q.Rule]:
        return Q.no_nulls(*self.no_nulls) + Q.unique(*self.unique) + list(self.extra_rules)


def _cast_expr(df: DataFrame, name: str, spec: CleanSpec):
    col = F.col(f"`{name}`")
    dtype = df.schema[name].dataType
    if name in spec.timestamps:
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return col                                  # already a datetime: no-op
        return safe_timestamp(col.cast("string"), spec.timestamps[name]).alias(name)
    if name in spec.dates:
        if isinstance(dtype, T.DateType):
            return col
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return col.cast("date").alias(name)
        return F.to_date(safe_timestamp(col.cast("string"), spec.dates[name])).alias(name)
    if name in spec.numerics:
        return safe_cast(col, spec.numerics[name]).alias(name)
    if name in spec.booleans:
        if isinstance(dtype, T.BooleanType):
            return col
        return to_bool(safe_cast(col, "double")).alias(name)
    return col


def clean(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply the casts, the JSON field extraction and the dedup of ``spec``.

    "First" in a keyed dedup is by ``spec.order_by``, else by the place in the files where the
    frame carries it (``FILE_COLUMNS``, dropped from the result).
    """
    places = [c for c in FILE_COLUMNS if c in df.columns]
    if not spec.dedup or spec.dedup == "full":
        df, places = df.drop(*places), []
    exprs = [_cast_expr(df, c, spec) for c in df.columns]
    for out, (src, path, typ) in spec.json_fields.items():
        exprs.append(safe_cast(F.get_json_object(F.col(f"`{src}`"), path), typ).alias(out))
    out = df.select(*exprs)
    if spec.dedup == "full":
        out = dedup_full(out)
    elif spec.dedup:
        out = dedup_keep_first(out, list(spec.dedup), list(spec.order_by) or places or None)
    return out.drop(*places)


def clean_and_check(df: DataFrame, spec: CleanSpec, timestamp=None) -> tuple[DataFrame, DataFrame]:
    """Cleaned frame and its quality-check rows (both lazy)."""
    cleaned = clean(df, spec)
    return cleaned, Q.run_checks(cleaned, spec.name, spec.rules(), timestamp)


def _listed(**columns: tuple) -> tuple:
    return tuple(Q.accepted_values(c, values) for c, values in columns.items())


def _ranges(**columns: tuple) -> tuple:
    return tuple(Q.in_range(c, low, high) for c, (low, high) in columns.items())


# Cleaning specs of the city datasets (casts, dedup keys, not-null, unique, list and range rules).
LATITUDE, LONGITUDE, YEAR, AMOUNT = (-90, 90), (-180, 180), (1000, 2100), (0, None)
TS = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"
CITY_SPECS: dict[str, CleanSpec] = {
    "traffic": CleanSpec("traffic_clean", timestamps={"fecha_hora": TS}, dedup="full",
                         no_nulls=("fecha_hora", "total_vehiculos")),
    "trips": CleanSpec("trips_clean", timestamps={"fecha_hora_inicio": TS, "fecha_hora_fin": TS},
                       dedup="full", no_nulls=("usuario_id", "estacion_origen", "estacion_destino")),
    "parking": CleanSpec("parking_clean", dates={"fecha": DAY},
                         numerics={"capacidad_total": "int", "plazas_movilidad_reducida": "int",
                                   "plazas_vehiculos_electricos": "int", "tarifa_hora_euros": "double",
                                   "latitud": "double", "longitud": "double"},
                         dedup=("aparcamiento_id", "fecha", "hora"),
                         no_nulls=("aparcamiento_id", "fecha", "hora", "nombre", "capacidad_total",
                                   "latitud", "longitud"),
                         extra_rules=_ranges(hora=(0, 23), porcentaje_ocupacion=(0, 100), latitud=LATITUDE,
                                             longitud=LONGITUDE)),
    "energy": CleanSpec("energy_clean", dates={"fecha": DAY}, dedup=("edificio_id", "fecha"),
                        no_nulls=("fecha", "consumo_electrico_kwh", "consumo_gas_m3"),
                        extra_rules=_ranges(consumo_electrico_kwh=AMOUNT, consumo_gas_m3=AMOUNT, consumo_agua_m3=AMOUNT,
                                            emisiones_co2_kg=AMOUNT, coste_total_euros=AMOUNT)),
    "districts": CleanSpec("districts_clean", numerics={"latitud": "double", "longitud": "double"},
                           dedup=("id",), no_nulls=("nombre", "latitud", "longitud", "superficie_km2"),
                           extra_rules=_ranges(latitud=LATITUDE, longitud=LONGITUDE, poblacion=AMOUNT)),
    "buildings": CleanSpec("buildings_clean",
                           numerics={"latitud": "double", "longitud": "double", "año_construccion": "int",
                                     "ultimo_renovado": "int"},
                           dedup=("id", "direccion"),
                           no_nulls=("nombre", "tipo", "distrito_id", "latitud", "longitud"),
                           extra_rules=_listed(
                               tipo=("Administrativo", "Educativo", "Sanitario", "Cultural", "Deportivo", "Social"),
                               accesibilidad=("Alta", "Media", "Baja"),
                               certificacion_energetica=("A", "B", "C", "D", "E", "F", "G"))
                           + _ranges(latitud=LATITUDE, longitud=LONGITUDE, año_construccion=YEAR)),
    "stations": CleanSpec("stations_clean",
                          numerics={"latitud": "double", "longitud": "double", "año_inauguracion": "int"},
                          dedup=("nombre", "linea_id"), no_nulls=("nombre", "linea_id", "latitud", "longitud"),
                          extra_rules=_listed(tipo=("Estación", "Parada"), accesibilidad=("Total", "Parcial", "Ninguna"))
                          + _ranges(latitud=LATITUDE, longitud=LONGITUDE)),
    "lines": CleanSpec("lines_clean", numerics={"longitud_km": "double"}, dedup=("nombre", "tipo"),
                       no_nulls=("nombre", "tipo", "longitud_km"),
                       extra_rules=_listed(tipo=("Metro", "EMT", "Cercanías")) + _ranges(longitud_km=AMOUNT)),
    "green_zones": CleanSpec("green_zones_clean",
                             numerics={"latitud": "double", "longitud": "double", "año_creacion": "int"},
                             booleans=("tiene_area_infantil", "tiene_area_deportiva", "tiene_area_canina"),
                             no_nulls=("nombre", "distrito_id", "latitud", "longitud"),
                             extra_rules=_listed(tipo=("Parque", "Jardín", "Zona ajardinada", "Área forestal"))
                             + _ranges(latitud=LATITUDE, longitud=LONGITUDE)),
    "citizen_reports": CleanSpec("citizen_reports_clean", timestamps={"fecha_reporte": None, "fecha_resolucion": None},
                                 dedup=("id",),
                                 no_nulls=("id", "categoria", "descripcion", "fecha_reporte", "latitud", "longitud"),
                                 unique=("id",)),
}
