"""Explicit schemas of the lake's tables."""

from __future__ import annotations

from pyspark.sql import types as T

from listing_lake.functions.pages import POI_KINDS

_KINDS = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def table(**columns: str) -> T.StructType:
    """Schema from ``name="type"`` pairs; a type that ends in ``!`` is not nullable."""
    return T.StructType([T.StructField(n, _KINDS[k.rstrip("!")], not k.endswith("!")) for n, k in columns.items()])


LINEAGE = {"_sistema_origen": "string", "_id_corrida": "string"}

LISTINGS = table(
    id_aviso="string!", comuna="string", tipo_propiedad="string", operacion="string", titulo="string", precio="string",
    moneda="string", ubicacion="string", dormitorios="string", banos="string", superficie_m2="string", url="string",
    first_seen="string", **LINEAGE,
)

POI_COLUMNS = [f"{prefix}_{kind}" for kind in POI_KINDS.values() for prefix in ("cantidad", "distancia_min_m")]
DETAIL_TEXTS = [
    "descripcion", "fecha_publicacion_texto", "fecha_publicacion_aprox", "fecha_publicacion_precision",
    "superficie_total_m2", "superficie_util_m2", "dormitorios", "banos", "estacionamientos", "antiguedad_anos",
    "amoblado", "admite_mascotas", "condominio_cerrado", "bodegas", "gastos_comunes", "estacionamiento_visitas",
    "solo_familias", "max_habitantes", "piscina", "quincho", "conserjeria", "ascensor", "piso_unidad",
    "deptos_por_piso", "barrio", "latitud", "longitud", *POI_COLUMNS, "estado_publicacion", "fecha_scrapeo",
]
DETAILS = table(id_aviso="string!", **{c: "string" for c in DETAIL_TEXTS}, **LINEAGE)

ATTEMPTS = table(id_aviso="string!", resultado="string!", motivo="string", fecha_intento="timestamp!")

VULNERABILITY = ["rank_nac", "pob_rsh_uv", "p_urbano", "c_ig_com", "hog_uv"]
POLYGONS = table(
    uv_rsh="string!", comuna="string!", **{c: "double" for c in VULNERABILITY}, geometria_wkt="string!", **LINEAGE
)

RATES = table(fecha_valor="date", valor_uf_clp="double", valor_dolar_clp="double", fecha_consulta="date")

REFERENCE = table(
    id_aviso="string!", comuna="string", latitud="double", longitud="double", antiguedad_anos="double",
    piso_unidad="double", precio_m2="double", precio_m2_valido="boolean", **{c: "double" for c in VULNERABILITY},
)
TRAINING_ROWS = table(
    id_aviso="string!", costo_total_clp="double", superficie_util_m2="double", antiguedad_anos="double",
    piso_unidad="double", **{c: "double" for c in VULNERABILITY},
)
LEVELS = table(barrio="string!", nivel_barrio="int!")
STATISTICS = table(clave="string!", valor="double")
GROUP_STATISTICS = table(
    comuna="string!", mediana_antiguedad="double", **{f"media_{c}": "double" for c in VULNERABILITY}
)
SELECTED_FEATURES = table(feature="string!")

PREDICTIONS = table(
    id_aviso="string!", version_modelo="string!", fecha_prediccion="timestamp!", costo_total_predicho="double!",
    z_robusto="double", decil_precio="int", etiqueta="string", nivel_confianza="string", cv_ensamble="double",
)
