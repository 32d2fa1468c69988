"""Parsing, typing, pricing and rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_lake.catalog.registry import query
from listing_lake.catalog.views import Views
from listing_lake.functions import numbers
from listing_lake.functions.text import is_furnished
from listing_lake.operators.increments import missing_dates
from listing_lake.operators.lookup import lookup_or_default
from listing_lake.operators.quantiles import lower_median
from listing_lake.plans import clean, features, scoring
from listing_lake.sources.tables import explode_rate_series, read_level_map

PRICE_SQL = "TRY_CAST(replace(precio_texto, '.', '') AS DOUBLE)"
AREA_SQL = "TRY_CAST(replace(replace({0}, '.', ''), ',', '.') AS DOUBLE)"
DAY_SQL = "TRY_CAST(COALESCE(fecha_publicacion_aprox, first_seen) AS DATE)"
CLP_SQL = f"""CASE WHEN lower(moneda) = 'uf' THEN {PRICE_SQL} * valor_uf_clp
  WHEN lower(moneda) IN ('us$', 'usd', 'usd$') THEN {PRICE_SQL} * valor_dolar_clp ELSE {PRICE_SQL} END"""
CHARGES_SQL = """CASE WHEN gastos_comunes_texto LIKE '%.%' THEN TRY_CAST(replace(gastos_comunes_texto, '.', '') AS DOUBLE)
  WHEN TRY_CAST(gastos_comunes_texto AS DOUBLE) < 1000 THEN 0.0
  WHEN TRY_CAST(gastos_comunes_texto AS DOUBLE) >= 500000 THEN NULL
  ELSE TRY_CAST(gastos_comunes_texto AS DOUBLE) END"""


def typed_listings(v: Views):
    """The listings view as the cleaning step sees it: texts renamed to the lake's fields."""
    listings = v("listings").withColumnsRenamed(
        {"superficie_util_texto": "superficie_util_m2_texto", "superficie_total_texto": "superficie_total_m2_texto"}
    )
    return clean.null_above(clean.type_fields(listings))


def priced_listings(v: Views):
    return clean.price_to_clp(typed_listings(v), v("rates"))


@query(
    f"""SELECT id_aviso, {PRICE_SQL} AS precio, {AREA_SQL.format('superficie_util_texto')} AS superficie_util_m2,
      {AREA_SQL.format('superficie_total_texto')} AS superficie_total_m2,
      CASE WHEN TRY_CAST(dormitorios_texto AS DOUBLE) <= 6 THEN TRY_CAST(dormitorios_texto AS DOUBLE) END AS dormitorios,
      CASE WHEN TRY_CAST(banos_texto AS DOUBLE) <= 5 THEN TRY_CAST(banos_texto AS DOUBLE) END AS banos,
      CASE WHEN TRY_CAST(estacionamientos_texto AS DOUBLE) <= 15 THEN TRY_CAST(estacionamientos_texto AS DOUBLE) END AS estacionamientos
    FROM listings""",
    ["listings"],
)
def clean_numbers(v: Views):
    return typed_listings(v).select(
        "id_aviso", "precio", "superficie_util_m2", "superficie_total_m2", "dormitorios", "banos", "estacionamientos"
    )


@query(f"SELECT id_aviso, gastos_comunes_texto, {CHARGES_SQL} AS gastos_comunes FROM listings", ["listings"])
def common_charges(v: Views):
    return v("listings").select(
        "id_aviso", "gastos_comunes_texto", numbers.parse_common_charges(F.col("gastos_comunes_texto")).alias("gastos_comunes")
    )


@query(
    """SELECT id_aviso, piscina_texto, CAST(CASE WHEN lower(piscina_texto) IN ('sí', 'si') THEN 1
      WHEN lower(piscina_texto) = 'no' THEN 0 END AS INTEGER) AS piscina FROM listings""",
    ["listings"],
)
def yes_no_flags(v: Views):
    return v("listings").select("id_aviso", "piscina_texto", numbers.parse_yes_no(F.col("piscina_texto")).alias("piscina"))


@query(
    f"""SELECT id_aviso, {PRICE_SQL} AS precio, moneda, valor_uf_clp, valor_dolar_clp, {CLP_SQL} AS precio_clp
    FROM listings LEFT JOIN rates ON fecha_valor = {DAY_SQL}""",
    ["listings", "rates"],
)
def price_to_clp(v: Views):
    return priced_listings(v).select("id_aviso", "precio", "moneda", "valor_uf_clp", "valor_dolar_clp", "precio_clp")


@query(
    f"""SELECT comuna, count(*) AS avisos, count(precio_clp) AS con_precio,
      quantile_disc(precio_clp, 0.5) AS mediana_precio_clp
    FROM (SELECT comuna, {CLP_SQL} AS precio_clp FROM listings LEFT JOIN rates ON fecha_valor = {DAY_SQL}) t
    GROUP BY comuna""",
    ["listings", "rates"],
)
def price_by_comuna(v: Views):
    priced = priced_listings(v).select("comuna", "precio_clp")
    counts = priced.groupBy("comuna").agg(
        F.count(F.lit(1)).alias("avisos"), F.count("precio_clp").alias("con_precio")
    )
    return counts.join(lower_median(priced, ["comuna"], "precio_clp", "mediana_precio_clp"), "comuna", "left")


@query(
    f"""SELECT DISTINCT {DAY_SQL} AS fecha_valor FROM listings WHERE lower(moneda) = 'uf' AND {DAY_SQL} IS NOT NULL
    EXCEPT SELECT fecha_valor FROM rates""",
    ["listings", "rates"],
)
def missing_rate_dates(v: Views):
    return missing_dates(clean.needed_rate_dates(v("listings")), v("rates"), "fecha_valor")


@query(
    f"""SELECT DISTINCT {DAY_SQL} AS fecha_valor FROM listings
      WHERE lower(moneda) IN ('uf', 'us$', 'usd', 'usd$') AND {DAY_SQL} IS NOT NULL
    EXCEPT SELECT fecha_valor FROM rates""",
    ["listings", "rates"],
)
def missing_rate_dates_all(v: Views):
    return missing_dates(clean.needed_rate_dates(v("listings"), all_currencies=True), v("rates"), "fecha_valor")


@query(
    """SELECT fecha_valor, valor_uf_clp + CASE WHEN day(fecha_valor) = 15 THEN 1 ELSE 0 END AS valor FROM rates""",
    ["rates"],
)
def rate_series(v: Views):
    # one document per year; the 15th of each month is published again, corrected, in the next year's
    rates = v("rates")
    first = rates.select(F.year("fecha_valor").alias("year"), "fecha_valor", "valor_uf_clp")
    again = rates.filter(F.dayofmonth("fecha_valor") == 15).select(
        (F.year("fecha_valor") + 1).alias("year"), "fecha_valor", (F.col("valor_uf_clp") + 1).alias("valor_uf_clp")
    )
    item = F.struct(
        F.date_format("fecha_valor", "yyyy-MM-dd'T'03:00:00.000'Z'").alias("fecha"), F.col("valor_uf_clp").alias("valor")
    )
    documents = first.unionByName(again).groupBy("year").agg(
        F.to_json(F.struct(F.collect_list(item).alias("serie"))).alias("document")  # a year of days
    )
    return explode_rate_series(documents, order="year")


@query(
    """SELECT id_aviso, barrio, CAST(COALESCE(nivel_barrio, 3) AS INTEGER) AS nivel_barrio
    FROM listings LEFT JOIN levels USING (barrio)""",
    ["listings", "levels"],
)
def level_lookup(v: Views):
    entries = F.map_from_entries(F.collect_list(F.struct("barrio", "nivel_barrio")))
    documents = v("levels").agg(
        F.to_json(F.struct(entries.alias("mapa_barrio_a_nivel"), F.lit(3.0).alias("nivel_default"))).alias("document")
    )
    levels, default = read_level_map(documents)
    with_default = v("listings").select("id_aviso", "barrio").crossJoin(
        F.broadcast(default.select(F.col("valor").cast("int").alias("__default")))  # one row
    )
    return lookup_or_default(with_default, levels, "barrio", "nivel_barrio", F.col("__default")).drop("__default")


@query(
    f"""SELECT id_aviso, precio_clp FROM (SELECT id_aviso, {CLP_SQL} AS precio_clp
    FROM listings LEFT JOIN rates ON fecha_valor = {DAY_SQL}) t WHERE precio_clp <= 8000000""",
    ["listings", "rates"],
)
def price_mask(v: Views):
    return scoring.price_mask(priced_listings(v)).select("id_aviso", "precio_clp")


@query(
    """SELECT id_aviso,
      CASE WHEN latitud BETWEEN -37.5 AND -36.0 AND longitud BETWEEN -73.7 AND -72.5 THEN latitud END AS latitud,
      CASE WHEN latitud BETWEEN -37.5 AND -36.0 AND longitud BETWEEN -73.7 AND -72.5 THEN longitud END AS longitud
    FROM listings""",
    ["listings"],
)
def geo_box(v: Views):
    return features.null_outside_box(v("listings").select("id_aviso", "latitud", "longitud"))


@query(
    """SELECT id_aviso FROM listings WHERE TRY_CAST(dormitorios_texto AS DOUBLE) <= 6 AND TRY_CAST(banos_texto AS DOUBLE) <= 5
    AND NOT (superficie_util_texto IS NULL AND superficie_total_texto IS NULL)""",
    ["listings"],
)
def sanity_filter(v: Views):
    return features.sanity_filter(typed_listings(v)).select("id_aviso")


@query(
    f"""SELECT id_aviso, CASE WHEN {AREA_SQL.format('superficie_util_texto')} > 0 THEN
      {AREA_SQL.format('superficie_total_texto')} / {AREA_SQL.format('superficie_util_texto')} END AS ratio_total_util,
      CAST(regexp_matches(titulo, '(?i)amoblad[oa]|amueblad[oa]') AS INTEGER) AS amoblado FROM listings""",
    ["listings"],
)
def ratio_and_keyword(v: Views):
    return typed_listings(v).select(
        "id_aviso",
        numbers.safe_ratio(F.col("superficie_total_m2"), F.col("superficie_util_m2")).alias("ratio_total_util"),
        is_furnished(F.col("titulo")).alias("amoblado"),
    )


@query(
    """SELECT id_aviso, CAST(COALESCE(gastos_comunes, 0) AS DOUBLE) AS gastos_comunes, CAST(COALESCE(piscina, 0) AS INTEGER) AS piscina,
      CAST(COALESCE(CAST(trunc(TRY_CAST(cantidad_paraderos AS DOUBLE)) AS INTEGER), 0) AS INTEGER) AS cantidad_paraderos
    FROM amenities""",
    ["amenities"],
)
def zero_fill(v: Views):
    filled = features.zero_fill(v("amenities")).withColumn("gastos_comunes", F.col("gastos_comunes").cast("double"))
    return filled.select("id_aviso", "gastos_comunes", "piscina", "cantidad_paraderos")
