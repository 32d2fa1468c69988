"""Adapter views: listing-like relations derived from the given tables.

Each view is SQL that runs unchanged in Spark and in the checking engine; ``{name}`` stands for a
table or another view.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from listing_lake.sources.tables import load

VIEWS: dict[str, str] = {}

VIEWS["listings"] = """
SELECT concat('MLC-', CAST(o.k AS STRING)) AS id_aviso,
  o.k AS k,
  concat('comuna-', CAST(c.c_nationkey AS STRING)) AS comuna,
  concat('barrio-', CAST(o.k % 60 AS STRING)) AS barrio,
  CASE o.k % 5 WHEN 0 THEN 'Depto amoblado' WHEN 1 THEN 'AMUEBLADA centro' WHEN 2 THEN NULL ELSE 'Depto' END AS titulo,
  CASE o.k % 4 WHEN 0 THEN 'UF' WHEN 1 THEN 'US$' WHEN 2 THEN NULL ELSE '$' END AS moneda,
  CASE WHEN o.k % 11 = 0 THEN '' WHEN o.k % 13 = 0 THEN '12,5' WHEN o.v >= 1000 THEN
    concat(CAST(CAST(floor(o.v / 1000.0) AS BIGINT) AS STRING), '.', lpad(CAST(o.v % 1000 AS STRING), 3, '0'))
    ELSE CAST(o.v AS STRING) END AS precio_texto,
  CASE WHEN o.k % 7 <> 0 THEN concat(CAST(30 + o.k % 90 AS STRING), ',', CAST(o.k % 10 AS STRING)) END AS superficie_util_texto,
  CASE WHEN o.k % 9 <> 0 THEN CAST(40 + o.k % 100 AS STRING) END AS superficie_total_texto,
  CASE WHEN o.k % 19 <> 0 THEN CAST(o.k % 9 AS STRING) END AS dormitorios_texto,
  CASE WHEN o.k % 29 <> 0 THEN CAST(o.k % 7 AS STRING) END AS banos_texto,
  CASE WHEN o.k % 31 = 0 THEN 'x' ELSE CAST(o.k % 18 AS STRING) END AS estacionamientos_texto,
  CASE o.k % 6 WHEN 0 THEN '82.000' WHEN 1 THEN '10' WHEN 2 THEN '1111111' WHEN 3 THEN '45000' WHEN 4 THEN '' END AS gastos_comunes_texto,
  CASE o.k % 5 WHEN 0 THEN 'Sí' WHEN 1 THEN 'No' WHEN 2 THEN 'si' WHEN 3 THEN 'NO' END AS piscina_texto,
  CASE WHEN o.k % 8 <> 0 THEN CAST(o.k % 35 AS DOUBLE) END AS piso_unidad,
  CASE WHEN o.k % 3 <> 0 THEN CAST(o.k % 40 AS DOUBLE) END AS antiguedad_anos,
  CASE WHEN o.k % 17 = 0 THEN NULL WHEN o.k % 23 = 0 THEN CAST(40.4 AS DOUBLE)
       ELSE CAST(-36.85 AS DOUBLE) + CAST(o.k * 7919 % 250 AS DOUBLE) / 2500 END AS latitud,
  CASE WHEN o.k % 17 = 0 THEN NULL WHEN o.k % 23 = 0 THEN CAST(-3.7 AS DOUBLE)
       ELSE CAST(-73.10 AS DOUBLE) + CAST(o.k * 104729 % 251 AS DOUBLE) / 2500 END AS longitud,
  CAST(o.d AS STRING) AS first_seen,
  CASE WHEN o.k % 10 = 0 THEN NULL WHEN o.k % 101 = 0 THEN '2024-13-01' ELSE CAST(o.d AS STRING) END AS fecha_publicacion_aprox
FROM (SELECT o_orderkey AS k, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS v, CAST(o_orderdate AS DATE) AS d FROM {orders}) o
JOIN {customer} c ON c.c_custkey = o.o_custkey
"""

# the listings with the communes of the area and a text count, for the feature steps
VIEWS["placed"] = """
SELECT id_aviso, k, latitud, longitud,
  CASE k % 11 WHEN 0 THEN 'concepcion-biobio' WHEN 1 THEN 'talcahuano-biobio' WHEN 2 THEN 'hualpen-biobio'
    WHEN 3 THEN 'san-pedro-de-la-paz-biobio' WHEN 4 THEN 'chiguayante-biobio' WHEN 5 THEN 'penco-biobio'
    WHEN 6 THEN 'tome-biobio' WHEN 7 THEN 'coronel-biobio' WHEN 8 THEN 'hualqui-biobio' WHEN 9 THEN 'lota-biobio'
    ELSE 'otra' END AS comuna
FROM {listings} l
"""

VIEWS["amenities"] = """
SELECT id_aviso, CASE k % 6 WHEN 0 THEN 82000.0 WHEN 3 THEN 45000.0 END AS gastos_comunes,
  CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS piscina,
  CASE k % 7 WHEN 0 THEN '5.0' WHEN 1 THEN '3' WHEN 2 THEN 'x' WHEN 3 THEN '2.9' WHEN 4 THEN '' END AS cantidad_paraderos,
  piso_unidad
FROM {listings}
"""

VIEWS["rates"] = """
SELECT d AS fecha_valor,
  CAST(30000 + (year(d) * 372 + month(d) * 31 + day(d)) % 5000 AS DOUBLE) AS valor_uf_clp,
  CAST(925 AS DOUBLE) AS valor_dolar_clp
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM {orders}) t
WHERE (year(d) * 372 + month(d) * 31 + day(d)) % 7 <> 0
"""

VIEWS["reference"] = """
SELECT p_partkey AS ref_id,
  concat('comuna-', CAST(p_partkey % 30 AS STRING)) AS comuna,
  CAST(-36.85 AS DOUBLE) + CAST(p_partkey * 7919 % 250 AS DOUBLE) / 2500 AS latitud,
  CAST(-73.10 AS DOUBLE) + CAST(p_partkey * 104729 % 251 AS DOUBLE) / 2500 AS longitud,
  CAST(p_size AS DOUBLE) AS antiguedad_anos,
  CAST(p_partkey % 20 AS DOUBLE) AS piso_unidad,
  p_retailprice * 500 AS costo_total_clp,
  CASE WHEN p_partkey % 50 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(20 + p_partkey % 100 AS DOUBLE) END AS superficie_util_m2,
  CAST(p_partkey % 1000 AS DOUBLE) AS rank_nac,
  CAST(p_partkey % 7 AS DOUBLE) AS p_urbano
FROM {part}
"""

# a spot of some hundred metres, crowded with distinct places on both sides
VIEWS["dense_probes"] = """
SELECT concat('MLC-', CAST(o_orderkey AS STRING)) AS id_aviso,
  CAST(-36.82 AS DOUBLE) + CAST(o_orderkey * 7919 % 1000003 AS DOUBLE) / 500000000 AS latitud,
  CAST(-73.05 AS DOUBLE) + CAST(o_orderkey * 104729 % 1000033 AS DOUBLE) / 500000000 AS longitud
FROM {orders}
"""
VIEWS["dense_points"] = """
SELECT CAST(-36.82 AS DOUBLE) + CAST(p_partkey * 15485863 % 1000003 AS DOUBLE) / 500000000 AS latitud,
  CAST(-73.05 AS DOUBLE) + CAST(p_partkey * 32452843 % 1000033 AS DOUBLE) / 500000000 AS longitud
FROM {part}
"""

VIEWS["levels"] = """
SELECT concat('barrio-', CAST(n_nationkey AS STRING)) AS barrio, n_nationkey % 5 + 1 AS nivel_barrio FROM {nation}
"""

VIEWS["outcomes"] = """
SELECT event_id AS seq, user_id AS id, ts, CAST(ts AS DATE) AS run,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'captcha' WHEN 'click' THEN 'no_encontrado' ELSE 'ok' END AS resultado
FROM {events}
"""

# fewer final outcomes and longer error runs, so that the counter decides often
VIEWS["visits"] = """
SELECT event_id AS seq, user_id AS id, ts,
  CASE WHEN event_type = 'signup' THEN 'captcha' WHEN event_id % 97 = 0 THEN 'no_encontrado'
       WHEN event_type IN ('error', 'click') OR event_id % 3 = 0 THEN 'error' ELSE 'ok' END AS resultado,
  CASE WHEN event_id % 89 = 0 THEN 'pausado' ELSE 'activo' END AS estado
FROM {events}
"""

VIEWS["attempts"] = """
SELECT concat('MLC-', CAST(event_id % 1500 AS STRING)) AS id_aviso,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'error' WHEN 'click' THEN CASE WHEN event_id % 50 = 0 THEN 'no_encontrado' ELSE 'error' END ELSE 'ok' END AS resultado,
  ts AS fecha_intento
FROM {events}
"""

VIEWS["done"] = """
SELECT id_aviso, 'v1' AS version_modelo FROM {listings} WHERE k % 3 = 0
UNION ALL SELECT id_aviso, 'v2' AS version_modelo FROM {listings} WHERE k % 5 = 0
"""

VIEWS["states"] = """
SELECT id_aviso, CASE k % 4 WHEN 0 THEN 'pausado' ELSE 'activo' END AS estado_publicacion,
  CASE WHEN k % 7 = 0 THEN NULL ELSE first_seen END AS url,
  CASE WHEN k % 6 <> 0 THEN CAST(first_seen AS TIMESTAMP) END AS fecha_chequeo,
  CASE WHEN k % 9 <> 0 THEN CAST(k % 6 AS INT) END AS intentos_fallidos
FROM {listings}
"""

VIEWS["target"] = """
SELECT id_aviso, 'v1' AS version_modelo, CAST(k % 100 AS DOUBLE) AS valor, CAST(NULL AS STRING) AS uv_rsh FROM {listings} WHERE k % 2 = 0
"""

VIEWS["source"] = """
SELECT id_aviso, CASE WHEN k % 4 = 0 THEN 'v2' ELSE 'v1' END AS version_modelo, CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 77 AS DOUBLE) END AS valor, concat('uv', CAST(k % 5 AS STRING)) AS uv_rsh
FROM {listings} WHERE k % 3 = 0
"""

VIEWS["versions"] = """
SELECT l_orderkey AS id, l_shipdate AS ts, l_linenumber AS seq, l_partkey AS part, l_extendedprice AS valor FROM {lineitem}
"""

VIEWS["features"] = """
SELECT id_aviso, k, COALESCE(antiguedad_anos, CAST(10 AS DOUBLE)) AS antiguedad_anos, COALESCE(piso_unidad, CAST(1 AS DOUBLE)) AS piso_unidad,
  CAST(40 + k % 100 AS DOUBLE) AS superficie, CAST(k % 9 AS DOUBLE) AS dormitorios,
  CAST(200000 + (k * 7907) % 900000 AS DOUBLE) AS costo_total_real
FROM {listings}
"""

# One tile per customer over the listings' area; the tile shrinks as customers grow, so polygons
# cover the area about once.  Every fourth tile has a hole, every fourth is concave, every fourth is
# followed by an overlapping copy under a later key, and two of twelve lie in other communes.
VIEWS["tiles"] = """
SELECT c.c_custkey AS c, g.g AS g,
  CAST(floor(CAST(100000 AS DOUBLE) / g.g) AS BIGINT) AS step,
  (c.c_custkey - 1) % g.g AS tx,
  CAST(floor(CAST(c.c_custkey - 1 AS DOUBLE) / g.g) AS BIGINT) % g.g AS ty
FROM {customer} c CROSS JOIN (SELECT CAST(ceil(sqrt(CAST(count(*) AS DOUBLE))) AS BIGINT) AS g FROM {customer}) g
"""

VIEWS["corners"] = """
SELECT c,
  concat('-73.', lpad(CAST(100000 - tx * step AS STRING), 6, '0')) AS xa,
  concat('-73.', lpad(CAST(100000 - tx * step - CAST(floor(CAST(step AS DOUBLE) / 4) AS BIGINT) AS STRING), 6, '0')) AS xb,
  concat('-73.', lpad(CAST(100000 - tx * step - CAST(floor(CAST(step AS DOUBLE) * 3 / 4) AS BIGINT) AS STRING), 6, '0')) AS xc,
  concat('-73.', lpad(CAST(100000 - tx * step - step AS STRING), 6, '0')) AS xd,
  concat('-36.', lpad(CAST(850000 - ty * step AS STRING), 6, '0')) AS ya,
  concat('-36.', lpad(CAST(850000 - ty * step - CAST(floor(CAST(step AS DOUBLE) / 4) AS BIGINT) AS STRING), 6, '0')) AS yb,
  concat('-36.', lpad(CAST(850000 - ty * step - CAST(floor(CAST(step AS DOUBLE) * 3 / 4) AS BIGINT) AS STRING), 6, '0')) AS yc,
  concat('-36.', lpad(CAST(850000 - ty * step - step AS STRING), 6, '0')) AS yd
FROM {tiles}
"""

VIEWS["polygons"] = """
SELECT concat('uv', lpad(CAST(c AS STRING), 10, '0')) AS uv_rsh,
  CASE c % 12 WHEN 0 THEN 'CONCEPCION' WHEN 1 THEN 'TALCAHUANO ' WHEN 2 THEN 'hualpen' WHEN 3 THEN 'San Pedro de la Paz'
    WHEN 4 THEN 'CHIGUAYANTE' WHEN 5 THEN ' penco' WHEN 6 THEN 'TOME' WHEN 7 THEN 'Coronel' WHEN 8 THEN 'HUALQUI'
    WHEN 9 THEN 'LOTA' WHEN 10 THEN 'SANTIAGO' ELSE 'TEMUCO' END AS comuna,
  CAST(c % 1000 AS DOUBLE) AS rank_nac, CAST(c % 7 AS DOUBLE) AS p_urbano,
  CASE c % 4
    WHEN 0 THEN concat('POLYGON ((', xa, ' ', ya, ', ', xd, ' ', ya, ', ', xd, ' ', yd, ', ', xa, ' ', yd, ', ', xa, ' ', ya, '), (',
      xb, ' ', yb, ', ', xc, ' ', yb, ', ', xc, ' ', yc, ', ', xb, ' ', yc, ', ', xb, ' ', yb, '))')
    WHEN 1 THEN concat('POLYGON ((', xa, ' ', ya, ', ', xb, ' ', yb, ', ', xd, ' ', ya, ', ', xd, ' ', yd, ', ', xa, ' ', yd, ', ', xa, ' ', ya, '))')
    WHEN 2 THEN concat('MULTIPOLYGON (((', xa, ' ', ya, ', ', xb, ' ', ya, ', ', xb, ' ', yd, ', ', xa, ' ', yd, ', ', xa, ' ', ya, ')), ((',
      xc, ' ', ya, ', ', xd, ' ', ya, ', ', xd, ' ', yd, ', ', xc, ' ', yd, ', ', xc, ' ', ya, ')))')
    ELSE concat('POLYGON ((', xa, ' ', ya, ', ', xd, ' ', ya, ', ', xd, ' ', yd, ', ', xa, ' ', yd, ', ', xa, ' ', ya, '))') END AS geometria_wkt
FROM {corners}
"""


#: Tables that a view joins by key and that grow with the data.  Their files are far smaller than their rows, so
#: that left to the planner they would be collected in the driver and broadcast at any size.
SHUFFLED = {"listings": "customer"}


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])))


class Views:
    """The given tables and the adapter views of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            return load(self.spark, self.folder, name)
        tables = {n: self(n) for n in _needs(name)}
        if name in SHUFFLED:
            tables[SHUFFLED[name]] = tables[SHUFFLED[name]].hint("merge")
        return self.spark.sql(VIEWS[name], **tables)

    def sql(self, text: str, *names: str) -> DataFrame:
        """SQL in which ``{name}`` stands for a table or view."""
        return self.spark.sql(text, **{n: self(n) for n in names})


def with_clause(views: Sequence[str], sql: str) -> str:
    """``sql`` preceded by the common table expressions of the views it uses."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in _needs(name):
            if other in VIEWS:
                visit(other)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        visit(view)
    sql = sql.strip()
    if not ordered:
        return sql
    parts = [f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n]).strip()})" for n in ordered]
    head = "WITH " + ",\n".join(parts)
    if sql[:5].upper() == "WITH ":
        return f"{head},\n{sql[5:]}"
    return f"{head}\n{sql}"
