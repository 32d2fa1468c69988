"""Increments, queues, de-duplication, top rows and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_lake.catalog.registry import query
from listing_lake.catalog.views import Views
from listing_lake.operators import dedupe, increments, quality
from listing_lake.plans import scoring


@query(
    """SELECT id_aviso, comuna FROM listings l WHERE NOT EXISTS
      (SELECT 1 FROM done d WHERE d.id_aviso = l.id_aviso)""",
    ["listings", "done"],
)
def pending_not_exists(v: Views):
    return increments.pending(v("listings").select("id_aviso", "comuna"), v("done"), "id_aviso")


@query(
    """SELECT l.id_aviso, l.comuna FROM listings l LEFT JOIN done d ON l.id_aviso = d.id_aviso AND d.version_modelo = 'v2'
    WHERE d.id_aviso IS NULL""",
    ["listings", "done"],
)
def pending_composite(v: Views):
    return increments.pending_for_version(
        v("listings").select("id_aviso", "comuna"), v("done"), "id_aviso", "version_modelo", "v2"
    )


@query(
    """SELECT s.id_aviso, CAST(COALESCE(f.n, 0) AS BIGINT) AS fallos FROM states s
    LEFT JOIN (SELECT id_aviso FROM done WHERE version_modelo = 'v1') d ON d.id_aviso = s.id_aviso
    LEFT JOIN (SELECT id_aviso, count(*) AS n FROM attempts WHERE resultado = 'error' GROUP BY id_aviso) f ON f.id_aviso = s.id_aviso
    WHERE d.id_aviso IS NULL AND s.url IS NOT NULL AND COALESCE(f.n, 0) <= 5
      AND NOT EXISTS (SELECT 1 FROM attempts a WHERE a.id_aviso = s.id_aviso AND a.resultado = 'no_encontrado')""",
    ["states", "done", "attempts"],
)
def retry_queue(v: Views):
    details = v("done").filter("version_modelo = 'v1'")
    return increments.retry_queue(v("states"), details, v("attempts")).select("id_aviso", "fallos")


RECHECK_SQL = """FROM states WHERE estado_publicacion = 'activo' AND url IS NOT NULL
    AND (fecha_chequeo IS NULL OR fecha_chequeo <= TIMESTAMP '1996-01-01 00:00:00' - INTERVAL 1 DAY)"""


@query(f"SELECT id_aviso, fecha_chequeo {RECHECK_SQL}", ["states"])
def recheck_due(v: Views):
    now = F.lit("1996-01-01 00:00:00").cast("timestamp")
    return increments.recheck_due(v("states"), now).select("id_aviso", "fecha_chequeo")


@query(
    f"SELECT id_aviso, fecha_chequeo {RECHECK_SQL} ORDER BY fecha_chequeo ASC NULLS FIRST, id_aviso LIMIT 200", ["states"]
)
def recheck_queue(v: Views):
    now = F.lit("1996-01-01 00:00:00").cast("timestamp")
    return increments.recheck_queue(v("states"), now).select("id_aviso", "fecha_chequeo")


@query(
    """SELECT id, ts, seq, part, valor FROM (SELECT *, row_number() OVER (PARTITION BY id
      ORDER BY ts DESC, seq DESC, part DESC, valor DESC) AS rn FROM versions) t WHERE rn = 1""",
    ["versions"],
)
def keep_latest(v: Views):
    return dedupe.keep_latest(v("versions"), ["id"], ["ts", "seq", "part", "valor"])


@query(
    """SELECT part, id, seq, ts, valor FROM (SELECT *, row_number() OVER (PARTITION BY part
      ORDER BY id, seq, ts, valor) AS rn FROM versions) t WHERE rn = 1""",
    ["versions"],
)
def first_occurrence(v: Views):
    order = [F.col(c) for c in ("id", "seq", "ts", "valor")]
    return dedupe.keep_first(v("versions"), ["part"], order).select("part", "id", "seq", "ts", "valor")


@query(
    "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10"
)
def newest_n(v: Views):
    orders = v("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return dedupe.newest(orders, "o_orderdate", "o_orderkey", 10)


@query(
    "SELECT estado_publicacion, count(*) AS avisos FROM states GROUP BY estado_publicacion ORDER BY avisos DESC", ["states"]
)
def group_count(v: Views):
    return quality.group_count(v("states"), "estado_publicacion", "avisos", by_count=True)


@query("SELECT comuna, count(*) AS unidades_vecinales FROM listings GROUP BY comuna ORDER BY comuna", ["listings"])
def group_count_by_key(v: Views):
    return quality.group_count(v("listings"), "comuna", "unidades_vecinales")


@query("SELECT id, count(*) AS veces FROM versions GROUP BY id HAVING count(*) > 1", ["versions"])
def duplicates(v: Views):
    return quality.duplicate_keys(v("versions"), ["id"])


@query(
    """SELECT (SELECT count(*) FROM reference) AS avisos_referencia, (SELECT count(*) FROM levels) AS barrios,
      (SELECT count(*) FROM listings) AS avisos, (SELECT count(*) FROM rates) AS tasas, (SELECT count(*) FROM outcomes) AS visitas""",
    ["reference", "levels", "listings", "rates", "outcomes"],
)
def table_counts(v: Views):
    return quality.table_counts(
        {
            "avisos_referencia": v("reference"), "barrios": v("levels"), "avisos": v("listings"), "tasas": v("rates"),
            "visitas": v("outcomes"),
        }
    )


@query(
    """SELECT version_modelo, count(*) AS predicciones, round(avg(costo), 2) AS costo_promedio
    FROM (SELECT d.version_modelo, f.costo_total_real AS costo FROM done d JOIN features f USING (id_aviso)) t
    GROUP BY version_modelo ORDER BY version_modelo DESC""",
    ["done", "features"],
)
def version_summary(v: Views):
    rows = v("done").join(v("features"), "id_aviso").withColumnRenamed("costo_total_real", "costo_total_predicho")
    return scoring.version_summary(rows).withColumn("costo_promedio", F.round("costo_promedio", 2))


@query(
    """SELECT count(*) AS total_filas,
      CAST(sum(CASE WHEN superficie_util_texto IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS util_faltantes,
      CAST(sum(CASE WHEN superficie_total_texto IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS total_faltantes,
      CAST(sum(CASE WHEN latitud IS NULL OR longitud IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS sin_coordenadas,
      CAST(sum(CASE WHEN moneda IS NULL AND latitud IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS sin_moneda_con_coordenadas
    FROM listings""",
    ["listings"],
)
def quality_counters(v: Views):
    c = F.col
    return quality.counters(
        v("listings"),
        {
            "util_faltantes": c("superficie_util_texto").isNull(),
            "total_faltantes": c("superficie_total_texto").isNull(),
            "sin_coordenadas": c("latitud").isNull() | c("longitud").isNull(),
            "sin_moneda_con_coordenadas": c("moneda").isNull() & c("latitud").isNotNull(),
        },
    )
