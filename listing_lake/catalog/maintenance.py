"""Merges, updates, appends and snapshot writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_lake.catalog.registry import query
from listing_lake.catalog.views import Views
from listing_lake.operators import merge, quality
from listing_lake.plans import reference as R
from listing_lake.session import fresh_path
from listing_lake.sources import snapshots
from listing_lake.sources.tables import read_csv, read_level_map

RUN_AT = "2024-01-02 03:04:05"


@query(
    """SELECT id_aviso, version_modelo, valor, uv_rsh FROM target
    UNION ALL SELECT id_aviso, version_modelo, valor, uv_rsh FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.id_aviso = s.id_aviso)""",
    ["target", "source"],
)
def merge_insert_only(v: Views):
    return merge.merge_insert_only(v("target"), v("source"), "id_aviso")


@query(
    """SELECT COALESCE(t.id_aviso, s.id_aviso) AS id_aviso,
      CASE WHEN s.id_aviso IS NOT NULL THEN s.version_modelo ELSE t.version_modelo END AS version_modelo,
      CASE WHEN s.id_aviso IS NOT NULL THEN s.valor ELSE t.valor END AS valor,
      CASE WHEN s.id_aviso IS NOT NULL THEN s.uv_rsh ELSE t.uv_rsh END AS uv_rsh
    FROM target t FULL JOIN source s ON t.id_aviso = s.id_aviso""",
    ["target", "source"],
)
def merge_upsert(v: Views):
    return merge.merge_upsert(v("target"), v("source"), "id_aviso")


@query(
    """SELECT COALESCE(t.id_aviso, s.id_aviso) AS id_aviso, COALESCE(t.version_modelo, s.version_modelo) AS version_modelo,
      CASE WHEN s.id_aviso IS NOT NULL THEN s.valor ELSE t.valor END AS valor,
      CASE WHEN t.id_aviso IS NOT NULL THEN t.uv_rsh ELSE s.uv_rsh END AS uv_rsh
    FROM target t FULL JOIN source s ON t.id_aviso = s.id_aviso AND t.version_modelo = s.version_modelo""",
    ["target", "source"],
)
def merge_upsert_composite(v: Views):
    return merge.merge_upsert(v("target"), v("source"), ["id_aviso", "version_modelo"], update=["valor"])


@query(
    """SELECT t.id_aviso, t.version_modelo, CASE WHEN s.id_aviso IS NOT NULL THEN s.valor ELSE t.valor END AS valor,
      CASE WHEN s.id_aviso IS NOT NULL THEN s.uv_rsh ELSE t.uv_rsh END AS uv_rsh
    FROM target t LEFT JOIN source s ON t.id_aviso = s.id_aviso""",
    ["target", "source"],
)
def merge_update_only(v: Views):
    return merge.merge_update(v("target"), v("source"), "id_aviso", ["valor", "uv_rsh"])


@query(
    """SELECT id_aviso, estado_publicacion, CAST(CASE WHEN estado_publicacion = 'activo' AND url IS NOT NULL
      THEN COALESCE(intentos_fallidos, 0) + 1 ELSE intentos_fallidos END AS INTEGER) AS intentos_fallidos FROM states""",
    ["states"],
)
def update_counter(v: Views):
    visited = (F.col("estado_publicacion") == "activo") & F.col("url").isNotNull()
    plus_one = (F.coalesce("intentos_fallidos", F.lit(0)) + 1).cast("int")
    return merge.update_where(v("states"), visited, {"intentos_fallidos": plus_one}).select(
        "id_aviso", "estado_publicacion", "intentos_fallidos"
    )


@query(
    """SELECT id_aviso, version_modelo, valor FROM target WHERE valor >= 50
    UNION ALL SELECT id_aviso, 'v9' AS version_modelo, valor FROM target WHERE valor < 50 AND valor >= 40""",
    ["target"],
)
def delete_reinsert(v: Views):
    target = v("target").select("id_aviso", "version_modelo", "valor")
    again = target.filter("valor < 50 AND valor >= 40").withColumn("version_modelo", F.lit("v9"))
    return merge.replace_rows(target, F.col("valor") < 50, again)


@query(
    """SELECT clave, valor FROM (SELECT 'registros' AS clave, CAST(count(*) AS DOUBLE) AS valor FROM listings
    UNION ALL SELECT 'nivel_barrio_default', CAST(max(nivel_barrio) AS DOUBLE) FROM levels) t""",
    ["listings", "levels"],
)
def set_default_level(v: Views):
    stats = v("listings").agg(F.count(F.lit(1)).cast("double").alias("registros")).withColumn(
        "nivel_barrio_default", F.lit(0.0)
    )
    stats = stats.unpivot([], stats.columns, "clave", "valor")
    entries = F.map_from_entries(F.collect_list(F.struct("barrio", "nivel_barrio")))
    documents = v("levels").agg(
        F.to_json(
            F.struct(entries.alias("mapa_barrio_a_nivel"), F.max("nivel_barrio").alias("nivel_default"))
        ).alias("document")
    )
    return R.set_statistic(stats, "nivel_barrio_default", read_level_map(documents)[1])


@query(
    """SELECT id_aviso, version_modelo, valor, CAST(NULL AS VARCHAR) AS uv_rsh, CAST(NULL AS BOOLEAN) AS revisado,
      'base' AS _sistema_origen, 'corrida-1' AS _id_corrida FROM target
    UNION ALL SELECT id_aviso, version_modelo, valor, uv_rsh, NULL, 'carga' , 'corrida-2' FROM source""",
    ["target", "source"],
)
def append_evolve(v: Views):
    old = merge.stamp(v("target").drop("uv_rsh"), "base", "corrida-1")
    old = merge.ensure_columns(old, {"revisado": "boolean", "valor": "double"})
    return merge.append_by_name(old, merge.stamp(v("source"), "carga", "corrida-2")).select(
        "id_aviso", "version_modelo", "valor", "uv_rsh", "revisado", "_sistema_origen", "_id_corrida"
    )


@query(
    """SELECT id_aviso, version_modelo, valor, uv_rsh FROM target
    UNION ALL SELECT id_aviso, version_modelo, valor, uv_rsh FROM source s WHERE NOT EXISTS
      (SELECT 1 FROM target t WHERE t.id_aviso = s.id_aviso AND t.version_modelo = s.version_modelo)""",
    ["target", "source"],
)
def backfill(v: Views):
    return merge.backfill(v("source"), v("target"), ["id_aviso", "version_modelo"])


@query(
    f"""SELECT id_aviso, resultado, CAST(NULL AS VARCHAR) AS motivo, fecha_intento FROM attempts
    UNION ALL SELECT id_aviso, 'ok', NULL, TIMESTAMP '{RUN_AT}' FROM done WHERE version_modelo = 'v2'""",
    ["attempts", "done"],
)
def attempt_log(v: Views):
    log = merge.ensure_columns(v("attempts"), {"motivo": "string"})
    outcomes = v("done").filter("version_modelo = 'v2'").select("id_aviso", F.lit("ok").alias("resultado"))
    return merge.append_log(log, outcomes, F.lit(RUN_AT)).select("id_aviso", "resultado", "motivo", "fecha_intento")


SNAPSHOT_SQL = "SELECT id_aviso, comuna, moneda, latitud, first_seen FROM listings"


def _snapshot_input(v: Views):
    return v("listings").select("id_aviso", "comuna", "moneda", "latitud", "first_seen")


@query(SNAPSHOT_SQL, ["listings"])
def snapshot_roundtrip(v: Views):
    return snapshots.write_snapshot(_snapshot_input(v), fresh_path(v.spark, "snapshot"))


@query(SNAPSHOT_SQL, ["listings"])
def partitioned_roundtrip(v: Views):
    written = snapshots.write_partitioned(_snapshot_input(v), fresh_path(v.spark, "partitioned"), "moneda")
    return written.select("id_aviso", "comuna", "moneda", "latitud", "first_seen")


@query(SNAPSHOT_SQL, ["listings"])
def compacted_roundtrip(v: Views):
    return snapshots.compact(_snapshot_input(v), fresh_path(v.spark, "compacted"), "id_aviso")


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def csv_roundtrip(v: Views):
    rows, path = v("customer").select("c_custkey", "c_name", "c_nationkey"), fresh_path(v.spark, "csv")
    rows.write.option("header", True).csv(path)
    return read_csv(v.spark, path, rows.schema)


@query("SELECT id_aviso, comuna, latitud FROM listings WHERE latitud IS NOT NULL", ["listings"])
def guarded_rows(v: Views):
    """Rows that pass all guards come through as they are; `tests` hold what the guards refuse."""
    rows = v("listings").filter("latitud IS NOT NULL").select("id_aviso", "comuna", "latitud")
    return quality.require_not_null(quality.require_rows(quality.require_unique(rows, ["id_aviso"], "listings"), "listings"), ["id_aviso", "latitud"])
