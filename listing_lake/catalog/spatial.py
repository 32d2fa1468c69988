"""Reference population, distance joins, cascades and polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_lake.catalog.registry import query
from listing_lake.catalog.views import Views
from listing_lake.functions.geo import mercator_lat, mercator_lon
from listing_lake.operators import quantiles as Q
from listing_lake.operators.lookup import skew_join, with_scalars
from listing_lake.operators.spatial import distance_join, point_in_polygon, polygon_edges, same_point_median
from listing_lake.plans import features
from listing_lake.plans import reference as R
from listing_lake.session import fresh_path
from listing_lake.sources import snapshots
from listing_lake.sources.tables import ingest_polygons

MEANS = ["rank_nac", "p_urbano"]


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371000 * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))"
    )


GAP_SQL = haversine_sql("p.latitud", "p.longitud", "r.latitud", "r.longitud")

# the reference with its price per square metre and the validity flag
VALUED_SQL = """fence AS (SELECT q1 - 3 * (q3 - q1) AS lo, q3 + 3 * (q3 - q1) AS hi FROM (
    SELECT quantile_cont(precio_m2, 0.25) AS q1, quantile_cont(precio_m2, 0.75) AS q3
    FROM (SELECT costo_total_clp / nullif(superficie_util_m2, 0) AS precio_m2 FROM reference) a) b),
  valued AS (SELECT *, COALESCE(precio_m2 BETWEEN lo AND hi, false) AS precio_m2_valido
    FROM (SELECT *, costo_total_clp / nullif(superficie_util_m2, 0) AS precio_m2 FROM reference) a CROSS JOIN fence)"""


def valued(v: Views):
    """The reference as a table of its own: written once, then read by every statistic."""
    return snapshots.write_snapshot(R.price_per_m2(v("reference")), fresh_path(v.spark, "reference"))


@query(f"WITH {VALUED_SQL} SELECT ref_id, comuna, precio_m2, precio_m2_valido FROM valued", ["reference"])
def reference_population(v: Views):
    return R.price_per_m2(v("reference")).select("ref_id", "comuna", "precio_m2", "precio_m2_valido")


@query(
    """SELECT p.id_aviso, p.comuna, r.ref_id, r.rank_nac FROM reference r
    JOIN listings p ON p.id_aviso = concat('MLC-', CAST(r.ref_id AS VARCHAR)) WHERE p.latitud IS NOT NULL AND p.longitud IS NOT NULL""",
    ["reference", "listings"],
)
def reference_coordinates(v: Views):
    training = v("reference").select(
        F.concat(F.lit("MLC-"), F.col("ref_id").cast("string")).alias("id_aviso"), "ref_id", "rank_nac"
    )
    return R.with_coordinates(training, v("listings")).select("id_aviso", "comuna", "ref_id", "rank_nac")


@query(
    """SELECT comuna, quantile_disc(antiguedad_anos, 0.5) AS mediana_antiguedad, round(avg(rank_nac), 6) AS media_rank_nac,
      round(avg(p_urbano), 6) AS media_p_urbano FROM reference GROUP BY comuna""",
    ["reference"],
)
def stats_by_group(v: Views):
    return R.stats_by_group(v("reference"), MEANS).select(
        "comuna", "mediana_antiguedad", *[F.round(f"media_{c}", 6).alias(f"media_{c}") for c in MEANS]
    )


STATS_SQL = f"""WITH {VALUED_SQL}, stats AS (
    SELECT 'mediana_antiguedad_global' AS clave, quantile_disc(antiguedad_anos, 0.5) AS valor FROM valued
    UNION ALL SELECT 'piso_promedio', avg(piso_unidad) FROM valued
    UNION ALL SELECT 'media_rank_nac_global', avg(rank_nac) FROM valued
    UNION ALL SELECT 'media_p_urbano_global', avg(p_urbano) FROM valued
    UNION ALL SELECT 'lim_inf_precio_m2', lo FROM fence
    UNION ALL SELECT 'lim_sup_precio_m2', hi FROM fence
    UNION ALL SELECT 'mediana_precio_m2_fallback', median(precio_m2) FROM valued WHERE precio_m2_valido)"""


@query(f"{STATS_SQL} SELECT clave, round(valor, 4) AS valor FROM stats", ["reference"])
def stats_kv(v: Views):
    return R.stats_to_kv(valued(v), MEANS).withColumn("valor", F.round("valor", 4))


STATS_KEYS = ["mediana_antiguedad_global", "piso_promedio", "media_rank_nac_global", "mediana_precio_m2_fallback", "nivel_barrio_default"]


@query(
    f"""{STATS_SQL} SELECT {", ".join(f"round(max(CASE WHEN clave = '{k}' THEN valor END), 4) AS {k}" for k in STATS_KEYS)}
    FROM stats""",
    ["reference"],
)
def stats_pivot(v: Views):
    row = R.pivot_stats(R.stats_to_kv(valued(v), MEANS), STATS_KEYS)
    return row.select(*[F.round(k, 4).alias(k) for k in STATS_KEYS])


@query(
    f"WITH {VALUED_SQL} SELECT round(median(precio_m2), 4) AS mediana_precio_m2_fallback FROM valued WHERE precio_m2_valido",
    ["reference"],
)
def fallback_median(v: Views):
    return R.fallback_median(valued(v)).select(F.round("mediana_precio_m2_fallback", 4).alias("mediana_precio_m2_fallback"))


@query(
    """SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(median(l_extendedprice), 4) AS q2,
      round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, quantile_disc(l_extendedprice, 0.5) AS mediana_inferior, l_returnflag
    FROM lineitem GROUP BY l_returnflag"""
)
def group_quantiles(v: Views):
    points = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    q = Q.quantiles(v("lineitem"), ["l_returnflag"], "l_extendedprice", points, lower_middle="mediana_inferior")
    return q.select("l_returnflag", *[F.round(c, 4).alias(c) for c in points], "mediana_inferior")


#: Seconds of one day and parts of them: all values share sign and exponent, and most differ.
INSTANT_SQL = "CAST(1704067200 + (l_orderkey * 7919 + l_linenumber * 104729) % 86400 AS DOUBLE) + CAST(l_partkey % 1024 AS DOUBLE) / 1024"


@query(
    f"""SELECT l_linestatus, round(quantile_cont(x, 0.01), 4) AS p01, round(quantile_cont(x, 0.5), 4) AS p50, round(quantile_cont(x, 0.999), 4) AS p999,
      quantile_disc(x, 0.5) AS mediana_inferior FROM (SELECT l_linestatus, {INSTANT_SQL} AS x FROM lineitem) t GROUP BY l_linestatus"""
)
def quantiles_narrow_band(v: Views):
    rows = v("lineitem").select("l_linestatus", F.expr(INSTANT_SQL).alias("x"))
    points = {"p01": 0.01, "p50": 0.5, "p999": 0.999}
    return Q.quantiles(rows, ["l_linestatus"], "x", points, lower_middle="mediana_inferior", budget=1_000).select(
        "l_linestatus", *[F.round(c, 4).alias(c) for c in points], "mediana_inferior"
    )


@query(
    f"""SELECT id_aviso, CAST(CASE WHEN piso_unidad IS NULL THEN 1.0 WHEN piso_unidad > 30 THEN m ELSE piso_unidad END AS DOUBLE) AS piso_unidad
    FROM amenities CROSS JOIN (SELECT round(avg(piso_unidad), 6) AS m FROM reference) s""",
    ["amenities", "reference"],
)
def floor_fix(v: Views):
    mean = v("reference").agg(F.round(F.avg("piso_unidad"), 6).alias("piso_promedio"))
    rows = with_scalars(v("amenities").select("id_aviso", "piso_unidad"), mean)
    return features.fix_floor(rows, F.col("piso_promedio")).drop("piso_promedio")


CENTERS_SQL = """centros(comuna, lat, lon) AS (VALUES ('concepcion-biobio', -36.8265, -73.0524), ('talcahuano-biobio', -36.7249, -73.1149),
    ('hualpen-biobio', -36.7690, -73.1000), ('san-pedro-de-la-paz-biobio', -36.8380, -73.0970), ('chiguayante-biobio', -36.9280, -73.0230),
    ('penco-biobio', -36.7420, -72.9970), ('tome-biobio', -36.6180, -72.9570), ('coronel-biobio', -37.0270, -73.1370),
    ('hualqui-biobio', -36.9670, -72.9420), ('lota-biobio', -37.0920, -73.1600))"""


@query(
    f"""WITH {CENTERS_SQL}, c AS (SELECT comuna, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM centros)
    SELECT p.id_aviso, round({haversine_sql('p.latitud', 'p.longitud', 'c.lat', 'c.lon')}, 3) AS distancia_centro_comuna_m,
      round({haversine_sql('p.latitud', 'p.longitud', 'CAST(-36.8265 AS DOUBLE)', 'CAST(-73.0524 AS DOUBLE)')}, 3) AS distancia_centro_concepcion_m
    FROM placed p LEFT JOIN c ON p.comuna = c.comuna""",
    ["placed"],
)
def center_distances(v: Views):
    rows = features.center_distances(v("placed"))
    return rows.select(
        "id_aviso",
        *[F.round(c, 3).alias(c) for c in ("distancia_centro_comuna_m", "distancia_centro_concepcion_m")],
    )


@query(
    f"""SELECT p.id_aviso, count(*) AS vecinos, round(min(d), 3) AS distancia_min_m FROM (
      SELECT p.id_aviso, {GAP_SQL} AS d FROM listings p JOIN reference r ON p.latitud IS NOT NULL AND {GAP_SQL} <= 300) p
    GROUP BY p.id_aviso""",
    ["listings", "reference"],
)
def neighbors_300m(v: Views):
    # places instead of listings, and weighted reference points, so copies meet once
    places = v("listings").select("latitud", "longitud").dropna().distinct()
    points = v("reference").groupBy(F.col("latitud").alias("ref_latitud"), F.col("longitud").alias("ref_longitud")).agg(
        F.count(F.lit(1)).alias("peso")
    )
    near = distance_join(places, points, 300.0).groupBy("latitud", "longitud").agg(
        F.sum("peso").alias("vecinos"), F.round(F.min("distancia_m"), 3).alias("distancia_min_m")
    )
    listings = v("listings").select("id_aviso", "latitud", "longitud")
    return skew_join(listings, near, ["latitud", "longitud"], "inner").drop("latitud", "longitud")


@query(
    f"""SELECT p.id_aviso, count(*) AS vecinos FROM dense_probes p JOIN dense_points r
      ON {GAP_SQL} <= 60 GROUP BY p.id_aviso""",
    ["dense_probes", "dense_points"],
)
def dense_spot(v: Views):
    """A spot that is crowded on both sides, every row with coordinates of its own."""
    points = v("dense_points").withColumnsRenamed({"latitud": "ref_latitud", "longitud": "ref_longitud"})
    near = distance_join(v("dense_probes"), points, 60.0)
    return near.groupBy("id_aviso").agg(F.count(F.lit(1)).alias("vecinos"))


@query(
    f"""WITH {VALUED_SQL}, near AS (SELECT p.id_aviso, quantile_disc(r.precio_m2, 0.5) AS m FROM listings p
      JOIN valued r ON r.precio_m2_valido AND p.latitud IS NOT NULL AND {GAP_SQL} <= 300 GROUP BY p.id_aviso),
    fb AS (SELECT round(median(precio_m2), 4) AS f FROM valued WHERE precio_m2_valido)
    SELECT l.id_aviso, COALESCE(near.m, fb.f) AS precio_m2_sector_departamento, near.m IS NOT NULL AS tiene_comparables_cercanos
    FROM listings l LEFT JOIN near ON near.id_aviso = l.id_aviso CROSS JOIN fb""",
    ["listings", "reference"],
)
def sector_price(v: Views):
    reference = valued(v)
    fallback = R.fallback_median(reference).select(F.round("mediana_precio_m2_fallback", 4).alias("fallback"))
    listings = with_scalars(v("listings").select("id_aviso", "latitud", "longitud"), fallback)
    return features.sector_price(listings, reference, F.col("fallback")).drop("latitud", "longitud", "fallback")


@query(
    """SELECT p.id_aviso, quantile_disc(r.antiguedad_anos, 0.5) AS antiguedad_exacta FROM listings p
    JOIN reference r ON r.latitud = p.latitud AND r.longitud = p.longitud WHERE p.antiguedad_anos IS NULL GROUP BY p.id_aviso""",
    ["listings", "reference"],
)
def same_point(v: Views):
    listings = v("listings").filter("antiguedad_anos IS NULL").select("id_aviso", "latitud", "longitud")
    medians = same_point_median(v("reference"), "antiguedad_anos", "antiguedad_exacta")
    return skew_join(listings, medians, ["latitud", "longitud"], "inner", large=True).select("id_aviso", "antiguedad_exacta")


@query(
    f"""WITH same AS (SELECT p.id_aviso, quantile_disc(r.antiguedad_anos, 0.5) AS m FROM listings p
      JOIN reference r ON r.latitud = p.latitud AND r.longitud = p.longitud WHERE p.antiguedad_anos IS NULL GROUP BY p.id_aviso),
    near AS (SELECT p.id_aviso, quantile_disc(r.antiguedad_anos, 0.5) AS m FROM listings p
      JOIN reference r ON p.antiguedad_anos IS NULL AND p.latitud IS NOT NULL AND {GAP_SQL} <= 200 GROUP BY p.id_aviso),
    com AS (SELECT comuna, quantile_disc(antiguedad_anos, 0.5) AS m FROM reference GROUP BY comuna),
    todo AS (SELECT quantile_disc(antiguedad_anos, 0.5) AS m FROM reference)
    SELECT l.id_aviso, COALESCE(l.antiguedad_anos, same.m, near.m, com.m, todo.m) AS antiguedad_anos
    FROM listings l LEFT JOIN same ON same.id_aviso = l.id_aviso LEFT JOIN near ON near.id_aviso = l.id_aviso
    LEFT JOIN com ON com.comuna = l.comuna CROSS JOIN todo""",
    ["listings", "reference"],
)
def age_cascade(v: Views):
    reference = v("reference")
    overall = Q.lower_median(reference, [], "antiguedad_anos", "m").agg(F.max("m").alias("mediana_antiguedad_global"))
    listings = with_scalars(v("listings").select("id_aviso", "comuna", "latitud", "longitud", "antiguedad_anos"), overall)
    by_comuna = Q.lower_median(reference, ["comuna"], "antiguedad_anos", "mediana_antiguedad")
    return features.age_cascade(listings, reference, by_comuna).select("id_aviso", "antiguedad_anos")


@query(
    """SELECT l.id_aviso, COALESCE(c.r, g.r) AS rank_nac, COALESCE(c.u, g.u) AS p_urbano FROM placed l
    LEFT JOIN (SELECT comuna, round(avg(rank_nac), 6) AS r, round(avg(p_urbano), 6) AS u FROM reference WHERE comuna <> 'comuna-7' GROUP BY comuna) c
      ON c.comuna = concat('comuna-', CAST(l.k % 40 AS VARCHAR))
    CROSS JOIN (SELECT round(avg(rank_nac), 6) AS r, round(avg(p_urbano), 6) AS u FROM reference WHERE comuna <> 'comuna-7') g""",
    ["placed", "reference"],
)
def vulnerability_fallback(v: Views):
    reference = v("reference").filter("comuna <> 'comuna-7'")
    overall = reference.agg(*[F.round(F.avg(c), 6).alias(f"media_{c}_global") for c in MEANS])
    listings = v("placed").select("id_aviso", F.concat(F.lit("comuna-"), (F.col("k") % 40).cast("string")).alias("comuna"))
    means = R.means_by_group(reference, MEANS).select(
        "comuna", *[F.round(f"media_{c}", 6).alias(f"media_{c}") for c in MEANS]
    )
    return features.vulnerability_fallback(with_scalars(listings, overall), means, MEANS).select("id_aviso", *MEANS)


# ---------------------------------------------------------------- polygons

COMUNA_LIST = "('CONCEPCION','TALCAHUANO','HUALPEN','SAN PEDRO DE LA PAZ','CHIGUAYANTE','PENCO','TOME','CORONEL','HUALQUI','LOTA')"
EDGES_SQL = f"""kept AS (SELECT uv_rsh, upper(trim(comuna)) AS comuna, rank_nac, p_urbano, geometria_wkt FROM polygons
    WHERE upper(trim(comuna)) IN {COMUNA_LIST}),
  rings AS (SELECT uv_rsh, unnest(regexp_extract_all(geometria_wkt, '\\(([^()]+)\\)', 1)) AS ring_text,
    generate_subscripts(regexp_extract_all(geometria_wkt, '\\(([^()]+)\\)', 1), 1) - 1 AS ring FROM kept),
  pts AS (SELECT uv_rsh, ring, unnest(string_split(ring_text, ',')) AS p, generate_subscripts(string_split(ring_text, ','), 1) AS i FROM rings),
  xy AS (SELECT uv_rsh, ring, i, CAST(split_part(trim(p), ' ', 1) AS DOUBLE) AS x, CAST(split_part(trim(p), ' ', 2) AS DOUBLE) AS y FROM pts),
  edges AS (SELECT a.uv_rsh, CAST(a.ring AS INTEGER) AS ring, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
    FROM xy a JOIN xy b ON a.uv_rsh = b.uv_rsh AND a.ring = b.ring AND b.i = a.i + 1)"""
INSIDE_SQL = f"""{EDGES_SQL},
  boxes AS (SELECT uv_rsh, min(least(x1, x2)) AS x0, max(greatest(x1, x2)) AS x9, min(least(y1, y2)) AS y0, max(greatest(y1, y2)) AS y9 FROM edges GROUP BY uv_rsh),
  cand AS (SELECT l.id_aviso, l.longitud AS px, l.latitud AS py, b.uv_rsh FROM listings l JOIN boxes b
    ON l.longitud BETWEEN b.x0 AND b.x9 AND l.latitud BETWEEN b.y0 AND b.y9),
  hits AS (SELECT c.id_aviso, c.uv_rsh,
      sum(CASE WHEN (y1 > py) <> (y2 > py) THEN CASE WHEN px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END ELSE 0 END) AS crossings,
      max(CASE WHEN px BETWEEN least(x1, x2) AND greatest(x1, x2) AND py BETWEEN least(y1, y2) AND greatest(y1, y2)
        AND (y1 = y2 OR (x2 - x1) * (py - y1) = (px - x1) * (y2 - y1)) THEN 1 ELSE 0 END) AS touching
    FROM cand c JOIN edges e ON e.uv_rsh = c.uv_rsh GROUP BY c.id_aviso, c.uv_rsh),
  resolved AS (SELECT id_aviso, min(uv_rsh) AS uv_rsh FROM hits WHERE crossings % 2 = 1 AND touching = 0 GROUP BY id_aviso)"""


def kept_polygons(v: Views):
    return ingest_polygons(v("polygons"), mercator=False)


@query(f"WITH {EDGES_SQL} SELECT uv_rsh, ring, x1, y1, x2, y2 FROM edges", ["polygons"], name="polygon_edges")
def edges_of_polygons(v: Views):
    return polygon_edges(kept_polygons(v), "uv_rsh", "geometria_wkt").withColumn("ring", F.col("ring").cast("int"))


@query(
    """SELECT o_orderkey, round((x / 6378137.0) * (180.0 / pi()), 7) AS lon,
      round((2 * atan(exp(y / 6378137.0)) - pi() / 2) * (180.0 / pi()), 7) AS lat
    FROM (SELECT o_orderkey, CAST(-8200000 + o_orderkey % 100000 AS DOUBLE) AS x, CAST(-4500000 + o_custkey % 90000 AS DOUBLE) AS y FROM orders) t"""
)
def reproject(v: Views):
    points = v("orders").select(
        "o_orderkey",
        (F.lit(-8200000) + F.col("o_orderkey") % 100000).cast("double").alias("x"),
        (F.lit(-4500000) + F.col("o_custkey") % 90000).cast("double").alias("y"),
    )
    return points.select(
        "o_orderkey", F.round(mercator_lon(F.col("x")), 7).alias("lon"), F.round(mercator_lat(F.col("y")), 7).alias("lat")
    )


@query(
    f"""SELECT uv_rsh, comuna, CAST(i AS INTEGER) AS vertice, round((x / 6378137.0) * (180.0 / pi()), 7) AS lon,
      round((2 * atan(exp(y / 6378137.0)) - pi() / 2) * (180.0 / pi()), 7) AS lat
    FROM (SELECT c_custkey, concat('uv', CAST(c_custkey AS VARCHAR)) AS uv_rsh, CASE WHEN c_custkey % 3 = 0 THEN 'PENCO' ELSE 'SAN PEDRO DE LA PAZ' END AS comuna,
      CASE i WHEN 0 THEN -8137000.5 - c_custkey WHEN 1 THEN -8136000.25 WHEN 2 THEN -8136500.0 END AS x,
      CASE i WHEN 0 THEN -4413000.0 WHEN 1 THEN -4413000.75 WHEN 2 THEN -4412000.0 + c_custkey END AS y, i
      FROM customer CROSS JOIN (VALUES (0), (1), (2)) n(i) WHERE c_custkey % 4 <> 0) t""",
)
def reproject_polygons(v: Views):
    raw = v("customer").select(
        F.concat(F.lit("uv"), F.col("c_custkey").cast("string")).alias("uv_rsh"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit("Santiago"))
        .when(F.col("c_custkey") % 3 == 0, F.lit(" penco"))
        .otherwise(F.lit("San Pedro de la Paz ")).alias("comuna"),
        F.format_string(
            "POLYGON ((-%d.5 -4413000.0, -8136000.25 -4413000.75, -8136500.0 -%d.0, -%d.5 -4413000.0))",
            F.lit(8137000) + F.col("c_custkey"), F.lit(4412000) - F.col("c_custkey"), F.lit(8137000) + F.col("c_custkey"),
        ).alias("geometria_wkt"),
    )
    kept = ingest_polygons(raw)
    edges = polygon_edges(kept, "uv_rsh", "geometria_wkt")
    # vertices again from the text, in reading order
    ring = F.regexp_extract("geometria_wkt", r"\(([^()]+)\)", 1)
    vertices = kept.select("uv_rsh", "comuna", F.posexplode(F.slice(F.split(ring, ","), 1, 3)).alias("vertice", "p"))
    xy = F.split(F.trim("p"), " ")
    return vertices.join(edges.select("uv_rsh").distinct(), "uv_rsh", "left_semi").select(
        "uv_rsh", "comuna", F.col("vertice").cast("int").alias("vertice"),
        F.round(xy[0].cast("double"), 7).alias("lon"), F.round(xy[1].cast("double"), 7).alias("lat"),
    )


@query(f"WITH {INSIDE_SQL} SELECT id_aviso, uv_rsh FROM resolved", ["listings", "polygons"], name="point_in_polygon")
def polygon_of_listing(v: Views):
    edges = polygon_edges(kept_polygons(v), "uv_rsh", "geometria_wkt")
    return point_in_polygon(v("listings"), edges, "id_aviso", "uv_rsh")


#: A saw across the listings' area with thousands of teeth, and a triangle as large as a continent, in micro-degrees.
TEETH = 4000
WIDE_SQL = f"""saw AS (SELECT i, CAST(-73110000 + i * 30 AS DOUBLE) / 1000000 AS x, CAST(-36800000 + CASE WHEN i % 2 = 0 THEN 0 ELSE (i * 7919) % 600 END AS DOUBLE) / 1000000 AS y
    FROM range(0, {TEETH}) t(i)),
  wide AS (SELECT 'sierra' AS uv_rsh, x AS x1, y AS y1, COALESCE(lead(x) OVER (ORDER BY i), CAST(-73.05 AS DOUBLE)) AS x2, COALESCE(lead(y) OVER (ORDER BY i), CAST(-36.9 AS DOUBLE)) AS y2 FROM saw
    UNION ALL SELECT 'sierra', CAST(-73.05 AS DOUBLE), CAST(-36.9 AS DOUBLE), CAST(-73.11 AS DOUBLE), CAST(-36.8 AS DOUBLE)
    UNION ALL SELECT 'tierra', * FROM (VALUES (CAST(-80 AS DOUBLE), CAST(-56 AS DOUBLE), CAST(-34.5 AS DOUBLE), CAST(-7.25 AS DOUBLE)),
      (-34.5, -7.25, -80, 12.5), (-80, 12.5, -80, -56)) v(x1, y1, x2, y2)),
  edges AS (SELECT uv_rsh, x1, y1, x2, y2 FROM small_edges UNION ALL SELECT * FROM wide)"""


@query(
    f"WITH {INSIDE_SQL.replace(EDGES_SQL, EDGES_SQL.replace('edges AS (', 'small_edges AS (') + ', ' + WIDE_SQL)} SELECT id_aviso, uv_rsh FROM resolved",
    ["listings", "polygons"],
)
def polygon_of_listing_wide(v: Views):
    """A polygon with thousands of edges and one as large as a continent among the small ones; the lowest key still counts."""
    small = polygon_edges(kept_polygons(v), "uv_rsh", "geometria_wkt").select("uv_rsh", "x1", "y1", "x2", "y2")
    saw = [((-73110000 + i * 30) / 1000000, (-36800000 + (0 if i % 2 == 0 else (i * 7919) % 600)) / 1000000) for i in range(TEETH)]
    rings = {"sierra": [*saw, (-73.05, -36.9), saw[0]], "tierra": [(-80.0, -56.0), (-34.5, -7.25), (-80.0, 12.5), (-80.0, -56.0)]}
    texts = [(k, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + "))") for k, ring in rings.items()]
    wide = polygon_edges(v.spark.createDataFrame(texts, "uv_rsh string, wkt string"), "uv_rsh", "wkt").drop("ring")
    return point_in_polygon(v("listings"), small.unionByName(wide), "id_aviso", "uv_rsh")


@query(
    f"""WITH {INSIDE_SQL}
    SELECT l.id_aviso, r.uv_rsh, CASE WHEN r.id_aviso IS NOT NULL THEN k.rank_nac ELSE CAST(-1 AS DOUBLE) END AS rank_nac,
      CASE WHEN r.id_aviso IS NOT NULL THEN k.p_urbano ELSE CAST(-1 AS DOUBLE) END AS p_urbano
    FROM listings l LEFT JOIN resolved r ON r.id_aviso = l.id_aviso LEFT JOIN kept k ON k.uv_rsh = r.uv_rsh""",
    ["listings", "polygons"],
)
def vulnerability_merge(v: Views):
    gold = v("listings").select("id_aviso", "latitud", "longitud").withColumns({c: F.lit(-1.0) for c in MEANS})
    merged = features.resolve_vulnerability(gold, kept_polygons(v), columns=MEANS)
    return merged.select("id_aviso", "uv_rsh", *MEANS)
