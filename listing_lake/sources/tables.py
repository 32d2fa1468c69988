"""Readers: Parquet tables, CSV and JSON reference files, polygon texts and fixed relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_lake.functions.dates import iso_day
from listing_lake.functions.geo import mercator_lat, mercator_lon

# The communes of the area, with the name the polygon file uses and the centre.
COMUNAS = {
    "concepcion-biobio": ("CONCEPCION", -36.8265, -73.0524),
    "talcahuano-biobio": ("TALCAHUANO", -36.7249, -73.1149),
    "hualpen-biobio": ("HUALPEN", -36.7690, -73.1000),
    "san-pedro-de-la-paz-biobio": ("SAN PEDRO DE LA PAZ", -36.8380, -73.0970),
    "chiguayante-biobio": ("CHIGUAYANTE", -36.9280, -73.0230),
    "penco-biobio": ("PENCO", -36.7420, -72.9970),
    "tome-biobio": ("TOME", -36.6180, -72.9570),
    "coronel-biobio": ("CORONEL", -37.0270, -73.1370),
    "hualqui-biobio": ("HUALQUI", -36.9670, -72.9420),
    "lota-biobio": ("LOTA", -37.0920, -73.1600),
}
CITY_CENTER = (-36.8265, -73.0524)
DOLLAR_CLP = 925.0

_SERIES = "struct<serie:array<struct<fecha:string,valor:double>>>"
_LEVELS = "struct<mapa_barrio_a_nivel:map<string,double>,nivel_default:double>"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of a folder of Parquet tables."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV file with a header, columns taken by name from the header; types are given, never inferred."""
    header = spark.read.option("header", True).csv(path)
    return header.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON files, one row each: ``path, document``."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("document"))


def read_level_map(documents: DataFrame, column: str = "document") -> tuple[DataFrame, DataFrame]:
    """Levels ``barrio, nivel_barrio`` and the default as a statistics row ``clave, valor``."""
    parsed = documents.select(F.from_json(column, _LEVELS).alias("d"))
    levels = parsed.select(F.explode("d.mapa_barrio_a_nivel").alias("barrio", "nivel")).select(
        "barrio", F.col("nivel").cast("int").alias("nivel_barrio")
    )
    default = parsed.select(F.lit("nivel_barrio_default").alias("clave"), F.col("d.nivel_default").alias("valor"))
    return levels, default


def explode_rate_series(documents: DataFrame, order: str = "path", column: str = "document") -> DataFrame:
    """Published rates ``fecha_valor, valor`` from yearly series documents, one row per date.

    ``order`` names the column that ranks the documents (their year, or a path that contains it): for
    a date published twice the later document counts, and within one the later position.
    """
    items = documents.select(
        F.col(order).alias("__doc"), F.posexplode(F.from_json(column, _SERIES)["serie"]).alias("pos", "item")
    )
    return (
        items.select(
            iso_day(F.col("item.fecha")).alias("fecha_valor"), F.col("item.valor").alias("valor"),
            F.struct("__doc", "pos").alias("version"),
        )
        .filter(F.col("fecha_valor").isNotNull())
        .groupBy("fecha_valor")
        .agg(F.max_by("valor", "version").alias("valor"))
    )


def rate_rows(dates: DataFrame, series: DataFrame, asked_on: Column, dollar: float = DOLLAR_CLP) -> DataFrame:
    """Rate rows for the dates that have a published value; other dates get no row."""
    return dates.join(series, "fecha_valor", "inner").select(
        "fecha_valor", F.col("valor").alias("valor_uf_clp"), F.lit(float(dollar)).alias("valor_dolar_clp"),
        asked_on.cast("date").alias("fecha_consulta"),
    )


def centers(spark: SparkSession) -> DataFrame:
    """Centre of each commune: ten fixed rows."""
    rows = [(slug, lat, lon) for slug, (_, lat, lon) in COMUNAS.items()]
    return spark.createDataFrame(rows, "comuna string, lat_centro double, lon_centro double")


def reproject_wkt(wkt: Column) -> Column:
    """The same geometry text with every vertex taken from Web Mercator to degrees."""
    pair = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)\s+(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    between = F.split(wkt, pair.replace("(-?", "(?:-?"))
    xs = F.regexp_extract_all(wkt, F.lit(pair), F.lit(1))
    ys = F.regexp_extract_all(wkt, F.lit(pair), F.lit(2))
    vertices = F.zip_with(
        xs, ys,
        lambda x, y: F.concat_ws(
            " ", mercator_lon(x.cast("double")).cast("string"), mercator_lat(y.cast("double")).cast("string")
        ),
    )
    pieces = F.zip_with(between, vertices, lambda text, vertex: F.concat(text, F.coalesce(vertex, F.lit(""))))
    return F.array_join(pieces, "")


def ingest_polygons(raw: DataFrame, mercator: bool = True) -> DataFrame:
    """Polygons of the area's communes: names normalised, other communes dropped, degrees as unit."""
    name = F.upper(F.trim("comuna"))
    kept = raw.filter(name.isin([n for n, _, _ in COMUNAS.values()])).withColumn("comuna", name)
    return kept.withColumn("geometria_wkt", reproject_wkt(F.col("geometria_wkt"))) if mercator else kept
