import dataclasses

import pytest
from conftest import rows
from pyspark.sql import functions as F

from listing_lake.catalog import lake as catalog_lake
from listing_lake.catalog.views import Views
from listing_lake.operators.increments import existing_table
from listing_lake.plans import clean, features, lake
from listing_lake.plans.scoring import read_calibration
from listing_lake.session import fresh_path
from listing_lake.sources import snapshots, tables
from listing_lake.schemas import GROUP_STATISTICS, PREDICTIONS, REFERENCE, SELECTED_FEATURES, STATISTICS, TRAINING_ROWS
from listing_lake.streaming import micro_batches

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views(spark):
    return Views(spark, FOLDER)


CALIBRATION = (
    '{"bordes_deciles_precio":[0,300000,900000,9000000],"stats_por_decil":{"0":{"mediana_error":1,"mad_error":2},'
    '"1":{"mediana_error":0,"mad_error":5},"2":{"mediana_error":0,"mad_error":0}},"bordes_cv_confianza":[0,0.1,9],'
    '"etiquetas_confianza":["alta","baja"],"mad_scale_const":1.5,"umbral_oportunidad":1,"umbral_caro":1}'
)


def fixed_model(spark):
    """The catalog's model with a calibration that does not depend on the rows seen."""
    calibration = read_calibration(spark.createDataFrame([(CALIBRATION,)], "document string"))
    return dataclasses.replace(catalog_lake.model(), calibration=calibration)


def test_two_increments_equal_one_pass_and_a_rerun_adds_nothing(spark, views):
    listings, details = catalog_lake.bronze(views)
    half = listings.filter(F.crc32("id_aviso") % 2 == 0)
    model = fixed_model(spark)
    drop = ["fecha_prediccion"]

    def run(root, inputs):
        frozen = catalog_lake.frozen(views, root)
        for part in inputs:
            out = lake.advance(root, part, details, views("rates"), catalog_lake._polygons(views), frozen, model, by_day=None)
        return rows(out.drop(*drop))

    root = fresh_path(spark, "once")
    once = run(root, [listings])
    assert once and run(fresh_path(spark, "twice"), [half, listings, listings]) == once
    for name, schema in {
        "predicciones": PREDICTIONS, "poblacion_referencia": REFERENCE, "referencia_estadisticas": STATISTICS,
        "referencia_estadisticas_por_comuna": GROUP_STATISTICS,
    }.items():
        assert dict(spark.read.parquet(f"{root}/{name}").dtypes) == {f.name: f.dataType.simpleString() for f in schema}


def test_wide_rows_pass_the_lookups_of_gold_as_one_column(spark, views):
    root = fresh_path(spark, "lake")
    frozen = catalog_lake.frozen(views, root)
    listings, details = catalog_lake.bronze(views)
    silver = lake.add_silver(root, listings, details, views("rates"), catalog_lake.model(), by_day=None)
    gold = features.build_features(silver, frozen.population, frozen.levels, frozen.by_comuna, frozen.scalars)
    widths, open_ = [], [gold._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName() == "Join":
            widths.append(node.output().size())
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    assert len(silver.columns) > 60 and widths and max(widths) < 45
    kept = [c for c in silver.columns if c.endswith("_texto") or c in ("descripcion", "fecha_publicacion_aprox", "precio_clp")]
    assert len(kept) > 20 and set(silver.columns) < set(gold.columns) and gold.count() > 0
    assert rows(gold.select("id_aviso", *kept)) == rows(silver.join(gold.select("id_aviso"), "id_aviso", "left_semi").select("id_aviso", *kept))


def test_calibration_of_a_version_is_fitted_once(spark):
    root, fitted = fresh_path(spark, "calibration"), []
    gold = spark.createDataFrame([("a", 1.0)], "id_aviso string, precio_clp double")

    def fit(df):
        fitted.append(df)
        return read_calibration(spark.createDataFrame([(CALIBRATION,)], "document string"))

    first = dataclasses.replace(catalog_lake.model(), version="2024/1", calibration=fit)
    want = read_calibration(spark.createDataFrame([(CALIBRATION,)], "document string")).collect()
    assert [lake.frozen_calibration(root, gold, first).collect() for _ in range(2)] == [want, want]
    assert len(fitted) == 1
    lake.frozen_calibration(root, gold, dataclasses.replace(first, version="2024"))
    assert len(fitted) == 2
    # a write that was cut short leaves a folder without rows
    spark.createDataFrame([], read_calibration(spark.createDataFrame([(CALIBRATION,)], "document string")).schema).write.parquet(
        f"{root}/calibraciones/3"
    )
    assert lake.frozen_calibration(root, gold, dataclasses.replace(first, version="3")).collect() == want


def test_version_that_looks_like_a_number_stays_text(spark):
    path = fresh_path(spark, "versions")
    done = spark.createDataFrame([("a", "010"), ("b", "10")], "id_aviso string, version_modelo string")
    done.write.partitionBy("version_modelo").parquet(path)
    read = lake.layer(spark, path, "id_aviso string, version_modelo string")
    assert sorted(map(tuple, read.collect())) == [("a", "010"), ("b", "10")]


def test_first_run_and_table_switch(spark, views):
    assert existing_table(spark, "no_such_table") is None
    spark.range(3).write.saveAsTable("some_ids")
    assert existing_table(spark, "some_ids").count() == 3


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named and fresh_path(spark, "x").startswith(f"{named}/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_malformed_publication_day_gets_no_rate(spark):
    df = spark.createDataFrame(
        [("a", "2024-13-01", "2024-01-01"), ("b", None, "2024-01-01"), ("c", "2024-01-01", "x")],
        "id string, fecha_publicacion_aprox string, first_seen string",
    )
    rates = spark.sql("SELECT DATE'2024-01-01' AS fecha_valor, 1.0D AS valor_uf_clp, 2.0D AS valor_dolar_clp")
    got = {r["id"]: r["valor_uf_clp"] for r in clean.attach_rate(df, rates).collect()}
    assert got == {"a": None, "b": 1.0, "c": 1.0}


def test_rate_rows_skip_unpublished_days(spark):
    documents = spark.createDataFrame(
        [("2023", '{"serie":[{"fecha":"2023-12-31T03:00:00.000Z","valor":5.0},{"fecha":"2023-01-02T03:00:00.000Z","valor":1.0}]}'),
         ("2024", '{"serie":[{"fecha":"2023-12-31T03:00:00.000Z","valor":7.0},{"fecha":"bad","valor":1.0}]}'), ("2025", "not json")],
        "path string, document string",
    )
    series = tables.explode_rate_series(documents)
    assert sorted((str(d), v) for d, v in rows(series)) == [("2023-01-02", 1.0), ("2023-12-31", 7.0)]
    needed = spark.sql("SELECT explode(array(DATE'2023-12-31', DATE'2024-05-05')) AS fecha_valor")
    got = tables.rate_rows(needed, series, F.lit("2024-06-01")).collect()
    assert [(str(r["fecha_valor"]), r["valor_uf_clp"], r["valor_dolar_clp"]) for r in got] == [("2023-12-31", 7.0, 925.0)]


def test_reference_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("costo_total_clp,id_aviso,otra,superficie_util_m2,antiguedad_anos,piso_unidad,rank_nac,pob_rsh_uv,p_urbano,c_ig_com,hog_uv\n"
                                    "1000.5,MLC-1,x,50,,3,1,2,3,4,5\n", encoding="utf-8")
    got = tables.read_csv(spark, str(tmp_path / "t.csv"), TRAINING_ROWS)
    assert [f.dataType for f in got.schema] == [f.dataType for f in TRAINING_ROWS]
    assert (got.first()["id_aviso"], got.first()["costo_total_clp"], got.first()["antiguedad_anos"]) == ("MLC-1", 1000.5, None)
    (tmp_path / "f.csv").write_text("feature\na\nb\n", encoding="utf-8")
    assert rows(tables.read_csv(spark, str(tmp_path / "f.csv"), SELECTED_FEATURES)) == [("a",), ("b",)]
    (tmp_path / "n.json").write_text('{"mapa_barrio_a_nivel": {"Centro": 2, "Ñuble": 1},\n "nivel_default": 3}', encoding="utf-8")
    levels, default = tables.read_level_map(tables.read_documents(spark, str(tmp_path / "n.json")))
    assert rows(levels) == [("Centro", 2), ("Ñuble", 1)] and rows(default) == [("nivel_barrio_default", 3.0)]


def test_partitions_are_pruned_and_files_sorted(spark, views, tmp_path):
    df = views("listings").select("id_aviso", "moneda", "k")
    table = snapshots.write_partitioned(df, str(tmp_path / "p"), "moneda")
    text = table.filter("moneda = 'UF'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(moneda" in text
    assert rows(table.select("id_aviso", "moneda", "k")) == rows(df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would need one file only
    try:
        compacted = snapshots.compact(df, str(tmp_path / "c"), "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = sorted(tuple(r) for r in compacted.groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).select("min(k)", "max(k)").collect())
    assert 1 < len(spans) <= 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_stream_can_be_resumed(spark, views, tmp_path):
    df = views("listings").select("id_aviso", "k")
    landing, target, mark = (str(tmp_path / d) for d in ("landing", "target", "mark"))

    def land_and_run(part):
        part.coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(df.schema).parquet(landing)
        micro_batches.append_new_rows(stream, target, mark, ["id_aviso"], [F.col("k")]).awaitTermination()
        return micro_batches.read_batches(spark, target, df.schema)

    assert land_and_run(df.filter("k % 2 = 0")).count() == df.filter("k % 2 = 0").count()
    final = land_and_run(df.unionByName(df))
    assert rows(final.select("id_aviso", "k")) == rows(df)
