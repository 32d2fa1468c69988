"""Written layers, load reports, streams of pages and outcomes."""

import builtins
import datetime as dt
import importlib
import random

import pandas as pd
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_lake.functions import cards
from listing_lake.catalog.views import Views
from listing_lake.operators import merge, quality
from listing_lake.operators.state import fold_states
from listing_lake.plans import scoring
from listing_lake.session import fresh_path
from listing_lake.sources import buckets, snapshots
from listing_lake.streaming import publication

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("w", T.IntegerType())])


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def files(layer):
    found = layer.read().select(buckets.BUCKET, F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in found:
        out.setdefault(r[buckets.BUCKET], set()).add(r["f"])
    return out


# ---------------------------------------------------------------- buckets

def test_an_upsert_rewrites_only_the_buckets_it_touches(spark):
    layer = buckets.Layer(spark, fresh_path(spark, "layer"), SCHEMA, ["k"], buckets=8)
    assert layer.read().collect() == []
    layer.insert_new(frame(spark, [(i, "a", i) for i in range(100)]))
    before = files(layer)
    source = frame(spark, [(3, "b", 0), (1003, "n", 1)])
    touched = layer.upsert(source, update=["v"])
    after = files(layer)
    assert 0 < len(touched) <= 2 and set(before) == set(range(8))
    assert all(after[b] == before[b] for b in before if b not in touched)
    assert all(not after[b] & before[b] for b in touched)
    want = {i: ("a", i) for i in range(100)} | {3: ("b", 3), 1003: ("n", 1)}
    assert {r["k"]: (r["v"], r["w"]) for r in layer.read().collect()} == want
    assert layer.update(frame(spark, [(5, "c", 9), (777, "x", 9)]), ["v"]) and layer.read().filter("k = 777").isEmpty()
    assert layer.read().filter("k = 5").first()["v"] == "c"


def test_an_insert_reads_only_the_buckets_it_touches(spark):
    layer = buckets.Layer(spark, fresh_path(spark, "layer"), SCHEMA, ["k"], buckets=8)
    layer.insert_new(frame(spark, [(i, "a", i) for i in range(50)]))
    before = files(layer)
    touched = layer.insert_new(frame(spark, [(1, "z", 0), (60, "z", 0)]))
    after = files(layer)
    assert all(after[b] == before[b] for b in before if b not in touched) and all(before[b] <= after[b] for b in touched)
    assert layer.read().count() == 51 and layer.read().filter("k = 1").first()["v"] == "a"
    text = plan(layer.read(touched).select("k"))
    assert f"PartitionFilters: [{buckets.BUCKET}#" in text and "IN (" in text or "= " in text
    layer.insert_new(frame(spark, [(1, "z", 0), (60, "z", 0)]))
    assert layer.read().count() == 51


def test_merges_refuse_a_source_row_without_a_key(spark):
    t = frame(spark, [(1, "a", 1), (None, "b", 2)])
    for made in (lambda: merge.merge_insert_only(t, t, "k"), lambda: merge.merge_upsert(t, t, "k")):
        with pytest.raises(Exception, match="source row without a key"):
            made().collect()
    assert merge.merge_insert_only(t, t.filter("k IS NOT NULL"), "k").count() == 2
    assert merge.merge_update(t, t, "k", ["v"]).count() == 2  # what matches nothing is dropped there


# ---------------------------------------------------------------- small files and reports

def test_compaction_leaves_partitions_of_large_files_alone(spark):
    path = fresh_path(spark, "days")
    large = spark.range(200_000).select(F.xxhash64("id").alias("x"), F.lit("large").alias("day"))
    large.coalesce(1).write.partitionBy("day").parquet(path)
    for i in range(6):
        spark.range(20 * i, 20 * i + 20).select(F.col("id").alias("x"), F.lit("small").alias("day")).repartition(2).write.mode("append").partitionBy("day").parquet(path)
    schema = T.StructType([T.StructField("x", T.LongType()), T.StructField("day", T.StringType())])
    table = lambda: spark.read.schema(schema).parquet(path)
    names = lambda: {(r["day"], r["path"]) for r in snapshots.file_sizes(spark, path, "day").collect()}
    before, content = names(), rows(table().filter("day = 'small'"))
    assert snapshots.compact_small(spark, path, schema, "day", target_bytes=1 << 20, small_files=4) == ["small"]
    after = names()
    assert {x for x in after if x[0] == "large"} == {x for x in before if x[0] == "large"}
    assert len({x for x in before if x[0] == "small"}) == 12 and len({x for x in after if x[0] == "small"}) == 1
    assert rows(table().filter("day = 'small'")) == content and table().count() == 200_120
    assert snapshots.compact_small(spark, path, schema, "day", target_bytes=1 << 20, small_files=4) == []


def test_what_a_write_counts(spark):
    df = frame(spark, [(1, None, 5), (2, "x", None), (3, "y", 7)])
    table, metrics = snapshots.write_observed(df, fresh_path(spark, "observed"), {"sin_v": F.count_if(F.col("v").isNull()), "suma": F.sum("w")})
    assert metrics == {"total_filas": 3, "sin_v": 1, "suma": 12} and rows(table) == rows(df)
    drift = quality.schema_drift(df, T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("z", T.StringType())]))
    assert rows(drift) == [("k", "int", "bigint"), ("w", "int", None), ("z", None, "string")]


# ---------------------------------------------------------------- pages

def test_cards_of_odd_pages(spark):
    pages = {
        "no class match": "<div class='andes-cards'>x</div>", "captcha": "<CAPTCHA><div class='andes-card'>x</div>", "none": None, "empty": "",
        "nested": "<li class='a ui-search-layout__item b'><div class='andes-card'><h2 class=\"ui-search-item__title\"> A <i>b</i>&amp;c </h2>1 dormitorio</div></li>",
    }
    found = cards.page_cards(spark.createDataFrame(list(pages.items()), "p string, html string")).collect()
    assert [(r["p"], r["posicion"], r["titulo"], r["dormitorios"], r["precio"], r["url"], r["id_aviso"]) for r in found] == [("nested", 0, "Ab&c", "1", None, None, None)]


def test_descriptions(spark):
    pages = [
        ("<p class='ui-pdp-description__content'> one<br/>two &lt;3\n three </p>", "one\ntwo <3 three"),
        ("<div data-testid='core-description'><b>x</b><p class='q'>inner</p></div><p class='ui-pdp-description__content'>other</p>", "inner"),
        ("<div class='ui-pdp-description'>last <b>one</b></div>", "last one"), ("<p>none</p>", None), (None, None),
    ]
    got = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(pages)], "i int, html string").select("i", cards.description(F.col("html")).alias("d"))
    assert [r["d"] for r in sorted(got.collect())] == [d for _, d in pages]


# ---------------------------------------------------------------- outcomes

OUTCOMES = "id long, ts timestamp, seq long, resultado string, estado string"


def outcomes(spark, rng, n):
    data = [
        (rng.randrange(6), rng.randrange(5_000), i, rng.choice(["ok", "error", "error", "error", "captcha", "no_encontrado" if rng.random() < 0.05 else "ok"]), rng.choice(["activo", "activo", None, "pausado" if rng.random() < 0.1 else "activo"]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id long, s long, seq long, resultado string, estado string").select(
        "id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s") * 60).alias("ts"), "seq", "resultado", "estado"
    )


def test_outcomes_in_any_order_give_the_same_states(spark):
    rng = random.Random(4)
    late = outcomes(spark, rng, 240)
    folder, target, checkpoint = (fresh_path(spark, x) for x in ("outcomes", "states", "checkpoint"))
    for part in range(3):
        late.filter(F.col("seq") % 3 == part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(late.schema).parquet(folder)
        publication.follow_states(stream, target, checkpoint, lateness="10 days").awaitTermination()
    field = T.StructField("id", T.LongType())
    assert rows(publication.current_states(spark, target, field)) == rows(fold_states(late))


def test_a_batch_writes_only_the_listings_it_touches(spark):
    rows_ = [(i, f"2024-01-0{d} 00:00:00", 10 * i + d, "error", None) for i in range(5) for d in (1, 2)]
    make = lambda part: spark.createDataFrame(part, "id long, t string, seq long, resultado string, estado string").select("id", F.to_timestamp("t").alias("ts"), "seq", "resultado", "estado")
    initial = spark.createDataFrame([(0, "activo", 5, None), (9, "pausado", 0, None)], "id long, estado_publicacion string, intentos_fallidos int, fecha_chequeo timestamp")
    folder, target, checkpoint = (fresh_path(spark, x) for x in ("outcomes", "states", "checkpoint"))
    seen = []
    for part in (rows_, [(3, "2024-01-03 00:00:00", 99, "ok", "pausado")], [(1, "2023-12-01 00:00:00", 100, "no_encontrado", None)]):
        make(part).write.mode("append").parquet(folder)
        query = publication.follow_states(
            spark.readStream.schema(make(part).schema).parquet(folder), target, checkpoint, lateness="1 day", initial=initial
        )
        query.awaitTermination()
        seen.append(spark.read.parquet(target).groupBy("_lote").agg(F.collect_set("id").alias("ids")).collect())
    by_batch = {r["_lote"]: set(r["ids"]) for r in seen[-1]}
    assert {3} in by_batch.values()
    states = {r["id"]: (r["estado_publicacion"], r["intentos_fallidos"]) for r in publication.current_states(spark, target, T.StructField("id", T.LongType())).collect()}
    # the initial counter goes on, an outcome behind the watermark does not count
    assert states[0] == ("no_disponible", 0) and states[3] == ("pausado", 0) and states[1] == ("activo", 2)
    gold = spark.createDataFrame([(3, "activo"), (77, "pausado")], "id_aviso long, estado_publicacion string")
    now = publication.current_states(spark, target, T.StructField("id", T.LongType())).withColumnRenamed("id", "id_aviso")
    back = {r["id_aviso"]: r["estado_publicacion"] for r in publication.with_current_states(gold, now).collect()}
    assert back == {3: "pausado", 77: "pausado"}


# ---------------------------------------------------------------- errors that must be clear

def test_calibration_without_real_costs(spark):
    df = spark.createDataFrame([(None, 1.0, 0.1)], "costo_total_real double, costo_total_predicho double, cv_ensamble double")
    with pytest.raises(ValueError, match="no priced listing"):
        scoring.fit_calibration(df)


@pytest.mark.parametrize("missing", ["corpus_pipeline", "public_tokenizers", "tokenizers"])
def test_core_queries_without_the_optional_part(monkeypatch, missing):
    import __spark_entry__ as entry

    real = builtins.__import__

    def fail(name, *args, **kwargs):
        if name.split(".")[0] == missing or (missing != "corpus_pipeline" and name == "corpus_pipeline"):
            raise ImportError(f"no {missing}")
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", fail)
    importlib.reload(entry)
    assert "price_by_comuna" in entry.queries() and not any(q.startswith("op") or q == "pipeline" for q in entry.queries())


def test_customers_are_not_broadcast_to_the_listings(spark, tmp_path):
    spark.sql("SELECT id AS c_custkey, id % 25 AS c_nationkey FROM range(9)").write.parquet(f"{tmp_path}/customer.parquet")
    orders = "SELECT id AS o_orderkey, id % 9 AS o_custkey, 1.5D AS o_totalprice, DATE '2024-01-02' AS o_orderdate FROM range(30)"
    spark.sql(orders).write.parquet(f"{tmp_path}/orders.parquet")
    listings = Views(spark, str(tmp_path))("listings")
    assert "SortMergeJoin" in listings._jdf.queryExecution().executedPlan().toString()
    assert listings.count() == 30


class _Stored:
    """A state of one listing that counts what is asked of it."""

    def __init__(self, value):
        self.value, self.calls = value, []

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            return self.value if name == "get" else self.value is not None if name == "exists" else None

        return call


def test_a_listing_whose_state_is_final_is_read_once_and_not_written():
    states = publication.PublicationStates("id", 5)
    states.settled, states.waiting = _Stored(("pausado", 0, dt.datetime(2024, 1, 2))), _Stored([])
    timer = type("Timer", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    outcomes = pd.DataFrame({"ts": [pd.Timestamp("2024-01-03")], "seq": [1], "resultado": ["ok"], "estado": ["activo"]})
    (got,) = states.handleInputRows((1,), iter([outcomes]), timer)
    assert got["estado_publicacion"].tolist() == ["pausado"] and got["fecha_chequeo"].tolist() == [pd.Timestamp("2024-01-02")]
    assert states.settled.calls == ["get"] and states.waiting.calls == []
