import datetime as dt

import pytest
from pyspark.sql import functions as F

from listing_lake.functions import calibration, cards, dates, geo, numbers, pages, text
from listing_lake.operators.spatial import polygon_edges
from listing_lake.sources.tables import reproject_wkt


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "fn, given, expected",
    [
        (numbers.parse_cl_number, ["1.234,5", "45", "", None, "x", "NaN", "5d", "1,2,3"], [1234.5, 45.0, None, None, None, None, None, None]),
        (numbers.parse_cl_price, ["450.000", "12,5", "12", None], [450000.0, None, 12.0, None]),
        (lambda c: numbers.parse_cl_price(c, decimal_comma=True), ["12,5"], [12.5]),
        (numbers.try_double, ["5.0", "-3", "1e3", "Infinity", "5d", " 7 ", "."], [5.0, -3.0, 1000.0, None, None, 7.0, None]),
        (numbers.parse_yes_no, ["Sí", "SÍ", "si", "No", "NO", "tal vez", None], [1, 1, 1, 0, 0, None, None]),
        (
            numbers.parse_common_charges,
            ["82.000", "10", "999", "1000", "1111111", "500000", "499999", "", None, "x", "9.999.999"],
            [82000.0, 0.0, 0.0, 1000.0, None, None, 499999.0, None, None, None, 9999999.0],
        ),
        (numbers.whole_or_zero, ["5.0", "2.9", "x", None, "-1.9"], [5, 2, 0, 0, -1]),
        (text.fold_accents, [" Jardínes ÑUÑOA ", "Clínicas"], ["jardines nunoa", "clinicas"]),
        (text.parse_distance_m, ["120 metros", "1,5 km", "1.5 KM", "cerca", None], [120.0, 1500.0, 15000.0, None, None]),
        (text.is_furnished, ["Depto amoblado", "AMUEBLADA", "vacío", None], [1, 1, 0, None]),
        (text.listing_id, ["https://x.cl/MLC-123-depto", "nada"], ["MLC-123", None]),
        (
            dates.date_precision, ["esta semana", " Esta Semana", "hoy", "", None],
            ["aproximada_categoria", "aproximada_categoria", "exacta", None, None],
        ),
    ],
)
def test_text_functions(spark, fn, given, expected):
    assert apply(spark, fn, given) == expected


def test_card_surface_needs_a_word_end(spark):
    surface = text.card_captures(F.col("v"))["superficie_m2"]
    assert apply(spark, lambda _: surface, ["45,5 m² total", "60 m2", "60 m2x", "60M2."]) == ["45,5", "60", None, "60"]


def test_charges_fall_back_to_the_summary(spark):
    charges = text.detail_captures(F.col("v"))["gastos_comunes"]
    given = ["Gastos comunes: $ 50.000", "Gastos comunes desde $ 40.000", "GASTOS COMUNES 7", "sin"]
    assert apply(spark, lambda _: charges, given) == ["50.000", "40.000", "7", None]


def test_coordinates_come_from_one_source(spark):
    html = ['"latitude":"-36.1","longitude":"-73.2"', '"latitude":"-36.1" center=-1.5%2C-2.5', "nada"]
    fields = text.coordinate_captures(F.col("v"))
    got = apply(spark, lambda _: F.struct(fields["latitud"].alias("a"), fields["longitud"].alias("b")), html)
    assert [tuple(r) for r in got] == [("-36.1", "-73.2"), ("-1.5", "-2.5"), (None, None)]


def test_relative_dates(spark):
    day = dt.date(2024, 3, 31)
    given = ["hoy", "Esta semana", "3 días", "1 semana", "2 meses", "1 año", "1 AÑO", "ayer", None, "99999999999 años", "2 dia"]
    expected = [day] + [day - dt.timedelta(days=d) for d in (3, 3, 7, 60, 365, 365)] + [None] * 4
    assert apply(spark, lambda c: dates.resolve_relative_date(c, F.lit(day)), given) == expected


def test_to_clp(spark):
    df = spark.createDataFrame(
        [(10.0, "UF", 30000.0, 900.0), (10.0, "us$", 30000.0, 900.0), (10.0, "USD$", None, None), (10.0, None, None, None), (10.0, "$", 1.0, 1.0)],
        "p double, c string, uf double, usd double",
    )
    got = [r[0] for r in df.select(numbers.to_clp(*[F.col(c) for c in ("p", "c", "uf", "usd")])).collect()]
    assert got == [300000.0, 9000.0, None, 10.0, 10.0]


def test_bucketize_is_closed_on_the_right(spark):
    edges = F.array(*[F.lit(x) for x in (0.0, 10.0, 20.0)])
    got = apply(spark, lambda c: calibration.bucketize(c, edges), [0.0, 0.1, 10.0, 10.1, 20.0, 20.1, -0.1, None], "double")
    assert got == [0, 0, 0, 1, 1, None, None, None]


def test_labels_and_zero_divisor(spark):
    label = lambda c: calibration.deal_label(c, F.lit(1.0), F.lit(2.0))
    assert apply(spark, label, [-1.0, -1.1, 2.0, 2.1, None], "double") == [
        "precio_de_mercado", "oportunidad", "precio_de_mercado", "caro", None,
    ]
    z = lambda c: calibration.robust_z(c, F.lit(1.0), F.lit(0.0), F.lit(1.5))
    assert apply(spark, z, [3.0], "double") == [pytest.approx(2e6)]


def test_haversine(spark):
    df = spark.range(1)
    near = df.select(geo.haversine_m(F.lit(-36.8), F.lit(-73.0), F.lit(-36.8), F.lit(-73.01))).first()[0]
    assert near == pytest.approx(890.4, abs=0.5)
    far = df.select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()[0]
    assert far == pytest.approx(20015086.8, abs=1)
    assert df.select(geo.haversine_m(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0] is None


def test_visible_text_leaves_scripts_and_comments_out(spark):
    html = "<html><head><title>t</title></head><body>a<script>b</script><!-- c --><p> d &amp; e </p></body></html>"
    assert apply(spark, pages.visible_text, [html]) == ["a\nd & e\n".strip()]


def test_state_parts_at_any_depth(spark):
    documents = [
        '{"a":[{"neighborhood":""},{"b":{"categories":[],"c":{"categories":[{"subcategories":[]}],"neighborhood":"Centro"}}}]}',
        '{"appProps":{"pageProps":{"initialState":{"components":{"head":[{"id":"x"}],"short_description":'
        '{"r":[{"id":"item_status_short_description_message","body":{"text":"Aviso PAUSADO"}}]}}}}}}',
        '{"appProps":{"pageProps":{"initialState":{"components":{"head":{"id":"item_status_message","body":null}}}}}}',
        "not json", None,
    ]
    got = apply(spark, lambda c: pages.state_parts(c), documents)
    assert (got[0]["categories"], got[0]["neighborhood"]) == ('[{"subcategories": []}]', "Centro")
    assert (got[1]["has_status"], got[1]["status_text"]) == (True, "Aviso PAUSADO")
    assert (got[2]["has_status"], got[2]["status_text"]) == (True, None)
    assert [g["has_status"] for g in got[3:]] == [False, False]
    states = spark.createDataFrame([(g["has_status"], g["status_text"]) for g in got], "h boolean, t string")
    assert [r[0] for r in states.select(pages.publication_state(F.col("h"), F.col("t"))).collect()] == [
        "activo", "pausado", "pausado", "activo", "activo",
    ]


def test_captcha_beyond_the_first_characters_does_not_count(spark):
    got = apply(spark, pages.mentions_captcha, ["x" * 7993 + "CAPTCHA", "x" * 8000 + "captcha", None])
    assert got == [True, False, False]


def test_reprojection_keeps_the_shape(spark):
    wkt = "MULTIPOLYGON (((0 0, 111319.49079327358 0, 0 111325.1428663851, 0 0)), ((-10.5 1e2, 3 4, 5 6, -10.5 1e2)))"
    out = apply(spark, reproject_wkt, [wkt])[0]
    assert out.startswith("MULTIPOLYGON (((0.0 ") and out.count("(") == wkt.count("(") and out.endswith(")))")
    edges = polygon_edges(spark.createDataFrame([("a", out)], "k string, w string"), "k", "w")
    first = edges.orderBy("ring", "x1").collect()
    assert len(first) == 6
    assert max(r["x2"] for r in first) == pytest.approx(1.0) and max(r["y2"] for r in first) == pytest.approx(1.0)


def test_visible_text_decodes_entities_and_no_break_spaces(spark):
    from listing_lake.functions.pages import visible_text
    from listing_lake.functions.text import detail_captures

    html = (
        "<body><p>Superficie total\u00a045 m</p><p>Ba&ntilde;os&nbsp;2</p><p>Superficie &uacute;til&#160;30 m</p>"
        "<p>&amp;lt; &#xE9; &#233; &hearts; &#9829; & &;</p></body>"
    )
    df = spark.createDataFrame([(html,)], "html string").select(visible_text(F.col("html")).alias("t"))
    fields = detail_captures(F.col("t"))
    row = df.select("t", *[fields[k].alias(k) for k in ("superficie_total_m2", "banos", "superficie_util_m2")]).first()
    assert (row.superficie_total_m2, row.banos, row.superficie_util_m2) == ("45", "2", "30")
    assert row.t.endswith("&lt; é é &hearts; &#9829; & &;")


def test_entity_decoding_mentions_its_text_once(spark):
    rows = spark.createDataFrame([("a&amp;b",)], "t string").withColumn("u", F.reverse("t"))
    decoded = rows.select(pages.decode_entities(F.reverse(F.reverse(F.col("t")))).alias("d"))
    assert decoded.first()["d"] == "a&b"
    assert decoded._jdf.queryExecution().analyzed().toString().count("reverse(reverse(t") == 1


def test_first_selector_counts_even_if_its_element_is_not_closed(spark):
    html = "<h3 class='poly-component__title'>B</h3><h2 class='ui-search-item__title'>5 < 6 <b>A</b> &eacute;"
    rows = spark.createDataFrame([(0, html), (1, html + "</h2>"), (2, "<p>none</p>"), (3, None)], "i int, html string")
    got = [r["t"] for r in rows.select("i", cards.element_text(F.col("html"), cards.TITLE).alias("t")).orderBy("i").collect()]
    assert got == ["", "5Aé", None, None]
